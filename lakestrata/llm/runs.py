"""Periodic runs of words, found by recursive frequency splitting and a lag scan of what survives."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakestrata.llm.common import named, utf8

_WHOLE = 64  # lags up to this one are compared at every place
_CELLS = 1 << 20  # comparisons held at a time
_PROBES = 8  # places per period that are probed before a longer lag is followed


class Rule(NamedTuple):
    """A run has ``length >= max(least, times * period)`` words."""

    least: int = 6
    times: int = 4


def surviving(ids: np.ndarray, rule: Rule) -> list[tuple[int, int]]:
    """Stretches (start, stop) that may hold a run.

    Each word of a run occurs ``times`` times or more inside it, so a word that is rarer in
    its stretch belongs to no run and parts the stretch. What is left of it is counted
    again, until nothing is parted any more; stretches below the least length go.
    """
    done, open_ = [], [(0, len(ids))]
    while open_:
        start, stop = open_.pop()
        if stop - start < rule.least:
            continue
        part = ids[start:stop]
        _, inverse, counts = np.unique(part, return_inverse=True, return_counts=True)
        rare = np.flatnonzero(counts[inverse] < rule.times)
        if not len(rare):
            done.append((start, stop))
            continue
        bounds = np.concatenate([[-1], rare, [stop - start]])
        wide = np.flatnonzero(np.diff(bounds) > rule.least)
        open_ += [(start + int(bounds[k]) + 1, start + int(bounds[k + 1])) for k in wide]
    return sorted(done)


def _agreeing(part: np.ndarray, place: int, lag: int, forward: bool) -> int:
    """How many words from ``place`` on (or before it) equal the word ``lag`` further; looks twice as far each time."""
    n, found, width = len(part), 0, 64
    while True:
        if forward:
            low, high = place + found, min(place + found + width, n - lag)
        else:
            low, high = max(0, place - found - width), place - found
        if high <= low:
            return found
        differ = np.flatnonzero(part[low:high] != part[low + lag : high + lag])
        if len(differ):
            return found + int(differ[0] if forward else high - low - 1 - differ[-1])
        found, width = found + high - low, width * 2


def _short_lags(part: np.ndarray, lags: range, rule: Rule) -> Iterator[tuple[int, int, int]]:
    """(lag, start, length) of every stretch that agrees with itself at one of ``lags``, all places compared side by side."""
    n = len(part)
    step = max(1, _CELLS // n)
    for first in range(lags.start, lags.stop, step):
        some = np.arange(first, min(first + step, lags.stop))
        # a column of differences at both ends keeps the rows apart
        same = np.zeros((len(some), n + 2), bool)
        for k, lag in enumerate(some.tolist()):
            np.equal(part[:-lag], part[lag:], out=same[k, 1 : n + 1 - lag])
        flat = same.ravel()
        edge = np.flatnonzero(flat[1:] != flat[:-1]) + 1
        begin, end = edge[::2], edge[1::2]
        lag = some[begin // (n + 2)]
        length = end - begin + lag
        good = np.flatnonzero(length >= np.maximum(rule.least, rule.times * lag))
        yield from zip(lag[good].tolist(), (begin[good] % (n + 2) - 1).tolist(), length[good].tolist())


def _long_lags(part: np.ndarray, lags: range, rule: Rule, found: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """The same for lags whose every place is too much: a run of ``times`` periods holds ``times`` neighbours among the places 0, lag, 2·lag, …

    Only where these, and those of some places between them, hold equal words is the
    stretch followed to both sides. A stretch inside a run that is already known, whose
    period divides the lag, is that run again.
    """
    n, need = len(part), rule.times
    for lag in lags:
        chain = part[:-lag:lag] == part[lag::lag]
        enough = need - 1  # times places in a row make one equal step less
        hits = chain[: len(chain) - enough + 1].copy()
        for k in range(1, enough):
            hits &= chain[k : len(chain) - enough + 1 + k]
        if hits.any():
            # the places between agree wherever a whole period on either side lies in the run
            rows = n // lag
            probe = part[: rows * lag].reshape(rows, lag)[:, np.arange(1, _PROBES) * lag // _PROBES]
            inner = (probe[1:] == probe[:-1]).all(1)
            for k in range(enough - 1):
                hits &= inner[k : k + len(hits)]
        reach = -1
        for k in np.flatnonzero(hits).tolist():
            place = k * lag
            if place < reach or any(lag % p == 0 and s <= place and place + 2 * lag <= s + length for p, s, length in found):
                continue
            before, after = _agreeing(part, place, lag, False), _agreeing(part, place, lag, True)
            reach = place + after
            if before + after + lag >= max(rule.least, need * lag):
                yield lag, place - before, before + after + lag


def runs(ids: np.ndarray, rule: Rule = Rule()) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of word numbers, by start, then period.

    A stretch that agrees with itself at a lag is a run of that period unless a smaller lag
    gave the same stretch: with ``times`` of 2 or more the smallest period divides the lag
    and reaches exactly as far.
    """
    out = []
    for start, stop in surviving(ids, rule):
        part, found, seen = ids[start:stop], [], set()
        most = (stop - start) // rule.times
        split = min(most, max(_WHOLE, _CELLS // (4 * (stop - start)))) + 1
        for lags, scan in ((range(1, split), lambda lags: _short_lags(part, lags, rule)), (range(split, most + 1), lambda lags: _long_lags(part, lags, rule, found))):
            for lag, at, length in scan(lags):
                if (at, length) not in seen:
                    seen.add((at, length))
                    found.append((lag, at, length))
        out += [(start + at, length, lag) for lag, at, length in found]
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when every run keeps its first period only."""
    step = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        step[start + period] += 1
        step[start + length] -= 1
    return np.cumsum(step[:-1]) == 0


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers."""
    number: dict[bytes, int] = {}
    return np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words))


_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_ARROW_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)``: all periodic runs of every text, and the text with each run cut to one period.

    A run is a maximal stretch of words with smallest period ``period``, at least
    ``max(least, times * period)`` words long. ``runs`` are structs (start, length, period)
    by start, then period; ``collapsed`` has the words that no run holds behind its first
    period, joined by blanks. Texts are whole and judged one by one: one pass without a
    shuffle, and groups of copies or a hot source cost what their rows cost. A text of n
    words whose frequent words never part compares n²/4 places when n is small; from there
    on only the lags that a few probes confirm are followed, so a text of a million words
    stays below a minute.

    A null or empty text, or one of white space, has no words, no runs and an empty
    collapsed text; a null id stays null; repeated rows each have their row; other columns
    are ignored, whatever their names; an empty table gives an empty result. ``times`` is 2
    or more and ``least`` 1 or more.
    """
    if times < 2 or least < 1:
        raise ValueError("a run has two periods or more, and a word or more")
    rule, id_type = Rule(least, times), docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(named([doc_id])[0].alias("doc_id"), utf8(named([text])[0]).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                counts, told, texts = [], [], []
                for value in some.column(1):
                    words = value.as_py().split()
                    found = runs(word_numbers(words), rule)
                    if found:
                        keep = kept_words(len(words), found)
                        words, total = [words[i] for i in np.flatnonzero(keep).tolist()], len(words)
                    else:
                        total = len(words)
                    counts.append(total)
                    told.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                    texts.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(counts, pa.int64()), pa.array(told, _ARROW_RUNS), pa.array(texts, pa.string())], ["doc_id", "n_words", "runs", "collapsed"]
                )

    return rows.mapInArrow(scan, f"doc_id {id_type}, n_words bigint, runs {_RUNS}, collapsed string")
