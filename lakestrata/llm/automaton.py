"""Substring dedup by suffix automata of reference shards."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from lakestrata.llm.repeats import Row, Sent, Spec, repeated


class SuffixAutomaton:
    """The substrings of the sequences read so far, with matching statistics of the one being read."""

    def __init__(self) -> None:
        self.step: list[dict] = [{}]
        self.link, self.size = [-1], [0]

    def read(self, sequence: list) -> list[int]:
        """Add a sequence; for each place the length of the longest run ending there that also ended somewhere before."""
        step, link, size = self.step, self.link, self.size
        last, lengths = 0, []
        for symbol in sequence:
            after = step[last].get(symbol)
            if after is None:
                new = len(size)
                step.append({})
                size.append(size[last] + 1)
                link.append(0)
                at = last
                while at >= 0 and symbol not in step[at]:
                    step[at][symbol] = new
                    at = link[at]
                if at >= 0:
                    after = step[at][symbol]
                    link[new] = after if size[after] == size[at] + 1 else self._split(at, symbol, after)
                last = new
                lengths.append(size[link[new]])
            else:
                last = after if size[after] == size[last] + 1 else self._split(last, symbol, after)
                lengths.append(size[last])
        return lengths

    def _split(self, at: int, symbol, after: int) -> int:
        """Part the state ``after``: its shorter strings end in more places from now on."""
        step, link, size = self.step, self.link, self.size
        new = len(size)
        step.append(dict(step[after]))
        size.append(size[at] + 1)
        link.append(link[after])
        link[after] = new
        while at >= 0 and step[at].get(symbol) == after:
            step[at][symbol] = new
            at = link[at]
        return new


def matched(sent: Sent, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of a shard's segments that start earlier: segments are streamed in order through the automaton of those before.

    Segments under different keys have no window in common, so each key of a shard has an
    automaton of its own, dropped when its last segment is through.
    """
    order = np.lexsort((sent.pos, sent.doc, sent.key))
    which, offset = [], []
    key = automaton = None
    for k in order.tolist():
        if key != (key := sent.key[k]):
            automaton = SuffixAutomaton()
        for end, length in enumerate(automaton.read(sent.texts[k].split(b" "))):
            if length >= window:
                which.append(k)
                offset.append(end - window + 1)
    return np.array(which, np.int64), np.array(offset, np.int64)


def remove_repeats(docs: DataFrame, window: int = 20, keep_text: bool = False, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256[, kept])``: documents without the words of windows that start earlier.

    A window is ``window`` words; it starts earlier in a document of a smaller id, or further
    up in the same one. Windows are judged on the input. The reference of a document is the
    corpus before it, which grows with the input; so its shards aren't broadcast: they are
    made of what may repeat (see ``repeats``), meet the documents' segments by key, and each
    segment is streamed through the suffix automaton of those before it for its matching
    statistics. Runs of matches of ``window`` words or more are the maximal spans that go.

    Null and empty texts have no words; rows without an id come last; repeated rows (and
    rows with equal ids) never count as earlier than each other, but later places of one
    of them do; other columns are ignored; an empty table gives an empty result.
    """
    def finish(row: Row, gone: np.ndarray) -> tuple:
        kept = b" ".join([row.symbols[i] for i in np.flatnonzero(~gone).tolist()] if gone.any() else row.symbols)
        told = len(row.symbols), int(gone.sum()), hashlib.sha256(kept).hexdigest()
        return (*told, kept.decode()) if keep_text else told

    columns = {"n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"} | ({"kept": "string"} if keep_text else {})
    gram = 8 if window >= 16 else max(1, window // 2)
    if gram != 8:
        raise ValueError("a window has 16 words or more")
    return repeated(docs, Spec(True, window, gram, True), lambda sent: matched(sent, window), finish, columns, doc_id=doc_id, text=text, **options)
