"""Language identification by averaged hashed subword embeddings under a linear softmax, with a calibrated rejection of what fits no language."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakestrata.llm.common import give_back, named

UNKNOWN = "und"
BUCKETS = 1 << 14
_PIECE = 1 << 20  # bytes hashed at a time
_BREAKS = re.compile(r"[\W\d_]+")
#: Rows that are collected to learn from, of all languages together; each has one at least.
MAX_ROWS = 1_000_000


def subwords(text: str) -> np.ndarray:
    """How often each bucket is hit by the 1- to 4-byte subwords of the lower-cased letters of ``text``; words are set apart by blanks."""
    data = np.frombuffer(f" {_BREAKS.sub(' ', text.lower())} ".encode(), np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for start in range(0, len(data), _PIECE):
        part = data[start : start + _PIECE + 3].astype(np.uint32)
        last = start + _PIECE >= len(data)
        code = part
        for n in range(1, 5):
            if n > 1:
                code = code[:-1] | (part[n - 1 :] << np.uint32(8 * (n - 1)))
            own = code if last else code[:_PIECE]
            hashed = (own * np.uint32(0x9E3779B1) + np.uint32(n)) * np.uint32(0x85EBCA77) >> np.uint32(18)
            counts += np.bincount(hashed, minlength=BUCKETS)
    return counts


class Model(NamedTuple):
    """A text's logits are the mean embedding of the subwords it hits times the softmax weights.

    Beside the score stands a fit: how likely the subwords are in the language told, per
    subword, against what is usual there. A language nobody taught scores high in whichever
    is nearest, but its subwords are unlikely in it.
    """

    languages: list[str]
    embed: np.ndarray
    weight: np.ndarray
    bias: np.ndarray
    temperature: float
    surprise: np.ndarray  # of each subword in each language: minus the log of its share, in thousandths, two bytes each
    usual: np.ndarray  # mean surprise of a text, per language
    spread: np.ndarray  # variance of it: that of very long texts, and what one subword adds
    reject_above: float  # standard deviations from the usual

    def judge(self, text: str) -> tuple[str, float, float]:
        """Language, score, and how many standard deviations the text is more surprising than usual."""
        counts = subwords(text)
        hit = np.flatnonzero(counts)
        share = counts[hit] / counts.sum()
        logits = ((share @ self.embed[hit]) @ self.weight + self.bias) / self.temperature
        odds = np.exp(logits - logits.max())
        best = int(odds.argmax())
        surprise = float(share @ self.surprise[best, hit]) / 1000 - self.usual[best]
        return self.languages[best], float(odds[best] / odds.sum()), float(surprise / np.sqrt(self.spread[0] + self.spread[1] / counts.sum()))


def _softmax(logits: np.ndarray) -> np.ndarray:
    odds = np.exp(logits - logits.max(1, keepdims=True))
    return odds / odds.sum(1, keepdims=True)


def train(texts: list[str], langs: list[str], dim: int = 16, epochs: int = 12, batch: int = 32, rate: float = 20.0, seed: int = 5, max_reject: float = 0.0005, margin: float = 1.5) -> Model:
    """Fit by stochastic gradient descent, then calibrate on every fifth text, which the fit doesn't see.

    The temperature minimises the log loss there. The variance of a text's surprise is fitted
    there as a constant and a part that shrinks with its length; a text is rejected beyond
    ``margin`` times the deviation that at most ``max_reject`` of the calibration texts exceed.
    """
    languages = sorted(set(langs))
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((0, 0)), np.zeros(0), 1.0, np.zeros((0, BUCKETS), np.uint16), np.zeros(0), np.ones(2), np.inf)
    rng = np.random.default_rng(seed)
    y = np.searchsorted(languages, langs)
    hit, share, size = [], [], []
    for text in texts:
        counts = subwords(text)
        hit.append(np.flatnonzero(counts).astype(np.int32))
        size.append(int(counts.sum()))
        share.append((counts[hit[-1]] / counts.sum()).astype(np.float32))
    order = rng.permutation(len(y))
    held, fit = (order[::5], np.delete(order, np.s_[::5])) if len(y) >= 50 else (order, order)
    embed = rng.normal(0, 0.1, (BUCKETS, dim)).astype(np.float32)
    weight = rng.normal(0, 0.1, (dim, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for rows in np.array_split(rng.permutation(fit), max(1, len(fit) // batch)):
            at = np.concatenate([hit[i] for i in rows])
            value = np.concatenate([share[i] for i in rows])
            of = np.repeat(np.arange(len(rows)), [len(hit[i]) for i in rows])
            mean = np.add.reduceat(embed[at] * value[:, None], np.searchsorted(of, np.arange(len(rows))))
            wrong = _softmax(mean @ weight + bias)
            wrong[np.arange(len(rows)), y[rows]] -= 1
            wrong /= len(rows)
            back = wrong @ weight.T
            weight -= step * 0.1 * (mean.T @ wrong)
            bias -= step * 0.01 * wrong.sum(0)
            np.subtract.at(embed, at, step * value[:, None] * back[of])
    embed, weight, bias = embed.astype(np.float64), weight.astype(np.float64), bias.astype(np.float64)
    logits = np.array([(share[i] @ embed[hit[i]]) @ weight + bias for i in held])
    loss = lambda t: -np.log(_softmax(logits / t)[np.arange(len(held)), y[held]] + 1e-300).mean()
    temperature = float(min(np.geomspace(0.02, 20, 80), key=loss))

    surprise, usual = np.empty((len(languages), BUCKETS), np.uint16), np.zeros(len(languages))
    for k in range(len(languages)):
        mine = [i for i in fit if y[i] == k]
        # each text counts alike, so that no long one speaks for the language
        total = np.zeros(BUCKETS)
        for i in mine:
            total[hit[i]] += share[i]
        share_of = (total + 1e-4 * max(1, len(mine)) / BUCKETS) / (total.sum() + 1e-4 * max(1, len(mine)))
        surprise[k] = np.minimum(65_535, np.rint(-1000 * np.log(share_of))).astype(np.uint16)
        usual[k] = np.mean([float(share[i] @ surprise[k, hit[i]]) / 1000 for i in mine]) if mine else 0.0
    best = logits.argmax(1)
    over = np.array([float(share[i] @ surprise[k, hit[i]]) / 1000 - usual[k] for i, k in zip(held, best)])
    per = 1 / np.array([size[i] for i in held], np.float64)
    spread = np.maximum(np.linalg.lstsq(np.stack([np.ones(len(per)), per], 1), over**2, rcond=None)[0], [1e-6, 1e-3])
    far = np.sort(over / np.sqrt(spread[0] + spread[1] * per))[::-1]
    return Model(languages, embed, weight, bias, temperature, surprise, usual, spread, float(margin * max(1.0, far[int(max_reject * len(far))])))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", max_per_language: int = 1000, max_chars: int = 1 << 16, **fit) -> Model:
    """Train on a bounded sample: per language at most ``max_per_language`` different texts of at most ``max_chars`` characters.

    Texts are drawn by their hash, so reruns agree and copies are one; of more than
    ``MAX_ROWS // max_per_language`` languages each has fewer, one at least. Null labels,
    null texts and texts without a letter are left out.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (F.length("text") <= max_chars)
    )
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n"))
    languages = sizes.count()
    quota = max(1, min(max_per_language, MAX_ROWS // max(1, languages)))
    # a little more is drawn than is taken: the estimate may be off by some hundredths, the draw by its chance
    sizes = sizes.select("lang", ((quota * 1.2 + 8 * quota**0.5 + 8) / F.col("n")).alias("rate"))
    number = F.xxhash64(F.lit(29), "text")
    draw = F.shiftrightunsigned(number, 11) / float(1 << 53)
    drawn = rows.join(F.broadcast(sizes), "lang").where(draw < F.col("rate")).dropDuplicates(["lang", "text"]).select("lang", "text", draw.alias("draw"))
    sample, taken = [], {}
    for r in sorted(drawn.collect(), key=lambda r: (r["lang"], r["draw"], r["text"])):
        taken[r["lang"]] = taken.get(r["lang"], 0) + 1
        if taken[r["lang"]] <= quota:
            sample.append((r["lang"], r["text"]))
    return train([t for _, t in sample], [name for name, _ in sample], **fit)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``; whole texts, no shuffle.

    A null text, or one without a letter, is ``und`` with score 0 and rejected; others get
    a learned language, and are rejected if their subwords are more surprising in it than
    the model's calibrated bound allows. Rows are judged one by one, so equal texts get
    equal answers and a tie of scores goes to the first language. A model
    without languages answers ``und``. Columns of ``docs`` with the names of the three are
    replaced; all others pass through unchanged.
    """
    keep = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "rejected")]
    # plain names on the way through Arrow
    inner = [f"c{k}" for k in range(len(keep))]
    rows = docs.select(*(c.alias(n) for c, n in zip(named(keep), inner)), F.when(F.col(text).rlike(r"\p{L}"), F.col(text)).alias("letters"))
    known = model.languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            found = [model.judge(t) if known and (t := x.as_py()) is not None else (UNKNOWN, 0.0, np.inf) for x in batch.column(batch.num_columns - 1)]
            names, scores, far = zip(*found) if found else ((), (), ())
            added = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array([n == UNKNOWN or f > model.reject_above for n, f in zip(names, far)], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], [*inner, "lang_pred", "score", "rejected"])

    schema = rows.drop("letters").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return rows.mapInArrow(run, schema).toDF(*keep, "lang_pred", "score", "rejected")
