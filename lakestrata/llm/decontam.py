"""Benchmark decontamination by spaced-seed hashing, all in native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.llm.common import spare, stored

#: Spaced seeds: 1 = the token counts, 0 = it is ignored, so a substitution there goes unseen.
MASKS = ("111011011", "110101111")
#: With it, any two changes in 13 tokens and any one in 9 to 12 leave a seed whole.
DENSE = "111101"
#: Items of fewer tokens are found by seeds over all of them: as they are below 7, with each pair of places ignored in turn at 7 and 8.
SHORT = 9
#: Seeds and item texts are broadcast up to this size, beyond it they are joined by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 32 << 20


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits; an empty token may stand at either end. Null has none."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")


def _masks(lengths: list[int]) -> list[tuple[str, int | None]]:
    """Masks, and the only item length each is for: items below ``SHORT`` tokens have theirs, as far as such items occur."""
    masks = [(mask, None) for mask in (*MASKS, DENSE)]
    for n in lengths:
        if n < 7:
            masks.append(("1" * n, n))
        else:
            masks += [("".join("0" if i // 2 == pair else "1" for i in range(n)), n) for pair in range((n + 1) // 2)]
    return masks


def _seeds(rows: DataFrame, words: str, keep: list[str], masks: list[tuple[str, int | None]], items: bool) -> DataFrame:
    """``(*keep, pos, seed)`` for each mask at each position where it fits; of an item, for the masks of its length."""
    at = rows.select(*keep, words, F.posexplode(words).alias("pos", "_word"))
    size, seeds = F.size(words), []
    for k, (mask, only) in enumerate(masks):
        fits = F.col("pos") <= size - len(mask)
        if items:
            fits &= size >= SHORT if only is None else size == only
        seeds.append(F.when(fits, F.xxhash64(F.lit(k), *(F.get(words, F.col("pos") + i) for i, bit in enumerate(mask) if bit == "1"))))
    return at.select(*keep, "pos", F.explode(F.array(*seeds)).alias("seed")).where("seed is not null")


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 13, least: int = 11, min_tokens: int = 1,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``(doc_id, item_id, matched, aligned, first_token, last_token)``: one row per document and item that overlap.

    Candidates are alignments (document position minus item position) at which a spaced
    seed of the item and of the document hash alike. Around such a hit the two are laid
    side by side; it stands if some ``window`` aligned tokens (the whole item, if shorter)
    hold at least ``least`` equal ones (in the same proportion, rounded up). Of several
    alignments the one with most equal tokens is told.

    Items of fewer than ``min_tokens`` tokens are left out: nearly every document holds an
    item of a few common words, so a large corpus wants 5 or more here.

    Cost: one pass over the tokens, no shuffle before the hits; hits are reduced to
    alignments map-side and kept. The texts are read once more, by the documents with a hit
    alone: their alignments are broadcast if they were counted and are few, so no text is
    shuffled, else joined by shuffle; so are the benchmark's seeds and texts. With 11 of 13 the seeds find every overlap there is, of items of any length; a looser
    ``window`` and ``least`` may have overlaps without a seed. Null or empty texts match
    nothing; repeated rows give one row; rows with a null id are ignored; other columns
    play no part.
    """
    left = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    items = (
        benchmark.select(F.col(item_id).alias("item_id"), F.array_remove(tokens(F.col(item_text)), "").alias("item"))
        .where((F.col("item_id").isNotNull()) & (F.size("item") >= min_tokens)).distinct()
    )
    masks = _masks(sorted(r[0] for r in items.select(F.size("item").alias("n")).where(F.col("n").between(1, SHORT - 1)).distinct().collect()))
    index = _seeds(items, "item", ["item_id"], masks, True).withColumnRenamed("pos", "item_pos").distinct()
    rows, size = index.count(), items.agg(F.sum(F.length(F.array_join("item", " ")))).first()[0] or 0
    small = F.broadcast if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else lambda x: x
    seen = _seeds(left.select("doc_id", tokens(F.col("text")).alias("words")), "words", ["doc_id"], masks, False)
    hits = stored(seen.join(small(index), "seed").select("doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct())
    few = F.broadcast if hits.count() <= BROADCAST_ROWS else lambda x: x

    laid = (
        left.join(few(hits), "doc_id").join(small(items), "item_id")
        .withColumn("words", tokens(F.col("text")))
        .withColumn("low", F.greatest(F.lit(0), -F.col("shift")))
        .withColumn("high", F.least(F.size("item"), F.size("words") - F.col("shift")))
        .withColumn("same", F.transform(F.sequence("low", F.col("high") - 1), lambda i: F.when(F.get("item", i) == F.get("words", i + F.col("shift")), 1).otherwise(0)))
        .withColumn("width", F.least(F.lit(window), F.size("item")))
        .withColumn("need", F.ceil(F.col("width") * least / window))
        .where(F.size("same") >= F.col("width"))
    )
    inside = F.exists(
        F.sequence(F.lit(1), F.size("same") - F.col("width") + 1),
        lambda i: F.aggregate(F.slice("same", i, F.col("width")), F.lit(0), lambda a, x: a + x) >= F.col("need"),
    )
    found = laid.where(inside).select(
        "doc_id", "item_id", F.aggregate("same", F.lit(0), lambda a, x: a + x).alias("matched"), F.size("same").alias("aligned"),
        (F.col("low") + F.col("shift")).alias("first_token"), (F.col("high") + F.col("shift") - 1).alias("last_token"),
    )
    best = F.max(F.struct("matched", "aligned", (-F.col("first_token")).alias("f"), "last_token")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", *(F.col(f"best.{c}").cast("bigint").alias(c) for c in ("matched", "aligned")),
        (-F.col("best.f")).cast("bigint").alias("first_token"), F.col("best.last_token").cast("bigint").alias("last_token"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that overlap a benchmark item; all others stay as they are, rows with a null id too."""
    key = options.get("doc_id", "doc_id")
    mark = spare(docs, "dirty")
    dirty = stored(contamination(docs, benchmark, **options).select(F.col("doc_id").alias(mark)).distinct())
    few = F.broadcast if dirty.count() <= BROADCAST_ROWS else lambda x: x
    return docs.join(few(dirty), docs[key] == dirty[mark], "left_anti")
