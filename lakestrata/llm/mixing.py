"""Mixing sources to target weights by capped water-filling and seeded repetition."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from lakestrata.llm.common import named, spare, stored, word_count

#: Plans of up to so many sources are broadcast, beyond it they are joined by shuffle.
BROADCAST_SOURCES = 100_000
_BITS = 10  # of the sampling hash, taken at each of two levels


def _whole(number) -> Column:
    return (number if isinstance(number, Column) else F.lit(str(number))).cast("decimal(38,0)")


def _over(unit: Fraction, max_epochs: int) -> Column:
    """Whether a source's share at so much per unit of weight is above its cap, in whole numbers."""
    return _whole(unit.numerator) * F.col("weight") > _whole(unit.denominator) * F.col("size") * max_epochs


def water_fill(sources: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """``(source, source_size, target, whole, need)`` for different ``(source, size)``.

    Targets share the total size by weight, none above ``max_epochs`` times its size: sources
    above their cap are clamped to it and what they leave is shared anew among the others by
    weight, until none is above. What a unit of weight gets only grows from round to round,
    so a round is two sums over the sources, and the driver sees nothing else. With caps
    below the total (``max_epochs`` under 1) all end at their cap. ``whole`` times the source
    and ``need`` more make the rounded target.
    """
    spark = sources.sparkSession
    # sources are numbered in code point order, null last, by ranges of them
    order = F.col("source").asc_nulls_last()
    placed = stored(sources.repartitionByRange(max(1, -(-sources.count() // 200_000)), order).sortWithinPartitions(order).withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33).alias("part")
    sizes = [(r["part"], r["n"]) for r in placed.groupBy(part).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()]
    before = [(p, sum(n for _, n in sizes[:k])) for k, (p, _) in enumerate(sizes)]
    begins = spark.createDataFrame(before, "part bigint, before bigint")
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    of = F.array(*[F.lit(w).cast("bigint") for w in weights])
    ranked = placed.withColumn("part", part).join(F.broadcast(begins), "part").select("source", "size", F.get(of, (rank % len(weights)).cast("int")).alias("weight"))

    total, all_weight = ranked.agg(F.sum("size"), F.sum("weight")).first()
    unit, clamped = Fraction(total or 0, all_weight or 1), -1
    while True:
        over = _over(unit, max_epochs)
        n, size, weight = ranked.agg(F.count_if(over), F.sum(F.when(over, F.col("size"))), F.sum(F.when(~over, F.col("weight")))).first()
        if n == clamped or not weight:
            break
        unit, clamped = Fraction(total - max_epochs * (size or 0), weight), n
    over = _over(unit, max_epochs)
    goal, rounded, cap = F.lit(None).cast("double"), F.lit(None).cast("bigint"), F.col("size") * max_epochs
    for w in sorted(set(weights)):
        goal, rounded = (F.when(F.col("weight") == w, F.lit(value)).otherwise(other) for value, other in ((float(unit * w), goal), (round(unit * w), rounded)))
    times = F.expr(f"(cast('{unit.numerator}' as decimal(38,0)) * weight) div (cast('{unit.denominator}' as decimal(38,0)) * size)")
    whole = F.when(F.col("size") == 0, 0).when(over, max_epochs).otherwise(times).cast("bigint")
    return ranked.select(
        "source", F.col("size").alias("source_size"), F.when(over, cap.cast("double")).otherwise(goal).alias("target"), whole.alias("whole"),
        (F.when(over, cap).otherwise(rounded) - whole * F.col("size")).cast("bigint").alias("need"),
    )


def _boundary(rows: DataFrame, plan: DataFrame, level: str, few) -> DataFrame:
    """Per source the first value of ``level`` at which the running size reaches ``need``; the size before it is paid."""
    sums = rows.groupBy("source", level).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("ties"))
    run = Window.partitionBy("source").orderBy(level).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        sums.withColumn("run", F.sum("size").over(run)).alias("s")
        .join(few(plan).alias("p"), F.expr("s.source <=> p.source"))
        .where("run >= need and run - size < need")
        .select("s.source", level, (F.col("need") - F.col("run") + F.col("size")).alias("need"), "ties")
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 17,
    size: Column | None = None, doc_id: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken, whole, part``.

    Sources in code point order (null last) get ``weights`` in turn and share the total
    size; see :func:`water_fill`. A source is taken ``whole`` times in full, and the
    documents that come first by a seeded hash of their id once more, until the target is
    met; the document at the edge is taken in ``part`` only, so a source's ``taken`` sums
    to its rounded target. Equal ids share the edge evenly (rounded down).

    Cost: one pass over the texts, then sizes only. The edge is found by two levels of
    hash buckets and a last ordering inside one bucket, so no task orders a whole source.
    The plan has one row per source; it is broadcast up to ``BROADCAST_SOURCES`` of them and
    joined by shuffle beyond. Null, empty or blank texts have size 0 and are
    taken 0 times; an empty table gives an empty result; other columns are ignored.
    """
    rows = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
            (word_count(F.col(text)) if size is None else size).alias("size"),
            F.xxhash64(F.lit(seed), F.col(doc_id)).alias("u"),
        )
    )
    plan = stored(water_fill(stored(rows.groupBy("source").agg(F.sum("size").alias("size"))), weights, max_epochs))
    few = F.broadcast if plan.count() <= BROADCAST_SOURCES else lambda x: x

    some = rows.alias("r").join(few(plan.where("need > 0").select("source").alias("p")), F.expr("r.source <=> p.source"), "left_semi")
    coarse = F.shiftright(F.col("u"), 64 - _BITS)
    fine = F.shiftright(F.col("u"), 64 - 2 * _BITS)
    first = stored(_boundary(some.withColumn("c", coarse), plan.where("need > 0").select("source", "need"), "c", few))
    inside = some.alias("r").join(few(first.alias("e")), F.expr(f"r.source <=> e.source and shiftright(r.u, {64 - _BITS}) = e.c"), "left_semi")
    second = stored(_boundary(inside.withColumn("f", fine), first.select("source", "need"), "f", few))
    inside = inside.alias("r").join(few(second.alias("e")), F.expr(f"r.source <=> e.source and shiftright(r.u, {64 - 2 * _BITS}) = e.f"), "left_semi")
    edge = stored(_boundary(inside, second.select("source", "need"), "u", few).withColumnRenamed("u", "edge"))

    known = plan.drop("need").alias("p").join(edge.alias("e"), F.expr("p.source <=> e.source"), "left").select(
        "p.source", "source_size", "target", "whole", "edge", F.expr("need div ties").alias("share")
    )
    part = F.when(F.col("u") < F.col("edge"), F.col("size")).when(F.col("u") == F.col("edge"), F.least("size", "share")).otherwise(F.lit(0))
    return (
        rows.alias("r").join(few(known.alias("k")), F.expr("r.source <=> k.source"))
        .select("doc_id", "r.source", "size", "source_size", "target", "whole", part.cast("bigint").alias("part"))
        .withColumn("taken", F.col("whole") * F.col("size") + F.col("part"))
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as often as :func:`mix` takes them: whole repetitions as they are, and at most one part per source.

    A part holds a document's first words, with one blank between; ``n_chars``, where there
    is one, follows it. Rows are matched by id and size, so rows with equal ids are taken
    alike. Columns keep their names and order.
    """
    doc_id, source, text = (options.get(c, c) for c in ("doc_id", "source", "text"))
    of = {c: spare(docs, f"mix_{c}") for c in ("id", "size", "source", "whole", "part", "words", "take")}
    plan = mix(docs, **options)
    plan = plan.select(*(F.col(c).alias(of[k]) for c, k in (("doc_id", "id"), ("size", "size"), ("source", "source"), ("whole", "whole"), ("part", "part"))))
    whole, part, size, take = (F.col(of[c]) for c in ("whole", "part", "size", "take"))
    plan = plan.where((size > 0) & ((whole > 0) | (part > 0))).distinct()
    rows = docs.withColumn(of["words"], word_count(F.col(text)) if options.get("size") is None else options["size"])
    met = rows.join(plan, rows[doc_id].eqNullSafe(plan[of["id"]]) & (rows[of["words"]] == plan[of["size"]]) & rows[source].eqNullSafe(plan[of["source"]]))
    full = F.when(part == size, whole + 1).otherwise(whole)
    rest = F.when((part > 0) & (part < size), F.array(part)).otherwise(F.array().cast("array<bigint>"))
    each = met.withColumn(of["take"], F.explode(F.concat(F.array_repeat(size, full.cast("int")), rest)))
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    short = F.when(take < size, F.array_join(F.slice(words, F.lit(1), take.cast("int")), " ")).otherwise(F.col(text))
    out = {text: short}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType.simpleString()
        out["n_chars"] = F.when(take < size, F.length(short).cast(kind)).otherwise(F.col("n_chars"))
    return each.select(*(out[c].alias(c) if c in out else col for c, col in zip(docs.columns, named(docs.columns))))
