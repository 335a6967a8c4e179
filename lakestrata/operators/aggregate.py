"""Grouped aggregation. Every function here combines map-side before its shuffle."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.functions.measures import round_measure


def group_averages(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], places: int | None = 2
) -> DataFrame:
    """Mean of each measure per group under its own name, rounded half-up."""
    return df.groupBy(*keys).agg(*[round_measure(F.avg(m), places).alias(m) for m in measures])


def first_event(df: DataFrame, key: str, when: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(when).alias(name))


def event_counts(
    df: DataFrame, entity: str, date: str, year: str = "year",
    sums: Mapping[str, str] | None = None, counts: Mapping[str, str] | None = None,
    before_year: int | None = None,
) -> DataFrame:
    """Sums and non-null counts per (entity, year); ``before_year`` cuts an incomplete last year."""
    if before_year is not None:
        # A bound on the date itself reaches the scan; one on its year would not.
        df = df.where(F.col(date) < F.lit(datetime.date(before_year, 1, 1)))
    dated = df.withColumn(year, F.year(date))
    aggs = [F.sum(c).alias(n) for n, c in (sums or {}).items()]
    aggs += [F.count(c).alias(n) for n, c in (counts or {}).items()]
    return dated.groupBy(entity, year).agg(*aggs)


def roll_up(df: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Second-level sums of already aggregated measures."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def segment_counts(df: DataFrame, dimensions: Sequence[str], name: str = "count") -> DataFrame:
    return df.groupBy(*dimensions).agg(F.count(F.lit(1)).alias(name))


def heavy_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """Keys that may hold ``share`` of the rows or more, at most ``2 / share`` of them, by a mergeable sketch.

    The sketch counts no key short by more than 3.5 rows of ``tracked``, so none of that
    share is missed; null is none.
    """
    tracked = 1 << max(8, int(4 / share).bit_length())
    row = df.select(F.col(key).alias("k")).where("k is not null").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {int(2 / share)}, {tracked})").alias("top")
    ).first()
    return [item["item"] for item in row["top"] or [] if item["count"] >= share * row["n"]]


def attach_group_size(df: DataFrame, key: str, name: str = "count", share: float = 0.01) -> DataFrame:
    """Each row with the size of its group; rows without a key go.

    A window would bring a whole group into one task. The counts are reduced map-side and
    joined back instead: those of keys that hold ``share`` of the rows or more, which are
    few, by broadcast, so that such rows stay where they are; only the rest is shuffled.
    """
    def sized(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key).agg(F.count(F.lit(1)).alias(name))

    heavy = heavy_keys(df, key, share)
    if not heavy:
        return df.join(sized(df), [key], "inner")
    hot = F.col(key).isin(heavy)
    rest = df.where(~hot)
    # at most 2 / share keys
    return df.where(hot).join(F.broadcast(sized(df.where(hot))), [key], "inner").unionByName(rest.join(sized(rest), [key], "inner"))


def union_vintages(*frames: DataFrame) -> DataFrame:
    """Stack vintages of one table by column name."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def row_audit(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) for each frame, as one query."""
    return union_vintages(*[
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in frames.items()
    ])


def drop_repeats(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, or distinct keys when ``keys`` are given (only those columns remain)."""
    return df.select(*keys).distinct() if keys else df.distinct()


def measure_of_groups(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Several aggregates in one pass, named by keyword."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
