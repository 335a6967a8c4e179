"""Joins in the shapes layered tables need.

No side is hinted: Spark broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks with shuffle sizes), and
skewed partitions of the remaining shuffle joins are split by AQE.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def attach_dimensions(facts: DataFrame, *dims: tuple[DataFrame, Sequence[str]]) -> DataFrame:
    """Inner equi-join of each dimension on its shared key columns."""
    return functools.reduce(lambda left, dim: left.join(dim[0], list(dim[1]), "inner"), dims, facts)


def zero_filled(
    entities: DataFrame, keys: Sequence[str], *facts: DataFrame, fill: Sequence[str] = ()
) -> DataFrame:
    """Left join facts that are already at the grain of ``keys``; listed measures get 0 where absent.

    Because each fact has one row per key, the entity rows are neither lost nor repeated.
    """
    joined = functools.reduce(lambda left, fact: left.join(fact, list(keys), "left"), facts, entities)
    return joined.fillna(0, list(fill)) if fill else joined


def year_panel(entities: DataFrame, first: int, last: int, year: str = "year") -> DataFrame:
    """Entities × years by expanding each row in place; no join takes place."""
    return entities.withColumn(year, F.explode(F.sequence(F.lit(first), F.lit(last))))


def missing_rows(expected: DataFrame, observed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected key combinations without data.

    The observed keys are reduced to distinct ones before they move.
    """
    return expected.join(observed.select(*keys).distinct(), list(keys), "left_anti")


def having_id_in(df: DataFrame, gate: DataFrame, key: str) -> DataFrame:
    """Rows whose id passes a gate; repeats of an id in the gate do not multiply rows."""
    return df.join(gate.select(key), [key], "left_semi")


def panel_lookup(
    df: DataFrame, panel: DataFrame, on: Mapping[str, str], measures: Sequence[str] | None = None
) -> DataFrame:
    """Inner join on differently named keys (``on`` maps frame column → panel column)."""
    keep = measures or [c for c in panel.columns if c not in on.values()]
    right = panel.select(*[F.col(p).alias(f"_on_{i}") for i, p in enumerate(on.values())], *keep)
    condition = functools.reduce(
        Column.__and__, [F.col(d) == F.col(f"_on_{i}") for i, d in enumerate(on)]
    )
    return df.join(right, condition, "inner").drop(*[f"_on_{i}" for i in range(len(on))])


def lagged_panel(
    panel: DataFrame, entity: str, period: str, measures: Sequence[str], lags: Sequence[int]
) -> DataFrame:
    """(entity, period) with every measure at each lag, as ``<measure>_<lag>``; any missing lag drops the row.

    Every panel row is sent to the periods it serves and the lags of a period are put side
    by side: the panel is read once and shuffled once, combined map-side, and the (large)
    facts later join once instead of once per lag. A panel has one row per entity and
    period; two are an error. Rows without an entity or a period serve none.
    """
    lags = list(dict.fromkeys(lags))
    sent = panel.where(F.col(entity).isNotNull() & F.col(period).isNotNull()).select(
        entity, F.col(period).alias("_at"), *measures, F.explode(F.array(*[F.lit(lag) for lag in lags])).alias("_lag")
    ).select(entity, (F.col("_at") + F.col("_lag")).alias(period), *measures, "_lag")
    at = {lag: F.col("_lag") == lag for lag in lags}
    sides = sent.groupBy(entity, period).agg(
        *[F.count(F.when(at[lag], 1)).alias(f"_n_{i}") for i, lag in enumerate(lags)],
        *[F.max(F.when(at[lag], F.col(m))).alias(f"{m}_{lag}") for lag in lags for m in measures],
    )
    counts = [F.col(f"_n_{i}") for i in range(len(lags))]
    twice = functools.reduce(Column.__or__, [n > 1 for n in counts])
    whole = functools.reduce(Column.__and__, [n == 1 for n in counts])
    kept = F.when(twice, F.raise_error(F.lit("two panel rows of one entity and period")).cast("boolean")).otherwise(whole)
    return sides.where(kept).drop(*[f"_n_{i}" for i in range(len(lags))])


def lag_join(
    df: DataFrame, panel: DataFrame, on: Mapping[str, str], entity: str, period: str,
    measures: Sequence[str], lags: Sequence[int] = (0, 1, 2),
) -> DataFrame:
    """Attach the panel at each lag; ``on`` maps frame columns to the panel's entity and period."""
    return panel_lookup(df, lagged_panel(panel, entity, period, measures, lags), on)


def answer_association(answers: DataFrame, dictionary: DataFrame, key: str, ids: Sequence[str]) -> DataFrame:
    """Long answers to code-book ids by question column only."""
    return answers.join(dictionary, [key], "inner").select(*ids)


def geo_hierarchy(
    links: DataFrame, departments: DataFrame, regions: DataFrame, department: str, region: str
) -> DataFrame:
    """department → former region → new region as one dimension, built from repeated links."""
    return (
        links.select(region, department).distinct()
        .join(departments, [department], "inner")
        .join(regions, [region], "inner")
        .distinct()
    )
