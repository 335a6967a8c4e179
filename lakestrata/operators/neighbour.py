"""Filling (entity, period) gaps from neighbouring entities."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lakestrata.functions.measures import round_measure
from lakestrata.session import cut_lineage

_FOLD = 6


def _means_from(
    source: DataFrame, known: DataFrame, edges: DataFrame, entity: str, periods: Sequence[str],
    measures: Sequence[str], places: int | None,
) -> DataFrame:
    """Neighbour means for the (entity, period) pairs that are not known yet.

    Joining edges to the rows that have data yields only pairs with at least one
    informed neighbour, so the entity × period product is never formed.
    """
    keys = [entity, *periods]
    offered = (
        edges.withColumnRenamed("dst", entity)
        .join(source, [entity], "inner")
        .select(F.col("src").alias(entity), *periods, *measures)
    )
    # Means first: the anti join then compares one row per pair, not one per neighbour.
    means = offered.groupBy(*keys).agg(*[round_measure(F.avg(m), places).alias(m) for m in measures])
    return means.join(known.select(*keys), keys, "left_anti")


def fill_once(
    observed: DataFrame, edges: DataFrame, entity: str, periods: Sequence[str],
    measures: Sequence[str], places: int | None = 2,
) -> DataFrame:
    """Observed rows plus, for missing pairs, the mean over the neighbours observed in that period.

    ``edges`` has columns ``src`` (entity) and ``dst`` (its neighbour), of the type of ``entity``;
    a repeated edge weighs twice in the mean.
    """
    columns = [entity, *periods, *measures]
    filled = _means_from(observed, observed, edges, entity, periods, measures, places)
    return observed.select(*columns).unionByName(filled).where(F.col(entity).isNotNull())


def fill_to_fixpoint(
    observed: DataFrame, edges: DataFrame, entity: str, periods: Sequence[str],
    measures: Sequence[str], places: int | None = 2,
) -> DataFrame:
    """Repeat the fill in synchronous passes until no reachable pair is missing.

    A pair filled in pass k has no neighbour known before pass k-1 (it would have
    been filled earlier), so its mean is over the rows added by pass k-1. Each
    pass therefore joins only that frontier with the edges; over all passes that is
    edges × periods. The pairs it offers are held against the keys known so far, which
    move without their measures. Entities with no path to an observed one end the loop by
    adding nothing.

    Each frontier is checkpointed to the shared folder, which gives the row count that
    ends the loop, and what is known is folded into one checkpoint every ``_FOLD`` passes,
    so a pass scans a bounded number of parts however long the paths are.
    """
    columns = [entity, *periods, *measures]
    links = cut_lineage(edges)
    frontier = cut_lineage(
        observed.select(*columns).where(F.col(entity).isNotNull()).dropna("any", subset=list(measures))
    )
    known = frontier
    for number in itertools.count(1):
        frontier = cut_lineage(_means_from(frontier, known, links, entity, periods, measures, places))
        if frontier.isEmpty():
            return known
        known = known.unionByName(frontier)
        if number % _FOLD == 0:
            known = cut_lineage(known)
