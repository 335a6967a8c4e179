"""Properties of the frame operators, checked against brute force."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import aggregate, joins, reshape
from lakestrata.operators.ids import dense_id, distinct_with_id
from lakestrata.operators.neighbour import fill_once, fill_to_fixpoint
from lakestrata.operators.stitch import stitch_records


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_unpivot_drops_nulls_only(spark):
    df = spark.createDataFrame([(1, 1, None), (2, 0, 5)], "id int, a int, b int")
    assert rows(reshape.unpivot(df, ["id"], {"a": "A", "b": "B"}, "n", "v")) == [(1, "A", 1), (2, "A", 0), (2, "B", 5)]
    assert rows(reshape.unpivot_flags(df.union(df), ["id"], ["a", "b"])) == [(1, "a")]


def test_flags_to_rows_keeps_repeats(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 1, 1)], "id int, a int, b int")
    assert rows(reshape.flags_to_rows(df, ["id"], {"a": "x", "b": "y"}, "k")) == [(1, "x"), (1, "x"), (1, "y")]


def test_unpivot_records_with_absent_fields(spark):
    df = spark.createDataFrame([(1, 5, 7), (2, None, 3), (1, 5, 7)], "id int, s int, t int")
    got = reshape.unpivot_records(df, ["id"], [
        {"kind": F.lit("a"), "start": F.col("s"), "extra": F.lit(None).cast("int")},
        {"kind": F.lit("b"), "start": F.col("t"), "extra": F.col("s")},
    ], "start")
    assert rows(got) == [(1, "a", 5, None), (1, "b", 7, 5), (2, "b", 3, None)]


def test_edge_text_rejects_whole_lines(spark):
    lines = spark.createDataFrame([("1: 2, 3 | 4",), ("20: 2A, 5",), ("7;8",), ("",), ("9: 1,",)], "value string")
    assert rows(reshape.edge_list_from_text(lines)) == [(1, 2), (1, 3), (1, 4), (7, 8)]


@pytest.mark.parametrize("parts", [1, 5, 16])
def test_dense_ids_are_dense_and_independent_of_partitioning(spark, parts):
    base = spark.range(3000).select((F.col("id") * 7 % 2999).alias("k"), F.lit("x").alias("t")).distinct()
    want = {r.k: r.n for r in dense_id(base, "n").collect()}
    got = {r.k: r.n for r in dense_id(base.repartition(parts), "n").collect()}
    assert got == want and sorted(got.values()) == list(range(len(got)))


def test_distinct_with_id_collapses_a_hot_row(spark):
    df = spark.range(10000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
    got = distinct_with_id(df, "n")
    assert got.count() == df.distinct().count() == got.select("n").distinct().count()


def test_zero_fill_keeps_every_entity_once(spark):
    entities = spark.createDataFrame([(1,), (2,)], "id int")
    facts = spark.createDataFrame([(1, 2012, 3)], "id int, year int, n int")
    panel = joins.year_panel(entities, 2012, 2013)
    assert rows(joins.zero_filled(panel, ["id", "year"], facts, fill=["n"])) == [
        (1, 2012, 3), (1, 2013, 0), (2, 2012, 0), (2, 2013, 0)]
    assert rows(joins.missing_rows(panel, facts, ["id", "year"])) == [(1, 2013), (2, 2012), (2, 2013)]


def test_semi_gate_does_not_multiply(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    gate = spark.createDataFrame([(1,), (1,), (3,)], "id int")
    assert rows(joins.having_id_in(df, gate, "id")) == [(1, "a")]


def test_lag_join_needs_every_lag(spark):
    panel = spark.createDataFrame([(1, y, float(y)) for y in (2010, 2011, 2012, 2014)], "d int, y int, m double")
    facts = spark.createDataFrame([("a", 1, 2012), ("b", 1, 2014), ("c", 2, 2012)], "id string, dep int, yr int")
    got = joins.lag_join(facts, panel, {"dep": "d", "yr": "y"}, "d", "y", ["m"])
    assert rows(got) == [("a", 1, 2012, 2012.0, 2011.0, 2010.0)]


def test_lag_join_equals_one_join_per_lag(spark):
    random.seed(5)
    panel_rows = [(d, y, random.random()) for d in range(6) for y in range(2000, 2010) if random.random() < 0.8]
    fact_rows = [(i, random.randrange(7), random.randrange(1999, 2011)) for i in range(300)]
    have = {(d, y): m for d, y, m in panel_rows}
    want = [
        (i, d, y, have[d, y], have[d, y - 1], have[d, y - 2]) for i, d, y in fact_rows
        if all((d, y - k) in have for k in range(3))
    ]
    got = joins.lag_join(
        spark.createDataFrame(fact_rows, "id int, dep int, yr int"),
        spark.createDataFrame(panel_rows, "d int, y int, m double"), {"dep": "d", "yr": "y"}, "d", "y", ["m"],
    )
    assert rows(got) == sorted(want, key=repr)


def test_group_size_and_event_counts(spark):
    df = spark.createDataFrame([(1, "2012-05-01", 2), (1, "2012-06-01", None), (2, "2023-01-01", 4)],
                               "id int, d string, n int").withColumn("d", F.col("d").cast("date"))
    counts = aggregate.event_counts(df, "id", "d", sums={"s": "n"}, counts={"c": "n"}, before_year=2023)
    assert rows(counts) == [(1, 2012, 2, 1)]
    assert rows(aggregate.attach_group_size(df.select("id"), "id")) == [(1, 2), (1, 2), (2, 1)]


def test_count_of_a_null_key_is_zero(spark):
    df = spark.createDataFrame([(None, "2012-05-01")], "id int, d string").withColumn("d", F.col("d").cast("date"))
    assert rows(aggregate.event_counts(df, "id", "d", counts={"c": "id"})) == [(None, 2012, 0)]


# a - b - c - d is a path, z is not connected; only a is observed in both periods.
EDGES = [("a", "b"), ("b", "a"), ("b", "c"), ("c", "b"), ("c", "d"), ("d", "c"), ("z", "y")]


def test_fill_once_stops_after_one_hop(spark):
    observed = spark.createDataFrame([("a", 1, 2.0), ("c", 1, 4.0), ("a", 2, 1.0), (None, 1, 9.0)], "e string, p int, m double")
    got = fill_once(observed, spark.createDataFrame(EDGES, "src string, dst string"), "e", ["p"], ["m"])
    assert rows(got) == [("a", 1, 2.0), ("a", 2, 1.0), ("b", 1, 3.0), ("b", 2, 1.0), ("c", 1, 4.0), ("d", 1, 4.0)]


def test_fill_once_mean_ignores_nulls(spark):
    observed = spark.createDataFrame([("a", 1, None), ("c", 1, 4.0)], "e string, p int, m double")
    got = fill_once(observed, spark.createDataFrame(EDGES, "src string, dst string"), "e", ["p"], ["m"])
    assert ("b", 1, 4.0) in rows(got) and ("a", 1, None) in rows(got)


def test_fill_to_fixpoint_reaches_everything_connected_and_ends(spark):
    observed = spark.createDataFrame([("a", 1, 2.0), ("d", 2, None), ("a", 2, 5.0)], "e string, p int, m double")
    got = fill_to_fixpoint(observed, spark.createDataFrame(EDGES, "src string, dst string"), "e", ["p"], ["m"])
    assert rows(got) == [(e, p, v) for e in "abcd" for p, v in ((1, 2.0), (2, 5.0))]


def brute_fill(observed, edges, places):
    known = dict(observed)
    while True:
        periods = {p for _, p in known}
        new = {}
        for e in {s for s, _ in edges}:
            for p in periods:
                near = [known[d, p] for s, d in edges if s == e and (d, p) in known]
                if (e, p) not in known and near:
                    new[e, p] = round(sum(near) / len(near), places)
        if not new:
            return known
        known.update(new)


def test_fill_to_fixpoint_equals_full_passes(spark):
    random.seed(11)
    nodes = range(40)
    edges = [(a, b) for a in nodes for b in nodes if a != b and random.random() < 0.06]
    observed = {(e, p): float(random.randrange(1000)) for e in nodes for p in range(5) if random.random() < 0.1}
    df = spark.createDataFrame([(e, p, m) for (e, p), m in observed.items()], "e int, p int, m double")
    got = fill_to_fixpoint(df, spark.createDataFrame(edges, "src int, dst int"), "e", ["p"], ["m"], places=6)
    want = brute_fill(observed, edges, 6)
    have = {(r.e, r.p): r.m for r in got.collect()}
    assert have.keys() == want.keys()
    assert all(abs(have[k] - want[k]) < 1e-4 for k in want)


def brute_stitch(lines, fields):
    out, first, text = set(), None, None
    for pos, line in lines:
        if not line:
            continue
        first, text = (pos, line) if first is None else (first, text[:-1] + line)
        if text.count(",") + 1 >= fields:
            out.add((first, text))
            first = None
    if first is not None:
        out.add((first, text))
    return out


@pytest.mark.parametrize("chunk,block", [(4096, 4096), (7, 3), (16, 2), (1, 1)])
@pytest.mark.parametrize("fields", [2, 5, 9])
def test_stitch_equals_line_by_line(spark, chunk, block, fields):
    random.seed(fields)
    lines = []
    for source in range(4):
        shape = [0, 0, 1, 2, 3, 4, 8] if source < 3 else [8, 8, 8, 2]
        for pos in range(120):
            body = "".join(random.choice("ab") + "," for _ in range(random.choice(shape)))
            lines.append((source, pos * 3, body + random.choice(["x", "yy", ",", ""])))
    df = spark.createDataFrame(lines, "src int, pos long, line string").repartition(5)
    got = stitch_records(df, "src", "pos", "line", fields, chunk_lines=chunk, block_chunks=block)
    want = {(s, *r) for s in range(4) for r in brute_stitch([(p, t) for q, p, t in lines if q == s], fields)}
    assert {tuple(r) for r in got.collect()} == want


def test_stitch_work_follows_the_lines_of_a_chunk(spark):
    """Records found are not copied again at each record that follows in the chunk."""
    n = 1 << 14
    lines = spark.range(n).selectExpr("0 AS src", "id AS pos", "IF(id % 2 = 0, concat(id, ',_'), concat(',', id)) AS line")
    took = {}
    for chunk in (256, 256, n):  # the first one warms up
        begin = time.monotonic()
        got = stitch_records(lines, "src", "pos", "line", 3, chunk_lines=chunk).collect()
        took[chunk] = time.monotonic() - begin
        assert {tuple(r) for r in got} == {(0, i, f"{i},,{i + 1}") for i in range(0, n, 2)}
    assert took[n] < 3 * took[256] + 3


def test_stitch_carries_over_the_page_border(spark):
    page = 10_000
    lines = [("f", 1 * page + 1, "a,b,"), ("f", 1 * page + 2, "c,d\r"), ("f", 2 * page + 1, "e,f"), ("f", 2 * page + 2, "g,h,i,j")]
    df = spark.createDataFrame(lines, "src string, pos long, line string")
    got = {r.record for r in stitch_records(df, "src", "pos", "line", 4).collect()}
    assert got == {"a,bc,de,f", "g,h,i,j"}


def test_lagged_panel_shuffles_once(spark):
    panel = spark.createDataFrame([(e, y, float(e * y), None if y == 3 else "x") for e in (1, 2) for y in range(1, 7) if (e, y) != (2, 4)], "e int, y int, m double, s string")
    got = joins.lagged_panel(panel, "e", "y", ["m", "s"], [0, 1, 2])
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert rows(got.select("e", "y", "m_0", "m_1", "m_2", "s_2")) == [
        (1, 3, 3.0, 2.0, 1.0, "x"), (1, 4, 4.0, 3.0, 2.0, "x"), (1, 5, 5.0, 4.0, 3.0, None), (1, 6, 6.0, 5.0, 4.0, "x"), (2, 3, 6.0, 4.0, 2.0, "x")]
    with pytest.raises(Exception, match="two panel rows"):
        joins.lagged_panel(panel.union(panel), "e", "y", ["m"], [0, 1]).collect()


def test_rows_of_a_hot_key_stay_where_they_are(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 4000).alias("k"), "id")
    assert aggregate.heavy_keys(df, "k") == [-1]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = aggregate.attach_group_size(df, "k", "n")
        plan = got._jdf.queryExecution().executedPlan().toString()
        want = {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
        assert all(r.n == want[r.k] for r in got.collect()) and got.count() == 30_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    hot = plan.split("Union")[1].split("SortMergeJoin")[0]
    assert "BroadcastHashJoin" in hot


@pytest.mark.parametrize("share", [0.01, 0.2])
def test_group_size_without_and_with_null_keys(spark, share):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2 + [(None,)] * 9 + [("c",)], "k string")
    assert rows(aggregate.attach_group_size(df, "k", "n", share)) == [("a", 6)] * 6 + [("b", 2)] * 2 + [("c", 1)]
    assert aggregate.attach_group_size(df.limit(0), "k").count() == 0


def test_buckets_of_ten_million_rows(spark):
    from lakestrata.operators.ids import bucket_count, key_hash_bucket

    df = spark.range(10_000_000).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
    buckets = bucket_count(10_000_000, 1 << 18)
    sizes = [r["count"] for r in df.groupBy(key_hash_bucket(["k"], buckets).alias("b")).count().collect()]
    assert buckets == 64 and len(sizes) == 64 and max(sizes) < 1.02 * 10_000_000 / 64


def test_ids_depend_on_neither_buckets_nor_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 7).cast("string").alias("k"))
    want = {r.k: r.n for r in dense_id(df, "n", buckets=1).collect()}
    assert sorted(want.values()) == list(range(5000))
    for again in (dense_id(df.repartition(7), "n", rows_per_bucket=100), dense_id(df.repartition(3, "k"), "n", buckets=4096), distinct_with_id(df.union(df), "n", None)):
        assert {r.k: r.n for r in again.collect()} == want
