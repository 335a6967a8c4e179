"""Periodic runs, exact top-k search and the prefix trie against plain versions."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import metric_tree, prefixes, queries, runs

SF_DIR = "/root/testdata/sf0.001"
RUN_COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
NODE_COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize("seed", range(30))
def test_runs_of_random_sequences(seed, monkeypatch):
    """Few symbols and planted periods; the probed lags are made to start at once."""
    monkeypatch.setattr(runs, "_WHOLE", 2)
    monkeypatch.setattr(runs, "_CELLS", 64 if seed % 2 else 1 << 20)
    rng = random.Random(seed)
    words = []
    while len(words) < 300:
        kind = rng.random()
        if kind < 0.5:
            part = [rng.randrange(rng.choice((1, 2, 3, 9))) for _ in range(rng.randint(1, 30))]
            words += (part * rng.randint(3, 9))[: rng.randint(5, 120)]
        else:
            words += [rng.randrange(40) for _ in range(rng.randint(1, 20))]
    for rule in (runs.Rule(), runs.Rule(3, 2), runs.Rule(1, 5)):
        assert runs.runs(np.array(words), rule) == brute.periodic_runs(words, *rule)


def test_rare_words_part_what_is_searched():
    words = [1, 2] * 5 + [7] + [3, 3] * 4 + [8, 1, 2, 3]
    assert runs.surviving(np.array(words), runs.Rule()) == [(0, 10), (11, 19)]
    # a word that is frequent in the text but rare in its part goes in the second turn
    assert runs.surviving(np.array([1, 1, 9, 1, 1, 1, 8, 1, 1, 1]), runs.Rule()) == []


def test_long_texts_with_long_periods():
    rng = np.random.default_rng(1)
    period = rng.integers(0, 300, 30_000)
    words = np.concatenate([rng.integers(0, 300, 1_000), np.tile(period, 5), rng.integers(0, 300, 999)])
    assert [(n, p) for _, n, p in runs.runs(words) if p == 30_000] and runs.runs(np.zeros(100_000, np.int64)) == [(0, 100_000, 1)]


def test_periodic_runs_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op11_periodic_runs(spark, SF_DIR).collect()
    assert len(rows) == len(docs) and {r.doc_id: tuple(r[c] for c in RUN_COLUMNS) for r in rows} == {d: brute.run_row(d, t) for d, t in docs.items()}
    assert sum(r.n_runs > 0 for r in rows) > 5


def test_periodic_runs_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b " * 9), (4, "a b " * 9), (None, "x " * 7), (5, "é é " * 6), (6, "one two three")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").select("*", *(F.lit(1).alias(c) for c in ("runs", "n_words", "words", "a.b")))
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(table).collect())
    assert got == [
        (0, 7, [(0, 7, 1)], "x"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 18, [(0, 18, 2)], "a b"), (4, 18, [(0, 18, 2)], "a b"),
        (5, 6, [(0, 6, 1)], "é é"), (6, 3, [], "one two three"),
    ]
    assert runs.periodic_runs(table.limit(0)).count() == 0
    planted = queries.planted_runs(spark.createDataFrame([(i, "w%d x y z v " % i * (i % 7)) for i in range(300)] + [(None, "a"), (21, None)], "doc_id bigint, text string"))
    for r in planted.where("doc_id is not null and text is not null").collect():
        assert r.text.encode().split() == brute.planted(r.doc_id, "w%d x y z v " % r.doc_id * (r.doc_id % 7))


def test_metric_tree_query(spark):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    rows = queries.op12_metric_tree(spark, SF_DIR).collect()
    assert {tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in rows} == brute.best_products(vectors, lambda i: i % 50 == 0)


@pytest.mark.parametrize("seed,tile_rows,slice_rows", [(0, 4096, 4096), (1, 150, 7), (2, 20, 3)])
def test_top_k_of_odd_rows(spark, seed, tile_rows, slice_rows):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 1, (9, 5))
    rows = [(i, (middle[rng.integers(9)] + rng.normal(0, 0.1, 5)).tolist()) for i in range(900)]
    rows += [(i, [0.5] * 5) for i in range(1000, 1300)] + [(7, [0.25] * 5), (7, [0.25] * 5), (0, rows[0][1])]
    rows += [(2000, None), (2001, [1.0, None, 2.0, 0.0, 0.0]), (2002, [float("nan")] * 5), (2003, [float("inf")] * 5), (None, [9.0] * 5), (2010, [1.0, 2.0]), (2020, [3.0, -1.0]), (2030, []), (2040, [])]
    rows += [(2050, [-0.0, 0.0]), (2051, [1e17, 1.0]), (2060, [1e17, 2.0]), (2070, [1e300, -1e300, 1.0]), (2080, [1e300, 0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").select("*", *(F.lit(1).alias(c) for c in ("v", "name", "cell", "rank", "a.b")))
    got = [tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in metric_tree.top_k(table, F.col("vec_id") % 10 == 0, tile_rows=tile_rows, slice_rows=slice_rows).collect()]
    assert len(got) == len(set(got)) and set(got) == brute.best_products(rows, lambda i: i % 10 == 0)
    assert metric_tree.top_k(table.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_tree_leaves_computations_out():
    rng = np.random.default_rng(3)
    rows = np.floor(np.concatenate([rng.normal(0, 4, (3000, 8)) + 100 * c for c in rng.normal(0, 1, (10, 8))]))
    tree = metric_tree.build(rows, np.arange(len(rows)))
    again = metric_tree.tree_of(tree.to_bytes())
    seen = []
    counted = metric_tree.scores_of

    def count(some, query):
        seen.append(len(some))
        return counted(some, query)

    metric_tree.scores_of = count
    try:
        for query in rows[::1000]:
            want = sorted(zip((-(rows @ query)).astype(int).tolist(), range(len(rows))))[:5]
            assert metric_tree.search(again, query, 5) == [(-s, i) for s, i in want]
    finally:
        metric_tree.scores_of = counted
    assert sum(seen) < 0.3 * len(rows) * len(rows[::1000])


def told(df):
    rows = [tuple(r[c] for c in NODE_COLUMNS) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_prefix_trie_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert told(queries.op13_prefix_trie(spark, SF_DIR)) == brute.trie(brute.rebuilt(rows))


@pytest.mark.parametrize("part_rows", [3, 10, 4096])
def test_prefix_trie_over_many_tasks(spark, part_rows):
    """A hot first turn, a hot conversation, deep ones, ties, nulls and turns that come out of order."""
    rng = random.Random(part_rows)
    rows = []
    for c in range(150):
        if c % 3 == 0:
            turns = [("user", "hot"), ("assistant", "ö" * 5)]
        else:
            turns = [("user", "hot" if c % 3 == 1 else f"first {c % 11}")] + [(rng.choice(("user", None)), rng.choice(("a", "b", None))) for _ in range(rng.choice((0, 1, 2, 5, 40)))]
        order = list(range(len(turns)))
        rng.shuffle(order)
        rows += [(c, None if t == 0 and c % 4 == 0 else t, *turns[t]) for t in order]
    rows += [(500, 1, "user", "tie b"), (500, 1, "user", "tie a"), (500, 1, "assistant", "z" * 100), (501, None, None, None), (503, 0, "user", "x"), (None, 0, "user", "lost"), (-4, 0, "user", "below")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").select("*", *(F.lit(1).alias(x) for x in ("units", "path", "block", "n", "a.b")))
    plain = [r for r in rows if r[0] is not None]
    got = prefixes.prefix_trie(prefixes.conversation_turns(table), part_rows)
    own = {}
    for conv, turn, role, text in sorted(plain, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(conv, []).append((role or "", text or ""))
    assert told(got) == brute.trie(own)
    positive = [r for r in plain if r[0] >= 0]
    assert told(prefixes.prefix_trie(queries.rebuilt_conversations(table.where("conv_id >= 0")), part_rows)) == brute.trie(brute.rebuilt(positive))
    assert prefixes.prefix_trie(prefixes.conversation_turns(table.limit(0)), part_rows).count() == 0
