"""Near copies against the exact similarity of every pair."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import brute
import pytest

from lakestrata.llm import near_texts, simhash


def shingles(text: str) -> set:
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def kept(spark, docs, **options) -> set:
    return {r.doc_id for r in simhash.deduplicate(spark.createDataFrame(docs, "doc_id bigint, text string"), **options).collect()}


def plain_kept(docs) -> set:
    sets = {d: shingles(t) for d, t in docs}
    near = [(a, b) for a, b in combinations(sets, 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    return {d for d, root in brute.roots(sets, near).items() if d == root}


@pytest.mark.parametrize("times,body,line", [(4, 240, 12), (8, 240, 12), (30, 240, 12), (5, 100, 10)])
def test_a_line_repeated_in_one_copy_outvotes_nothing(spark, times, body, line):
    rng, docs = random.Random(times), []
    for k in range(10):
        words, more = ([f"w{rng.randrange(10**6)}" for _ in range(n)] for n in (body, line))
        docs += [(2 * k, " ".join(words + more)), (2 * k + 1, " ".join(words + more * times))]
    assert kept(spark, docs) == plain_kept(docs) == set(range(0, 20, 2))


@pytest.mark.parametrize("part_rows", [4096, 1])
def test_the_bound_is_exact(spark, part_rows):
    rng, docs = random.Random(8), []
    vocabulary, weights = [f"w{k}" for k in range(5000)], [1 / (k + 1) for k in range(5000)]
    for size, changes in ((600, range(10, 17)), (240, range(3, 8)), (100, range(1, 5)), (50, range(1, 4))):
        for changed in [c for c in changes for _ in range(6)]:
            words = rng.choices(vocabulary, weights, k=size)
            docs.append((len(docs), " ".join(words)))
            for _ in range(2):
                copy = list(words)
                for i in rng.sample(range(size), changed):
                    copy[i] = rng.choice(vocabulary)
                docs.append((len(docs), " ".join(copy)))
    want = plain_kept(docs)
    assert kept(spark, docs, part_rows=part_rows) == want and len(docs) // 3 < len(want) < len(docs)


def test_fingerprints_lead_to_links_without_any_band(spark, monkeypatch):
    monkeypatch.setattr(near_texts, "bands", lambda shingles: np.zeros(0, np.int64))
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    docs = [(0, " ".join(words)), (1, " ".join(words + ["more"])), (2, " ".join(f"v{k}" for k in range(400)))]
    assert kept(spark, docs) == plain_kept(docs) == {0, 2}
