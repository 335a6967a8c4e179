"""Every change that the rule of 11 in 13 allows is found, and items of few tokens too."""

from __future__ import annotations

from itertools import combinations

import brute

from lakestrata.llm import decontam


def test_all_changes_within_the_rule_are_found(spark):
    docs, items = {}, {}
    for n in range(1, 15):
        words = [f"i{n}t{k}" for k in range(n)]
        items[n] = " ".join(words)
        for count in range(3):
            for places in combinations(range(n), count):
                text = " ".join("other" if k in places else w for k, w in enumerate(words))
                docs[len(docs)] = text if len(docs) % 2 else f"before {text} after"
    found = decontam.contamination(
        spark.createDataFrame(list(docs.items()), "doc_id bigint, text string"), spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    )
    got, want = {(r.doc_id, r.item_id) for r in found.collect()}, brute.overlaps(docs, items)
    assert got == want and {item for _, item in want} == set(items) and sum(item == 13 for _, item in want) == 1 + 13 + 78
