"""The pipeline, stage by stage, on the smallest tables."""

from __future__ import annotations

import brute
import pytest

import corpus_pipeline
from lakestrata.llm import queries
from lakestrata.llm.common import shared_path

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    out["documents"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        path = shared_path(spark, "test-stage")
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = docs.collect()
        if name != "token_output":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
    return out


def test_language_keeps_clean_documents(kept):
    assert len(kept["language_id"]) >= 0.98 * len([r for r in kept["documents"] if any(c.isalpha() for c in r.text or "")])


def test_exact_copies_go(kept):
    texts = [r.text for r in kept["near_dedup"]]
    assert len(texts) == len(set(texts)) and set(texts) <= {r.text for r in kept["language_id"]}


def test_no_leak_is_left(spark, kept):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    leaks = {d for d, _ in brute.overlaps({r.doc_id: r.text for r in kept["near_dedup"]}, items)}
    assert {r.doc_id for r in kept["near_dedup"]} - leaks == {r.doc_id for r in kept["decontamination"]}


def test_mixture_meets_the_targets(kept):
    sizes = {}
    for r in kept["decontamination"]:
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or '').encode().split())
    taken = {}
    for r in kept["mixture"]:
        taken[r.source] = taken.get(r.source, 0) + len((r.text or '').encode().split())
    assert sum(taken.values()) == pytest.approx(sum(sizes.values()), abs=len(sizes)) and all(taken[s] <= 3 * sizes[s] for s in taken)


def test_tokens_are_those_of_the_mixture(kept):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    want = sorted((r.doc_id, len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1) for r in kept["mixture"])
    assert sorted((r.doc_id, r.n_tokens) for r in kept["token_output"]) == want
