"""The registered corpus queries against plain versions, on the smallest tables."""

from __future__ import annotations

import brute
import pytest

from lakestrata.llm import chat, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def told(spark, name, *columns):
    rows = queries.QUERIES[name](spark, SF_DIR).collect()
    found = {r[0]: tuple(r[c] for c in columns) for r in rows}
    assert len(found) == len(rows)
    return found


def test_decontamination(spark, docs):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    rows = queries.op1_decontamination(spark, SF_DIR).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == brute.overlaps(docs, items)


def test_substring_dedup(spark, docs):
    assert told(spark, "op2_substring_dedup", "n_words", "n_removed", "kept_sha256") == brute.word_repeats(docs)


def test_mixing(spark, docs):
    rows = queries.op3_mixing(spark, SF_DIR).collect()
    assert rows and sorted(rows) == sorted(queries.op3_mixing(spark, SF_DIR).collect())
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"] and r["size"] == len((docs[r.doc_id] or "").encode().split())
        by.setdefault(r.source, []).append(r)
    assert sum(r["size"] for r in rows) == pytest.approx(sum(group[0].target for group in by.values()))
    for group in by.values():
        assert group[0].source_size == sum(r["size"] for r in group)
        assert sum(r.taken for r in group) == round(group[0].target) and group[0].target <= 3 * group[0].source_size


def test_token_output(spark, docs):
    from tokenizers import Tokenizer

    want = brute.token_index(docs, Tokenizer.from_file(queries.tokenizer_path()))
    assert told(spark, "op4_token_output", "start", "n_tokens", "ids_crc32") == want


def test_language_of_held_out_documents(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"/root/testdata/sf0.01/documents.parquet").collect()}
    rows = queries.op5_language(spark, "/root/testdata/sf0.01").collect()
    held = [r for r in rows if r.held_out and langs[r.doc_id]]
    assert len(rows) == len(langs) and sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in rows) <= 0.02 * len(rows)


def test_simhash(spark, docs):
    assert told(spark, "op6_simhash", "fingerprint", "component_id") == brute.simhash_groups(docs)


def test_secrets(spark):
    docs = {r.doc_id: (r.text, r.source) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    columns = ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_example", "n_shared", "most_repos")
    assert told(spark, "op7_secrets", *columns) == brute.secret_rows(docs)


def test_suffix_array_dedup(spark, docs):
    assert told(spark, "op8_suffix_array_dedup", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.byte_repeats(docs)


def test_near_vectors(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()}
    assert told(spark, "op9_near_vectors", "n_links", "component_id", "kept") == brute.vector_links(vectors)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, name):
    import compare

    assert compare.differences(queries.QUERIES[name](spark, SF_DIR), compare.connect(SF_DIR), queries.ORACLES[name]) is None


def test_native_queries_run_no_python(spark):
    for name in ("op1_decontamination", "op7_secrets", "op10_chat"):
        plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop")), name
    assert chat.TURN
