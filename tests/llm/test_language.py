"""Rejection of what was not learned, bounded samples, and the scores against a plain computation."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import language, queries

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()


@pytest.mark.parametrize("left_out", ["de", "en", "es", "fr"])
def test_a_language_left_out_is_rejected(spark, docs, left_out):
    learned = docs.where(~queries.held_out(F.col("doc_id")))
    assert docs.where(F.col("lang") == left_out).count() > 50
    model = language.learn(learned.where(F.col("lang") != left_out))
    told = language.identify(docs.where(queries.held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")), model)
    by = {r.known: (r.n, r.gone) for r in told.groupBy((F.col("lang") != left_out).alias("known")).agg(F.count(F.lit(1)).alias("n"), F.count_if("rejected").alias("gone")).collect()}
    assert by[False][1] >= 0.9 * by[False][0] and by[True][1] <= 0.01 * by[True][0] + 1


def test_junk_and_other_languages_are_rejected(spark, docs):
    model = language.learn(docs)
    rows = [(0, "xqzv wkjj pqrt zzxx kqwj xzvq jjkw qqpz " * 5), (1, "Это предложение написано на русском языке, его нет среди выученных."), (2, "日本語の文章はここでは学習されていないので拒否されるべきです。"), (3, None), (4, "12 34")]
    told = language.identify(spark.createDataFrame(rows, "i int, text string"), model).collect()
    assert all(r.rejected for r in told) and {r.lang_pred for r in told if r.i > 2} == {"und"}


def test_copies_do_not_swell_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "train", lambda texts, langs, **fit: seen.append((texts, langs)))
    hot = spark.range(30_000).select(F.lit("a text that is everywhere").alias("text"), F.lit("en").alias("lang"))
    rest = spark.range(10_000).select(F.concat(F.lit("text "), F.col("id") % 5000, F.lit(" of many")).alias("text"), F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"))
    language.learn(hot.unionByName(rest), max_per_language=300)
    language.learn(rest.repartition(5).unionByName(hot), max_per_language=300)
    texts, langs = seen[0]
    assert len(texts) == len(set(texts)) and langs.count("en") == langs.count("de") == 300 and seen[1] == seen[0]
    monkeypatch.setattr(language, "MAX_ROWS", 100)
    language.learn(spark.range(3000).select(F.concat(F.lit("word "), F.col("id")).alias("text"), (F.col("id") % 1500).cast("string").alias("lang")))
    assert len(set(seen[2][1])) == 1500 == len(seen[2][0])


def test_predictions_are_those_of_a_plain_computation(spark, docs):
    """Subwords counted with a dictionary of bytes, the mean taken subword by subword."""
    model = language.learn(docs)
    told = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs.limit(40), model).collect()}
    for r in docs.limit(40).collect():
        if r.text is None or not any(c.isalpha() for c in r.text):
            continue
        letters = "".join(c if c.isalpha() else " " for c in r.text.lower())
        data = (" " + " ".join(letters.split()) + " " if letters[0] != " " and letters[-1] != " " else None)
        if data is None or any(c.isalpha() != (c not in " ") for c in letters):
            continue
        raw, mean, n = data.encode(), np.zeros(model.embed.shape[1]), 0
        for width in range(1, 5):
            for i in range(len(raw) - width + 1):
                code = int.from_bytes(raw[i : i + width], "little")
                bucket = ((code * 0x9E3779B1 + width) % 2**32 * 0x85EBCA77 % 2**32) >> 18
                mean += model.embed[bucket]
                n += 1
        logits = (mean / n @ model.weight + model.bias) / model.temperature
        odds = np.exp(logits - logits.max())
        assert told[r.doc_id][0] == model.languages[int(odds.argmax())] and abs(told[r.doc_id][1] - odds.max() / odds.sum()) < 1e-6
