"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import random
import time

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import automaton, chat, decontam, language, mixing, near_vectors, queries, rans, repeats, secrets, simhash, suffixes
from lakestrata.llm.common import shared_path, stored

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = ("fp", "block", "words", "size", "u", "dirty", "gone", "mix_size", "letters", "v", "parts", "target", "row", "a.b")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(("ba", "ko", "ti", "lu", "men", "sor")) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    long, shared = prose(1, 30_000), prose(2, 60)
    return [
        (1, shared + " " + prose(3, 30), "en", "a", 0), (2, prose(4, 30) + " " + shared, "en", "a", 0), (3, None, None, None, None), (4, "", "en", "b", 0),
        (5, "one", "en", "b", 3), (6, long, "en", "b", 0), (7, long[:70_000] + " end", "en", None, 0), (8, "x " * 200, "de", "c", 0), (9, "x " * 300, "de", "c", 0),
        (10, " \t\n", "de", "c", 0), (11, "é" * 70, "fr", "c", 0), (12, "ß é" * 40 + " " + "é" * 70, "fr", "c", 0), (None, shared, "en", "a", 0), (None, "12 34", None, "a", 0),
    ]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="module")
def clashing(docs):
    return docs.select("*", *(F.lit(7).alias(c) for c in CLASH))


def plain(rows):
    return {d: t for d, t, *_ in rows if d is not None}


def test_word_repeats(spark, rows, docs, clashing):
    want = brute.word_repeats(plain(rows))
    for table in (docs, clashing):
        got = {r[0]: tuple(r[1:]) for r in automaton.remove_repeats(table).collect() if r[0] is not None}
        assert got == want
    assert automaton.remove_repeats(docs.limit(0)).count() == 0
    kept = {r.doc_id: r.kept for r in automaton.remove_repeats(docs, keep_text=True).collect()}
    assert kept[1] == " ".join(rows[0][1].split()) and len(kept[2].split()) == 30


def test_byte_repeats(spark, rows, docs, clashing):
    want = brute.byte_repeats(plain(rows))
    for table in (docs, clashing):
        got = {r[0]: tuple(r[1:]) for r in suffixes.remove_repeats(table).collect() if r[0] is not None}
        assert got == want
    assert suffixes.remove_repeats(docs.limit(0)).count() == 0


def test_repeated_rows_are_not_earlier_than_each_other(spark):
    twice = spark.createDataFrame([(1, prose(9, 50)), (1, prose(9, 50)), (2, prose(9, 50))], "doc_id bigint, text string")
    assert sorted(r.n_removed for r in automaton.remove_repeats(twice).collect()) == [0, 0, 50]
    assert sorted(r.n_removed > 0 for r in suffixes.remove_repeats(twice).collect()) == [False, False, True]


@pytest.mark.parametrize("seed", range(3))
def test_repeats_of_random_texts(spark, seed):
    """Few symbols, so that runs repeat inside and across documents, and blocks and shards are many."""
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("ab") for _ in range(rng.randint(5, 60))) for _ in range(12)]
    docs = {i: rng.choice((" ", "  ", "\n")).join(rng.choice(pool) for _ in range(rng.randint(0, 6))) for i in range(60)}
    table = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    small = {"block_bytes": 300, "shard_bytes": 500}
    assert {r[0]: tuple(r[1:]) for r in automaton.remove_repeats(table, **small).collect()} == brute.word_repeats(docs)
    assert {r[0]: tuple(r[1:]) for r in suffixes.remove_repeats(table, **small).collect()} == brute.byte_repeats(docs)


@pytest.mark.parametrize("limit", [1, 5])
def test_hot_keys_are_parted(spark, monkeypatch, limit):
    """One passage in most documents between different neighbours, twice in some; no shard compares what it holds together."""
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", limit)
    passage = prose(5, 40)
    docs = {i: " ".join([prose(100 + i, 12), passage, prose(300 + i, 12)] * (2 if i % 9 == 0 else 1)) if i % 3 else prose(500 + i, 50) for i in range(90)}
    table = spark.createDataFrame(list(docs.items()) + [(7, docs[7])], "doc_id bigint, text string")
    small = {"block_bytes": 4000, "shard_bytes": 3000}
    assert {r[0]: tuple(r[1:]) for r in automaton.remove_repeats(table, **small).collect()} == brute.word_repeats(docs)
    assert {r[0]: tuple(r[1:]) for r in suffixes.remove_repeats(table, **small).collect()} == brute.byte_repeats(docs)


def test_windows_of_hot_keys_are_sent_once_per_block():
    spec = repeats.Spec(True, 20, 8, True)
    words = [prose(i, 5).encode().split() + prose(99, 40).encode().split() for i in range(200)]
    rows = [repeats.Row(i, b" ".join(w), w) for i, w in enumerate(words)]
    row = np.arange(200)
    sent, again = repeats._windows(rows, spec, row, row, np.zeros(200, np.int64), np.full(200, 26))
    # 21 windows lie inside the passage and are sent by the first document alone, 5 reach into the words before it
    assert len({w[4] for w in sent}) == len(sent) and len(sent) + len(again[0]) == 200 * 26 and len(again[0]) >= 199 * 21 and len(sent) > 21 + 200 * 3


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(97, 97 + k, n, dtype=np.uint8)) for k in (1, 2, 3, 20) for n in (1, 50, 51, 60, 90)] + [b"\0" * 60, b"\xff" * 55]
    counts = np.array([max(1, len(t) - 49) for t in texts])
    order, text = suffixes.suffix_array(texts, counts, 50)
    assert len(order) == counts.sum()
    parts = [texts[o][p - text.begin[o] :][:50].ljust(50, b"\0") for p, o in zip(order, text.owner[order])]
    assert parts == sorted(parts)
    shared = suffixes.common_prefixes(text, order, 50)
    for a, b, n in zip(parts, parts[1:], shared[1:]):
        assert n == next((i for i in range(50) if a[i] != b[i]), 50)


def test_matching_statistics():
    machine = automaton.SuffixAutomaton()
    assert machine.read(list("abcab")) == [0, 0, 0, 1, 2]
    assert machine.read(list("xabca")) == [0, 1, 2, 3, 4]
    assert machine.read(list("abcab")) == [1, 2, 3, 4, 5]


def test_simhash(spark, rows, docs, clashing):
    got = {r.doc_id: r.component_id for r in simhash.near_groups(clashing).collect() if r.doc_id is not None}
    want = {d: c for d, (_, c) in brute.simhash_groups(plain(rows)).items()}
    assert got == want and got[10] == got[4] == 3
    assert simhash.near_groups(docs.limit(0)).count() == 0
    kept = {r.doc_id for r in simhash.deduplicate(clashing).select("doc_id").collect()}
    assert {1, 2, 5, 6} <= kept and 10 not in kept and None in kept and simhash.deduplicate(clashing).columns == clashing.columns


@pytest.mark.parametrize("radius,shard_rows", [(2, 4), (2, 1024), (6, 4)])
def test_gray_index_finds_all_links(spark, radius, shard_rows):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    codes = np.unique(np.concatenate([base[rng.integers(0, 40, 400)] ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)), base]))
    index = simhash.GrayIndex(codes)
    links = [(int(i), int(j)) for i, c in enumerate(index.codes) for j in np.flatnonzero(np.bitwise_count(index.codes ^ c) <= radius)]
    assert index.groups(radius).tolist() == list(brute.roots(range(len(codes)), links).values())
    frame = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp bigint")
    keys = simhash._shard_keys(len(codes), radius, shard_rows)
    met = frame.select("fp", F.explode(F.array(*keys)).alias("k"))
    pairs = met.alias("x").join(met.alias("y"), F.expr("x.k = y.k")).select(F.col("x.fp"), F.col("y.fp")).distinct().collect()
    found = {(a, b) for a, b in pairs if bin((a ^ b) & (1 << 64) - 1).count("1") <= radius}
    signed = index.codes.view(np.int64).tolist()
    assert found == {(signed[i], signed[j]) for i, j in links}


def test_near_copies_go_and_others_stay(spark):
    rng, docs = random.Random(3), []
    for k in range(30):
        words = prose(100 + k, 400).split()
        docs.append((2 * k, " ".join(words)))
        for i in rng.sample(range(400), 4):
            words[i] = "changed"
        docs.append((2 * k + 1, " ".join(words)))
    kept = {r.doc_id for r in simhash.deduplicate(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert set(range(0, 60, 2)) <= kept and len(kept) <= 33


def test_mixing(spark, docs, clashing):
    assert mixing.mix(docs.limit(0)).count() == 0
    found = mixing.mix(clashing).collect()
    assert len(found) == 14 and {r.taken for r in found if r["size"] == 0} == {0}
    out = mixing.mixed(clashing)
    assert out.columns == clashing.columns
    clear = clashing.where("doc_id is not null")
    out, found, words = mixing.mixed(clear), mixing.mix(clear).collect(), {}
    for r in out.collect():
        words[r.source] = words.get(r.source, 0) + len(r.text.encode().split())
    assert words == {r.source: round(r.target) for r in found if r.target}


def test_water_filling(spark):
    def targets(sizes, weights, cap):
        rows = [(chr(97 + i // 26) + chr(97 + i % 26), n) for i, n in enumerate(sizes)]
        found = mixing.water_fill(spark.createDataFrame(rows, "source string, size bigint"), weights, cap).orderBy("source").collect()
        for r in found:
            assert r.whole * r.source_size + r.need == round(r.target) and 0 <= r.need <= r.source_size
        return [r.target for r in found]

    assert targets([100, 10, 890], (5, 2, 1), 3) == [300, 30, 670]
    assert targets([], (1,), 3) == [] and targets([0, 0], (1, 1), 3) == [0, 0]
    rng = random.Random(3)
    for n in (1, 7, 60):
        sizes = [rng.choice((0, 1, 50, 10**6, 10**12)) + rng.randrange(9) for _ in range(n)]
        for weights, cap in (((5, 2, 1), 3), ((1,), 2), ((7, 1), 1)):
            want = brute.water_fill(sizes, [weights[i % len(weights)] for i in range(n)], cap)
            assert targets(sizes, weights, cap) == [float(t) for t in want]


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_mixture_equals_the_plain_version(spark, docs, clashing, monkeypatch, broadcast):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", broadcast)
    many = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 37).alias("source"), F.array_join(F.array_repeat(F.lit("w"), (F.col("id") % 11).cast("int")), " ").alias("text"))
    for table in (many, clashing.where("doc_id is not null")):
        rows = table.select("doc_id", "source", F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")), F.xxhash64(F.lit(17), "doc_id")).collect()
        got = {r.doc_id: (r["size"], r.source_size, r.target, r.taken) for r in mixing.mix(table).collect()}
        assert got == brute.mixture([tuple(r) for r in rows])


def test_repeated_rows_share_the_edge(spark):
    table = spark.createDataFrame([(i // 4, "w " * 10, s) for i in range(40) for s in "ab"], "doc_id bigint, text string, source string")
    rows = mixing.mix(table).collect()
    for s in "ab":
        group = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in group) - group[0].target) <= 4


def test_token_files(spark, rows, docs, clashing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    path = shared_path(spark, "test")
    rans.write_tokens(clashing.where("doc_id is not null"), path, queries.tokenizer_path(), part_bytes=1000)
    assert {r[0]: tuple(r[1:]) for r in rans.read_tokens(spark, path).collect()} == brute.token_index(plain(rows), tokenizer)
    path = shared_path(spark, "test")
    rans.write_tokens(docs.limit(0), path, queries.tokenizer_path())
    assert rans.read_tokens(spark, path).count() == 0
    path = shared_path(spark, "test")
    rans.write_tokens(docs, path, queries.tokenizer_path())
    assert rans.read_tokens(spark, path).count() == 14


@pytest.mark.parametrize("n,symbols", [(1, 1), (5, 3), (511, 2), (70_000, 500), (300_000, 49_408)])
def test_rans_round_trip(n, symbols):
    rng = np.random.default_rng(n)
    ids = (symbols * rng.random(n) ** 3).astype(np.int64)
    coder = rans.Coder(rans.shared_table(np.bincount(ids, minlength=symbols)))
    block = coder.encode(ids)
    assert (coder.decode(block) == ids).all()
    count = -(-(-(-n // min(1024, max(1, n // 256)))) // rans.CHECK_STEPS)
    assert (np.concatenate([coder.decode(block, k, k + 1) for k in range(count)]) == ids).all()
    damaged = bytearray(block)
    damaged[-1] ^= 1
    with pytest.raises(ValueError):
        coder.decode(bytes(damaged))


def test_tokens_over_several_blocks(spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(rans, "BLOCK", 50)
    docs = {i: prose(i, 40 * (i % 3)) for i in range(9)}
    path = shared_path(spark, "test")
    rans.write_tokens(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string"), path, queries.tokenizer_path())
    want = brute.token_index(docs, Tokenizer.from_file(queries.tokenizer_path()))
    assert {r[0]: tuple(r[1:]) for r in rans.read_tokens(spark, path).collect()} == want


def test_words_match_the_whole_tokenizer():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    words = rans.Words(tokenizer, "<u2")
    texts = ["", "İstanbul ΣΑΣ ﬁ don't I'LL x's, a!, <|endoftext|>, <|ENDOFTEXT|>. ٣٤ 你好,世界. \x1c\x1fz ªº ǅ ⅷ", "a.b.c, d..,e ,. .,. ’tis 'S. l’été, naïve. ß ẞ"]
    rng = random.Random(1)
    for _ in range(500):
        texts.append("".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x250), rng.randrange(0x300, 0x400), 32, 10])) for _ in range(30)))
    for text, ids in zip(texts, words.ids([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_letters_before_punctuation_match_the_whole_tokenizer(monkeypatch):
    """Every code point before a comma and a full stop, alone and behind another letter; the cache is dropped many times."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(rans, "_CACHE_BYTES", 1 << 20)
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    words = rans.Words(tokenizer, "<u2")
    points = [chr(c) for c in [*range(33, 0xD800), *range(0xE000, 0x30000, 7)]]
    for at in range(0, len(points), 4096):
        some = [f"{before}{p}{after}" for p in points[at : at + 4096] for before, after in (("", ","), ("ab", "."), ("É", ",x"), ("", "!?"))]
        want = [e.ids for e in tokenizer.encode_batch(some, add_special_tokens=False)]
        assert [np.frombuffer(ids, "<u2").tolist() for ids in words.ids([t.encode() for t in some])] == want


def test_runs_of_a_piece_are_found_once(monkeypatch):
    """However often a word comes and however little is remembered."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(rans, "_CACHE_BYTES", 1 << 10)
    tokenizer, asked = Tokenizer.from_file(queries.tokenizer_path()), []
    words, found = rans.Words(tokenizer, "<u2"), rans.Words._found
    monkeypatch.setattr(rans.Words, "_found", lambda self, run: asked.append(run) or found(self, run))
    names = [f"w{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}" for i in range(100)]
    texts = ["", " \n", *(" ".join(names).title() + ", \t" for _ in range(20)), "\x0bé\x0c", " ".join(f"{n}!" for n in names)]
    got = words.ids([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(asked) == sorted({*(n.encode() for n in names), "é".encode(), b",", b"!"})
    assert words.ids([b"", b" "]) == [b"", b""] and words.ids([]) == []


def test_language(spark, docs, clashing):
    nothing = language.learn(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
    model = language.learn(docs)
    rows = language.identify(clashing, model).collect()
    assert len(rows) == 14 and {r.lang_pred for r in rows if not any(c.isalpha() for c in r.text or "")} == {"und"}
    assert language.identify(clashing.withColumn("score", F.lit("x")), model).columns[-3:] == ["lang_pred", "score", "rejected"]


def test_decontamination(spark, rows, docs, clashing):
    item = rows[0][1].split()[5:45]
    changed = " ".join("other" if i % 9 == 4 else w for i, w in enumerate(item))
    bench = spark.createDataFrame([(1, changed), (2, prose(77, 30)), (3, None), (4, ""), (None, "x y"), (1, changed)], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.contamination(clashing, bench).collect()}
    assert found == brute.overlaps(plain(rows), {1: changed, 2: prose(77, 30)}) == {(1, 1), (2, 1)}
    assert decontam.contamination(docs, bench, min_tokens=41).count() == 0 and decontam.contamination(docs, bench, min_tokens=40).count() == 2
    assert decontam.contamination(docs.limit(0), bench).count() == 0 and decontam.contamination(docs, bench.limit(0)).count() == 0
    left = decontam.decontaminate(clashing, bench)
    assert left.columns == clashing.columns and left.count() == 12


def test_decontamination_without_broadcast(spark, docs, monkeypatch):
    bench = docs.where("doc_id = 1").selectExpr("doc_id as item_id", "text")
    want = decontam.contamination(docs, bench).collect()
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    assert sorted(decontam.contamination(docs, bench).collect()) == sorted(want) and want


def test_secrets(spark):
    key = "AKIA" + "ABCDEFGH12345678"
    texts = [
        (1, f"é𝄞 password = 'hunter2hunter2x' {key}", "a"), (2, f"token=short; seen hunter2hunter2x and {key}", "b"), (3, None, None), (4, "", "c"), (5, f"{key} {key}", "c"),
        (5, f"{key} {key}", "c"), (6, "token=secret: abcdefghijklmnop 0123456789abcdef0", "a"), (None, "api_key:AAAAAAAAAAAA", "a"), (8, "a" * 20_000, "a"),
    ]
    table = spark.createDataFrame(texts, "doc_id bigint, text string, source string").select("*", *(F.lit(1).alias(c) for c in ("base", "value", "repo", "owner", "same")))
    rows = secrets.scan(table).collect()
    assert len(rows) == 9
    for r in rows:
        text = next(t for d, t, _ in texts if d == r.doc_id)
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == brute.base_digest(text)
    by = {r.doc_id: r for r in rows}
    assert by[2].spans == "seen:18:33,access:38:58" and by[1].n_example == 1 and by[5].n_example == 2
    # the password is pasted bare under a second owner
    assert by[1].n_shared == 1 and by[1].n_live == 0 and by[1].most_repos == 3
    assert secrets.scan(table.limit(0)).count() == 0


def test_secrets_of_texts_with_many_runs(spark):
    """Over a thousand matches in a text, values pasted bare under many owners, runs of a megabyte."""
    rng = random.Random(5)
    pool = ["".join(rng.choice("abcXYZ019_/") for _ in range(rng.choice((11, 12, 20)))) for _ in range(40)]
    docs = {}
    for i in range(30):
        parts = [rng.choice((f"token={v}", v, f"x {v};", "9" * rng.randint(1, 14), "AKIA" + "Z9" * rng.randint(5, 9))) for v in rng.choices(pool, k=600 if i % 10 == 0 else 5)]
        docs[i] = (rng.choice((" ", "\n", ", ")).join(parts), rng.choice("abcd"))
    table = spark.createDataFrame([(d, *t) for d, t in docs.items()], "doc_id bigint, text string, source string")
    columns = ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_example", "n_shared", "most_repos")
    assert {r.doc_id: tuple(r[c] for c in columns) for r in secrets.scan(table).collect()} == brute.secret_rows(docs)
    started = time.time()
    long = [(1, " ".join(str(100_000 + i) for i in range(150_000)), "a"), (2, "x" * 1_000_000, "a"), (3, " ".join(str(10**13 + i) for i in range(60_000)), "a"), (4, "token=" + "a1" * 500_000, "a")]
    found = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(long, "doc_id bigint, text string, source string")).collect()}
    assert found[4].n_assign == 1 and found[1].spans == found[2].spans == "" and found[3].n_hex == 0 and time.time() - started < 60


def test_near_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(40, 8))
    near = base[rng.integers(0, 40, 200)] + rng.normal(size=(200, 8)) * 0.15
    rows = {i: v.tolist() for i, v in enumerate([*base, *near, *near[:20], *(near[20:40] * 3)])}
    rows |= {500: None, 501: [], 502: [0.0] * 8, 503: [float("nan")] + [1.0] * 7, 504: [None] + [1.0] * 7, 505: [float("inf")] * 8, 506: [1.0, 2.0], 507: [2.0, 4.0], 508: [0.0] * 8, 509: [1e-30, 2e-30], 510: [-0.0, 1.0], 511: [0.0, 1.0]}
    table = spark.createDataFrame(list(rows.items()), "vec_id bigint, embedding array<float>").select("*", *(F.lit(1).alias(c) for c in ("v", "key", "cell", "first")))
    exact = {r.vec_id: r.embedding for r in table.collect()}
    for tile_rows in (2048, 16):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors.near_vectors(table, tile_rows=tile_rows).collect()}
        assert got == brute.vector_links(exact)
    assert near_vectors.near_vectors(table.limit(0)).count() == 0


def clustered(rows: int, width: int = 8) -> dict[int, list]:
    rng = np.random.default_rng(5)
    base = rng.normal(size=(rows // 8, width))
    near = base[rng.integers(0, len(base), rows - len(base) - 1)] + rng.normal(size=(rows - len(base) - 1, width)) * 0.2
    return {i: v.tolist() for i, v in enumerate([*base, *near, near[0]])}


def test_near_vectors_of_many_slabs_are_not_copied_for_each(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "HELD", 2)
    monkeypatch.setattr(near_vectors, "SLAB_TILES", 2)
    rows, plans = clustered(600), []

    def watched(df):
        out = stored(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(near_vectors, "stored", watched)
    table = spark.createDataFrame(list(rows.items()), "vec_id bigint, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors.near_vectors(table, tile_rows=16).collect()}
    assert got == brute.vector_links(rows)
    # about 20 slabs meet: their rows are read where they are stored, and dealt out once
    assert any("CartesianProduct" in plan for plan in plans) and not any("explode" in plan for plan in plans)
    assert sum(plan.count("shufflepartitionidpassthrough") > 0 for plan in plans) == 1


def test_near_vectors_with_one_hash(spark, monkeypatch):
    rows = {0: [1.0, 0.0], 1: [0.99, 0.01], 2: [0.0, 1.0], 3: [-1.0, 0.0], 4: [1.0, 0.0]}
    other = near_vectors._hash
    monkeypatch.setattr(near_vectors, "_hash", lambda v, seed: other(v, seed) if seed else F.lit(7).cast("bigint") + F.size(v) * 0)
    table = spark.createDataFrame(list(rows.items()), "vec_id bigint, embedding array<float>")
    exact = {r.vec_id: r.embedding for r in table.collect()}
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors.near_vectors(table).collect()} == brute.vector_links(exact)


def test_tile_links():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 16))
    sides = [base[rng.integers(0, 12, n)] + rng.normal(size=(n, 16)) * np.repeat([0.05, 0.3], n // 2)[:, None] for n in (1400, 900)]
    slabs = []
    for k, rows in enumerate(sides):
        order, ends = near_vectors.neighbourhoods(rows)
        sides[k] = rows[order]
        slabs.append(near_vectors.slab_of(sides[k], ends))
    assert len(slabs[0].ends) > 2
    for bound in (0.95, 0.5, -0.2):
        a, b = (near_vectors.unit_rows(x) for x in sides)
        want = set(zip(*(x.tolist() for x in np.nonzero(np.einsum("id,jd->ij", a, b) >= bound))))
        for share in (0.0, 1.0):
            found = [(i, j) for left, right in near_vectors.tile_links(*slabs, bound, share) for i, j in zip(left.tolist(), right.tolist())]
            assert len(found) == len(set(found)) and set(found) == want


def test_quantisation_bound_is_rigorous():
    rng = np.random.default_rng(1)
    x = near_vectors.unit_rows(rng.normal(size=(300, 33)) * np.exp(rng.normal(size=(300, 33))))
    codes, scale, error = near_vectors.quantised(x)
    about = (codes.astype(np.int64) @ codes.T.astype(np.int64)) * scale[:, None] * scale
    assert (np.abs(x @ x.T - about) <= error[:, None] + error + error[:, None] * error + 1e-12).all()


def test_chat(spark):
    rows = [(1, 0, "user", "a < b & [INST] </s>"), (1, 1, "assistant", "&l; <|end|>"), (1, 1, "assistant", None), (2, None, None, "x\ny"), (None, 0, "assistant", ""), (3, 0, "assistant", "𝄞é" * 5000), (1, 1, "assistant", None)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("turns", F.lit(1)).withColumn("rows", F.lit(1))
    convs = chat.conversations(table)
    out = chat.formatted(convs.withColumn("parts", F.lit(3)))
    read = {r.conv_id: r for r in out.select("conv_id", "turns", "parts", chat.read_back(F.col("formatted")).alias("back"), chat.learned(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert len(read) == 4 and all(r.back == r.turns and r.parts == 3 for r in read.values())
    assert read[1].loss == "&l; <|end|>" and read[3].loss == "𝄞é" * 5000 and read[2].loss == ""
    assert chat.conversations(table.limit(0)).count() == 0


def test_layouts(spark):
    records = [
        ('{"messages":[{"role":"user","content":"q"},{"content":"a","role":"assistant"}]}', [("user", "q"), ("assistant", "a")]),
        ('{"conversations":[{"from":"user","value":"q"}]}', [("user", "q")]), ('{"prompt":"q","completion":"a"}', [("user", "q"), ("assistant", "a")]),
        ('{"instruction":"i","input":"x","output":"a"}', [("user", "i\nx"), ("assistant", "a")]), ('{"instruction":"i","output":"a"}', [("user", "i"), ("assistant", "a")]),
        ('{"other":1}', None), ("broken", None), (None, None),
    ]
    table = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(records)], "i int, record string").withColumn("v", F.lit(5))
    got = {r.i: r for r in chat.canonical(table).collect()}
    for i, (_, want) in enumerate(records):
        assert (None if got[i].turns is None else [tuple(t) for t in got[i].turns]) == want and got[i].v == 5
