"""Token files: a static range asymmetric numeral system over shared frequency tables."""

from __future__ import annotations

import os
import struct
import sys
import types
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from lakestrata.llm.common import give_back, shared_path, utf8

BITS = 20  # frequencies add up to 2^BITS
LOW = 1 << 31  # states are kept in [LOW, LOW << 32)
LANES = 1024  # interleaved states of a full block
BLOCK = 1 << 18  # tokens of a block
CHECK_STEPS = 128  # steps between checkpoints
PIECE_BYTES = 8 << 20  # text whose different words are looked up together
MAGIC = b"LSR1"
_HEAD = "<4sIIIII"  # magic, tokens, lanes, words, checkpoints, checksum of what follows
_CACHE_BYTES = 48 << 20  # of words and ids that a worker remembers
_ENTRY = 130  # bytes that keeping a word costs besides its own and its ids
_TAIL = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII punctuation that may end a word; an apostrophe may open a run of letters


def shared_table(counts: np.ndarray) -> np.ndarray:
    """Frequencies that add up to 2^BITS, at least 1 for every symbol that occurs; symbols are at most 2^(BITS-1)."""
    total = int(counts.sum())
    freq = np.where(counts > 0, np.maximum(1, counts.astype(object) * (1 << BITS) // max(1, total)), 0).astype(np.int64)
    if total:
        left = (1 << BITS) - int(freq.sum())
        for i in np.argsort(-freq, kind="stable"):
            step = left if left > 0 else max(left, 1 - int(freq[i]))
            freq[i] += step
            left -= step
            if not left:
                break
    return freq


class Coder:
    """Encodes and decodes blocks under one frequency table."""

    def __init__(self, freq: np.ndarray) -> None:
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint16 if len(freq) <= 1 << 16 else np.uint32), freq)
        self.filler = int(freq.argmax())

    def encode(self, ids: np.ndarray) -> bytes:
        """One block: lanes run down the tokens side by side, from the last step to the first, so that decoding runs forward."""
        lanes = int(min(LANES, max(1, len(ids) // 256)))
        steps = -(-len(ids) // lanes)
        grid = np.full(steps * lanes, self.filler)
        grid[: len(ids)] = ids
        freq, start = self.freq[grid].reshape(steps, lanes), self.start[grid].reshape(steps, lanes)
        most = freq << np.uint64(63 - BITS)
        state, words, checks = np.full(lanes, LOW, np.uint64), [], []
        for step in range(steps - 1, -1, -1):
            full = state >= most[step]
            words.append((state[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            state[full] >>= np.uint64(32)
            quotient, rest = np.divmod(state, freq[step])
            state = (quotient << np.uint64(BITS)) + rest + start[step]
            if step % CHECK_STEPS == 0:
                checks.append((len(words), state.astype("<u8")))
        words.reverse()
        before = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        body = b"".join(struct.pack("<I", before[steps - done]) + at.tobytes() for done, at in reversed(checks)) + b"".join(w.tobytes() for w in words)
        return struct.pack(_HEAD, MAGIC, len(ids), lanes, int(before[-1]), len(checks), zlib.crc32(body)) + body

    def decode(self, block: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
        """The tokens between two checkpoints (of all, if not told otherwise); each stretch can be decoded on its own."""
        magic, count, lanes, n_words, n_checks, checksum = struct.unpack_from(_HEAD, block)
        body = memoryview(block)[struct.calcsize(_HEAD) :]
        if magic != MAGIC or zlib.crc32(body) != checksum:
            raise ValueError("damaged token block")
        size = 4 + 8 * lanes
        words = np.frombuffer(body, "<u4", n_words, n_checks * size).astype(np.uint64)
        steps, mask = -(-count // lanes), np.uint64((1 << BITS) - 1)
        begin, end = first * CHECK_STEPS, min(steps, (n_checks if last is None else last) * CHECK_STEPS)
        if begin >= end:
            return np.zeros(0, np.int64)
        (at,) = struct.unpack_from("<I", body, first * size)
        state = np.frombuffer(body, "<u8", lanes, first * size + 4).astype(np.uint64)
        out = np.empty((end - begin, lanes), np.int64)
        for row in out:
            slot = state & mask
            row[:] = self.symbol[slot]
            state = self.freq[row] * (state >> np.uint64(BITS)) + slot - self.start[row]
            need = np.flatnonzero(state < np.uint64(LOW))
            state[need] = (state[need] << np.uint64(32)) | words[at : at + len(need)]
            at += len(need)
        return out.ravel()[: count - begin * lanes]


def _gather(flat: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries ``at`` of lists that lie in a row, again in a row, and their lengths."""
    starts, n = np.cumsum(lengths, dtype=np.int32) - lengths, lengths[at]
    ends = np.cumsum(n, dtype=np.int32)
    places = np.repeat(starts[at] - (ends - n), n)
    places += np.arange(len(places), dtype=np.int32)
    return flat[places], n


def _listed(words: pa.Array) -> list[bytes]:
    """An array of strings as bytes."""
    _, offsets, data = words.buffers()
    if not len(words) or data is None:
        return [b""] * len(words)
    at, data = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].tolist(), data.to_pybytes()
    return [data[a:b] for a, b in zip(at, at[1:])]


class _Letters(dict):
    """What the model reads for a letter, by code point; NUL where the letter has to be seen in its word."""

    def __init__(self, tokenizer) -> None:
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, code: int) -> str:
        letter = chr(code)
        plain = self.tokenizer.normalizer.normalize_str(letter)
        # Latin letters; the normalizer makes a letter and a mark of some
        simple = letter < "\u0250" and letter.isalpha() and len(plain) == 1 and plain.isalpha()
        self[code] = self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)[0][0] if simple else "\0"
        return self[code]


class Words:
    """Ids of runs as bytes, found when first asked for: the tokenizer drops white space and never looks across it.

    The different words of a piece of text are told by Arrow, so that each is looked at once
    in a piece, however often it occurs. Punctuation behind a letter is a run of its own,
    and ASCII letters are lower-cased anyway, so a word is one run or two; letters that the
    normalizer may turn into a letter and a mark stay with what follows them. Plain letters
    go to the model, which reads them as they are; anything else takes the whole tokenizer.
    What is known is kept in two generations of half ``_CACHE_BYTES`` each, runs, ids and
    their keeping counted; runs still in use are taken over into the younger one.
    """

    def __init__(self, tokenizer, kind: str) -> None:
        self.tokenizer, self.tokens, self.letters = tokenizer, tokenizer.model.tokenize, _Letters(tokenizer)
        self.kind, self.pack = kind, {2: "H", 4: "I"}[np.dtype(kind).itemsize]
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.size = 0

    def _parted(self, word: bytes) -> tuple[bytes, bytes]:
        """What of a word is looked up: a run, and the punctuation behind it."""
        if word.isalpha():
            return word.lower(), b""
        bare = word.rstrip(_TAIL)
        # special tokens are told before anything else
        if bare and len(bare) < len(word) and b"<|" not in word and (bare[-1:].isalpha() or self._plain(bare[-4:].decode(errors="ignore")[-1:])):
            return bare.lower() if bare.isalpha() else bare, word[len(bare) :]
        return word, b""

    def _plain(self, text: str) -> str:
        """What the model reads for a run of simple letters; nothing for any other."""
        read = text.translate(self.letters) if text.isalpha() else "\0"
        return "" if "\0" in read else read

    def _found(self, run: bytes) -> bytes:
        text = run.decode()
        read = text if run.isalpha() else self._plain(text)
        return array(self.pack, [t.id for t in self.tokens(read)] if read else self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _looked_up(self, runs: list[bytes]) -> list[bytes]:
        """Ids of different runs."""
        ids = list(map(self.young.get, runs))
        away = [i for i, x in enumerate(ids) if x is None]
        for i in away:
            run = runs[i]
            found = self.old.get(run)
            if found is None:
                found = self._found(run)
            if self.size > _CACHE_BYTES // 2:
                self.young, self.old, self.size = {}, self.young, 0
            ids[i] = self.young[run] = found
            self.size += len(run) + len(found) + _ENTRY
        return ids

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words in a row, and how many each has."""
        number: dict[bytes, int] = {b"": 0}
        runs, tails = [], []
        for run, tail in map(self._parted, words):
            runs.append(number.setdefault(run, len(number)))
            tails.append(number.setdefault(tail, len(number)) if tail else 0)
        packed = [b"", *self._looked_up(list(number)[1:])]
        lengths = np.fromiter(map(len, packed), np.int32, len(packed)) // np.dtype(self.kind).itemsize
        flat, n = _gather(np.frombuffer(b"".join(packed), self.kind), lengths, np.array([runs, tails], np.int32).T.ravel())
        return flat, n.reshape(-1, 2).sum(1, dtype=np.int32)

    def coded(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts (binary, none of them null) in a row, each text's followed by ``end``, and how many each text has."""
        parted = pc.ascii_split_whitespace(texts.cast(pa.binary()).view(pa.string()))
        bounds = np.asarray(parted.offsets) - parted.offsets[0].as_py()
        told = parted.flatten().dictionary_encode()
        flat, lengths = self._words(_listed(told.dictionary))
        at = np.insert(told.indices.to_numpy(), bounds[1:], len(lengths))
        ids, n = _gather(np.append(flat, np.array([end], self.kind)), np.append(lengths, np.int32(1)), at)
        return ids, np.add.reduceat(n, bounds[:-1] + np.arange(len(texts)), dtype=np.int64)

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text."""
        ids, n = self.coded(pa.array(texts, pa.binary()), 0)
        return [ids[stop - k : stop - 1].tobytes() for k, stop in zip(n, np.cumsum(n))]


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows in order, cut where their texts (column 1) reach ``PIECE_BYTES`` together."""
    before = np.cumsum(np.asarray(pc.binary_length(batch.column(1)), np.int64)) // PIECE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield batch.slice(a, b - a)


def _worker_state() -> dict:
    return sys.modules.setdefault("_lakestrata_worker_state", types.ModuleType("_lakestrata_worker_state")).__dict__


def worker_tokenizer(path: str):
    """The worker's tokenizer, read once."""
    held = _worker_state()
    if path not in held:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        held[path] = Tokenizer.from_file(path)
    return held[path]


def worker_words(path: str, kind: str) -> Words:
    """The words that the worker knows, from task to task of a tokenising stage."""
    held = _worker_state()
    if (path, kind) not in held:
        held[path, kind] = Words(worker_tokenizer(path), kind)
    return held[path, kind]


def forget_words() -> None:
    """What the stages behind the tokenising one do first: words are given back."""
    held = _worker_state()
    for key in [k for k in held if isinstance(k, tuple)]:
        del held[key]
    give_back()


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, kind: str, vocabulary: int, part_bytes: int, doc_id: str, text: str) -> DataFrame:
    """``(part, row, first, doc_id, n_tokens, ids, seen)`` in ascending id order: parts follow each other, rows inside a part too.

    The last row of a part is no document: its ``seen`` has the tokens of the part and how
    often each occurs, so that nothing has to be read again to count them.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    ordered = docs.select(F.col(doc_id).alias("doc_id"), utf8(F.col(text)).alias("text")).repartitionByRange(max(1, -(-total // part_bytes)), "doc_id").sortWithinPartitions("doc_id", "text")
    names = ["part", "row", "first", "doc_id", "n_tokens", "ids", "seen"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        words, part, row, first = worker_words(tokenizer, kind), TaskContext.get().partitionId(), 0, 0
        size, seen = np.dtype(kind).itemsize, np.zeros(vocabulary, np.int64)
        for batch in batches:
            id_kind = batch.schema.field(0).type
            for some in _pieces(batch):
                ids, lengths = words.coded(some.column(1), end_id)
                seen += np.bincount(ids, minlength=vocabulary)
                stops = np.cumsum(lengths)
                offsets = np.concatenate([[0], stops * size])
                packed = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(lengths), part, np.int64)), pa.array(np.arange(row, row + len(lengths))), pa.array(first + stops - lengths), some.column(0), pa.array(lengths), packed, pa.nulls(len(lengths), pa.binary())], names,
                )
                row, first = row + len(lengths), first + int(stops[-1])
        if row:
            used = np.flatnonzero(seen)
            told = used.astype("<i8").tobytes() + seen[used].astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([x], pa.int64()) for x in (part, -1, first)), pa.nulls(1, id_kind), pa.array([0], pa.int64()), pa.nulls(1, pa.binary()), pa.array([told], pa.binary())], names,
            )

    return ordered.mapInArrow(run, f"part bigint, row bigint, first bigint, doc_id {id_type}, n_tokens bigint, ids binary, seen binary")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, vocabulary: int = 49408, part_bytes: int = 16 << 20, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every text, end it with ``end_id``, and write all ids below ``path`` in ascending id order.

    ``path/table`` holds the shared frequencies, counted over all tokens; ``path/blocks``
    one row per block: ``part``, ``first`` (tokens of the part before it), ``n_tokens``,
    ``payload`` (header, checkpoints, words, checksum) and ``docs`` (id, row, offset in the
    document, tokens, whether the document ends here). A block holds whole documents of
    about ``BLOCK`` tokens together; a longer document has blocks of its own. Nothing but the frequencies, one row per
    vocabulary entry, passes the driver. The token ids are kept once in the shared folder
    between counting and coding, so a lost executor costs its own tasks only.

    A null text counts as empty and has the end id alone; rows with equal ids follow each
    other in text order, null ids come first; other columns are ignored; an empty table
    gives files without rows.
    """
    spark = docs.sparkSession
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    id_type = docs.schema[doc_id].dataType.simpleString()
    raw = shared_path(spark, "tokens")
    tokenised(docs, tokenizer, end_id, kind, vocabulary, part_bytes, doc_id, text).write.parquet(raw)
    stored = spark.read.parquet(raw)
    tokens = stored.where("seen is null").select("part", "row", "first", "doc_id", "n_tokens", "ids")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for told in batch.column(0).to_pylist():
                used, n = np.frombuffer(told, "<i8").reshape(2, -1)
                total[used] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["token", "n"])

    # a task adds up some parts, so that rows follow the text and not the number of parts
    told = stored.where("seen is not null").select("seen")
    told = told.coalesce(max(1, told.count() // 32))
    # one row per entry of the vocabulary at most
    seen = told.mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(vocabulary, np.int64)
    for row in seen:
        counts[row["token"]] = row["n"]
    freq = shared_table(counts)
    spark.createDataFrame([(int(t), int(freq[t])) for t in np.flatnonzero(freq)], "token bigint, freq bigint").coalesce(1).write.parquet(f"{path}/table")
    docs_type = f"array<struct<doc_id:{id_type},row:bigint,offset:bigint,n:bigint,ends:boolean>>"
    arrow_docs = pa.list_(pa.struct([("doc_id", tokens.select("doc_id").limit(0).toArrow().schema.field(0).type), ("row", pa.int64()), ("offset", pa.int64()), ("n", pa.int64()), ("ends", pa.bool_())]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        coder, held, index, size, at = Coder(freq), [], [], 0, None

        def block() -> pa.RecordBatch:
            ids = np.concatenate(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]]), pa.array([at[1]]), pa.array([len(ids)]), pa.array([coder.encode(ids)], pa.binary()), pa.array([index], arrow_docs)],
                ["part", "first", "n_tokens", "payload", "docs"],
            )

        for batch in batches:
            for part, row, first, doc, ids in zip(*(c.to_pylist() for c in batch.columns[:4]), batch.column(5)):
                ids = np.frombuffer(ids.as_buffer(), kind)
                if held and (at[0] != part or at[1] + size != first):
                    yield block()
                    held, index, size = [], [], 0
                if held and len(ids) > 2 * BLOCK:
                    yield block()
                    held, index, size = [], [], 0
                step = BLOCK if len(ids) > 2 * BLOCK else len(ids)
                for cut in range(0, len(ids), step):
                    piece = ids[cut : cut + step]
                    if not held:
                        at = part, first + cut
                    held.append(piece.copy())
                    index.append({"doc_id": doc, "row": row, "offset": cut, "n": len(piece), "ends": cut + step >= len(ids)})
                    size += len(piece)
                    if size >= BLOCK or step < len(ids):
                        yield block()
                        held, index, size = [], [], 0
        if held:
            yield block()

    tokens.mapInArrow(encode, f"part bigint, first bigint, n_tokens bigint, payload binary, docs {docs_type}").write.option("compression", "none").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, vocabulary: int = 49408) -> DataFrame:
    """Decode the files of :func:`write_tokens`: ``doc_id, start, n_tokens, ids_crc32`` per document, in no order.

    Blocks are decoded side by side; checksums are verified and a damaged block is an
    error. Checksums of documents that run over several blocks are folded from those of
    their pieces. ``start`` adds up the tokens of the parts before, by blocks of parts.
    """
    freq = np.zeros(vocabulary, np.int64)
    for row in spark.read.parquet(f"{path}/table").collect():
        freq[row["token"]] = row["freq"]
    blocks = spark.read.parquet(f"{path}/blocks")
    item = blocks.schema["docs"].dataType.elementType
    id_type = item["doc_id"].dataType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        coder = Coder(freq)
        for batch in batches:
            for k in range(batch.num_rows):
                payload, index = batch.column(2)[k].as_py(), batch.column(3)[k].values
                ids = coder.decode(payload).astype("<u4")
                lengths = index.field("n").to_numpy()
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[e - n : e].tobytes()) for n, e in zip(lengths.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(crc), batch.column(0)[k].as_py())), *(index.field(x) for x in ("row", "doc_id")), pa.array(batch.column(1)[k].as_py() + ends - lengths), *(index.field(x) for x in ("offset", "n", "ends")), pa.array(crc, pa.int64())],
                    ["part", "row", "doc_id", "at", "offset", "n", "ends", "crc"],
                )

    def pieces(some: DataFrame) -> DataFrame:
        return some.select("part", "first", "payload", "docs").mapInArrow(
            decode, f"part bigint, row bigint, doc_id {id_type}, at bigint, offset bigint, n bigint, ends boolean, crc bigint"
        )

    # Blocks of one long document have no whole one, so each block is decoded once.
    long = F.exists("docs", lambda d: (d["offset"] > 0) | ~d["ends"])

    def fold(group: pa.Table) -> pa.Table:
        group = group.sort_by("offset")
        crc = 0
        for n, own in zip(group.column("n").to_pylist(), group.column("crc").to_pylist()):
            blank = bytes(4 * n)
            crc = zlib.crc32(blank, crc) ^ zlib.crc32(blank) ^ own
        return pa.table({"part": group["part"].slice(0, 1), "doc_id": group["doc_id"].slice(0, 1), "at": group["at"].slice(0, 1), "n": pa.array([sum(group["n"].to_pylist())], pa.int64()), "crc": pa.array([crc], pa.int64())})

    docs = pieces(blocks.where(~long)).select("part", "doc_id", "at", "n", "crc").unionByName(
        pieces(blocks.where(long)).groupBy("part", "row").applyInArrow(fold, f"part bigint, doc_id {id_type}, at bigint, n bigint, crc bigint")
    )
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("set", F.floor(F.col("part") / 1024))
    sets = parts.groupBy("set").agg(F.sum("n").alias("n"))
    before = Window.orderBy("set").rowsBetween(Window.unboundedPreceding, -1)
    sets = sets.select("set", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("set").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(sets, "set").select("part", (F.col("base") + F.col("inside")).alias("base"))
    return docs.join(starts, "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
