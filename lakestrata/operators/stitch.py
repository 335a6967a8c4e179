"""Repair of delimited records that were broken over several physical lines.

The rule is greedy: lines are glued in order until the record has enough
fields, and the last character of the left part (the stray line end) is dropped
at each glue. That is sequential, but little passes from line to line: the
number of separators gathered so far (below ``min_fields``) and where the open
record began. So lines are cut into chunks that run in parallel:

1. per chunk, the outcome for every state it could start in;
2. the same per block of chunks, by chaining its chunks' outcomes, then per block of
   blocks, and so on until one block is left of each source;
3. back down level by level, the true start of every block and at last of every chunk;
4. per chunk, one replay from its true start.

Lines are in order by one number, or by a pair (block, row) as splits of a file give it:
then the chunks of a file block are chained first, the blocks of the file after them.

No step holds more than one chunk of lines or one block of outcome tables, and each
level is a ``block_chunks``-th of the one below, so the work follows the number of lines
however long a source is. A line that is complete on its own makes the outcome
independent of the start, so in healthy data the tables have one entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from lakestrata.session import cut_lineage

_POS = "struct<block:bigint,row:bigint>"
_OUTCOME = f"struct<state:int,completed:boolean,first:{_POS}>"


def _outcome(state: Column, completed: Column, first: Column) -> Column:
    return F.struct(state.alias("state"), completed.alias("completed"), first.alias("first")).cast(_OUTCOME)


def _start(state: Column, first: Column | None = None) -> Column:
    return _outcome(state, F.lit(False), F.lit(None) if first is None else first)


def _then(before: Column, after: Column) -> Column:
    """Outcome of two stretches of lines in a row."""
    first = F.when(after["completed"], after["first"]).otherwise(F.coalesce(before["first"], after["first"]))
    return _outcome(after["state"], before["completed"] | after["completed"], first)


def _read_line(before: Column, line: Column, limit: int) -> Column:
    gathered = before["state"] + line["seps"]
    full = gathered >= limit
    return _then(before, _outcome(
        F.when(full, 0).otherwise(gathered - line["lost"]), full, F.when(~full, line["pos"])
    ))


def _apply(before: Column, table: Column) -> Column:
    """Follow a start state through an outcome table (one entry = the same for every start)."""
    return _then(before, F.element_at(table, F.least(before["state"] + 1, F.size(table))))


def _chunk_table(lines: Column, limit: int) -> Column:
    every_start = F.transform(F.sequence(F.lit(0), F.lit(limit - 1)), lambda s: _start(s))
    full_lines = F.transform(lines, lambda line: (line["seps"] >= limit).cast("int"))
    last_full = F.size(lines) - F.array_position(F.reverse(full_lines), 1).cast("int") + 1
    has_full = F.array_contains(full_lines, 1)
    tail = F.when(has_full, F.slice(lines, last_full + 1, F.size(lines))).otherwise(lines)
    known_start = F.array(_outcome(F.lit(0), F.lit(True), F.lit(None)))
    return F.aggregate(
        tail, F.when(has_full, known_start).otherwise(every_start),
        lambda outcomes, line: F.transform(outcomes, lambda o: _read_line(o, line, limit)),
    )


def _block_table(tables: Column, limit: int) -> Column:
    def chain(start: Column) -> Column:
        return F.aggregate(tables, start, lambda acc, t: _apply(acc, t["ends"]))

    every_start = F.sequence(F.lit(0), F.lit(limit - 1))
    settled = F.exists(tables, lambda t: F.size(t["ends"]) == 1)
    return F.when(settled, F.array(chain(_start(F.lit(0))))).otherwise(
        F.transform(every_start, lambda s: chain(_start(s)))
    )


def _starts(tables: Column, start: Column) -> Column:
    """(key, start) of every entry of an ordered list of tables."""
    seen = F.array().cast(f"array<struct<key:bigint,start:{_OUTCOME}>>")
    return F.aggregate(
        tables, F.struct(start.alias("now"), seen.alias("seen")),
        lambda acc, t: F.struct(
            _apply(acc["now"], t["ends"]).alias("now"),
            F.concat(acc["seen"], F.array(F.struct(t["key"].alias("key"), acc["now"].alias("start")))).alias("seen"),
        ),
        lambda acc: acc["seen"],
    )


def _up(tables: DataFrame, by: list[str], limit: int, fan: int, low: int, high: int) -> tuple[list[DataFrame], DataFrame]:
    """Chain tables (``by``, key, ends) with keys from ``low`` to ``high`` level by level: the levels, and one table of each ``by``."""
    listed: list[DataFrame] = []
    while not listed or low != high:
        group = F.floor(F.col("key") / fan).cast("bigint")
        rows = F.sort_array(F.collect_list(F.struct("key", "ends"))).alias("_tables")
        listed.append(tables.groupBy(*by, group.alias("_group")).agg(rows))
        tables = listed[-1].select(*by, F.col("_group").alias("key"), _block_table(F.col("_tables"), limit).alias("ends"))
        low, high = low // fan, high // fan
    return listed, tables.drop("key")


def _down(listed: list[DataFrame], by: list[str], starts: DataFrame) -> DataFrame:
    """(``by``, key, start) of every table below the levels, from the start (``by``, _from) of each ``by``."""
    starts = listed[-1].join(starts, by)
    for below in [*reversed(listed[:-1]), None]:
        found = starts.select(*by, F.inline(_starts(F.col("_tables"), F.col("_from"))))
        if below is None:
            return found
        starts = below.join(found.select(*by, F.col("key").alias("_group"), F.col("start").alias("_from")), [*by, "_group"])


def _chunk_starts(tables: DataFrame, limit: int, fan: int, low: int, high: int, blocks: bool) -> DataFrame:
    """(_source, _block, key, start) of every chunk table."""
    by = ["_source", "_block"]
    inside, tops = _up(tables, by, limit, fan, low, high)
    if not blocks:
        return _down(inside, by, tops.select(*by, _start(F.lit(0)).alias("_from")))
    # one row per block of a file from here on
    rank = (F.row_number().over(Window.partitionBy("_source").orderBy("_block")) - 1).cast("bigint")
    tops = cut_lineage(tops.withColumn("key", rank))
    listed, whole = _up(tops.drop("_block"), ["_source"], limit, fan, 0, tops.agg(F.max("key")).first()[0] or 0)
    found = _down(listed, ["_source"], whole.select("_source", _start(F.lit(0)).alias("_from")))
    begins = tops.select(*by, "key").join(found, ["_source", "key"]).select(*by, F.col("start").alias("_from"))
    return _down(inside, by, begins)


def _ends(lines: Column, state: Column, limit: int) -> Column:
    """Numbers (from 1) of the lines that complete a record, in order."""

    # The numbers are gathered as text: an array would be copied entry by entry at every record.
    def add(acc: Column, line: Column) -> Column:
        gathered = acc["state"] + line["seps"]
        full = gathered >= limit
        number = acc["number"] + 1
        return F.struct(
            F.when(full, 0).otherwise(gathered - line["lost"]).alias("state"), number.alias("number"),
            F.when(full, F.concat(acc["ends"], number.cast("string"), F.lit(","))).otherwise(acc["ends"]).alias("ends"),
        )

    initial = F.struct(state.alias("state"), F.lit(0).alias("number"), F.lit("").alias("ends"))
    told = F.aggregate(lines, initial, add, lambda acc: F.split(acc["ends"], ","))
    # what follows the last comma is empty
    return F.transform(F.slice(told, 1, F.size(told) - 1), lambda n: n.cast("int"))


def _glued(lines: Column) -> Column:
    """Text of some lines in a row: the last character of the left part goes at each glue."""
    return F.aggregate(
        lines, F.lit(None).cast("string"),
        lambda acc, line: F.when(acc.isNull(), line["text"]).otherwise(
            F.concat(F.left(acc, F.length(acc) - 1), line["text"])
        ),
    )


def _whole(lines: Column, ends: Column, start: Column) -> Column:
    """Records that begin and end in the chunk: position of the first line, glued text."""
    begins = F.concat(F.array(F.lit(0)), ends)
    spans = F.arrays_zip(F.slice(begins, 1, F.size(ends)).alias("after"), ends.alias("end"))
    # the first end closes what an earlier chunk began
    spans = F.when(start["first"].isNull(), spans).otherwise(F.slice(spans, 2, F.size(ends)))
    return F.transform(spans, lambda span: F.struct(
        F.get(lines, span["after"])["pos"].alias("record"),
        _glued(F.slice(lines, span["after"] + 1, span["end"] - span["after"])).alias("piece"),
    ))


def _edges(lines: Column, ends: Column, start: Column) -> Column:
    """Pieces of records that cross the chunk's borders: position of the record's first line, glued text."""
    open_, closes = start["first"].isNotNull(), F.size(ends) > 0
    last = F.when(closes, F.element_at(ends, -1)).otherwise(0)
    begun = F.when(open_ & ~closes, start["first"]).otherwise(F.get(lines, last)["pos"])
    head = F.when(open_ & closes, F.struct(start["first"].alias("record"), _glued(F.slice(lines, 1, F.get(ends, F.lit(0)))).alias("piece")))
    tail = F.when(F.size(lines) > last, F.struct(begun.alias("record"), _glued(F.slice(lines, last + 1, F.size(lines))).alias("piece")))
    return F.array_compact(F.array(head, tail))


def stitch_records(
    lines: DataFrame, source: str, order: str, text: str, min_fields: int = 245,
    separator: str = ",", chunk_lines: int = 1024, block_chunks: int = 256, skip_blank: bool = True,
    header: str | None = None,
) -> DataFrame:
    """Complete records as (source, record_start, record).

    ``order`` is a bigint line position inside ``source``, or a struct (block, row) of two
    bigints; gaps are allowed, and a page and a line number combine as
    ``page * page_size + line``. What is left at
    the end of one page continues into the next. Blank lines carry nothing and are
    skipped; with ``skip_blank=False`` they are glued like others, which costs the open
    record its last character. Null lines are always skipped. The last record of a source is kept even when it stays short.
    ``record_start`` is the position of the record's first line, which orders the
    records without any global numbering.

    With ``header``, lines equal to it belong to no record wherever they stand, and a source
    without one is an error. The outcome tables of the chunks, one row per ``chunk_lines``
    lines, are kept in the shared folder, so the lines are read twice in all: for the tables
    and for the records.
    """
    limit = min_fields - 1
    line = F.col(text)
    blocks = isinstance(lines.schema[order].dataType, StructType)
    pos = F.col(order) if blocks else F.struct(F.lit(0).cast("bigint").alias("block"), F.col(order).cast("bigint").alias("row"))
    counted = (
        lines.where(F.length(line) > 0 if skip_blank else line.isNotNull())
        .select(
            F.col(source).alias("_source"), pos.cast(_POS).alias("pos"), line.alias("text"),
            (F.length(line) - F.length(F.replace(line, F.lit(separator), F.lit("")))).alias("seps"),
            line.endswith(separator).cast("int").alias("lost"), (line == F.lit(header) if header is not None else F.lit(False)).alias("head"),
        )
        .withColumns({"_block": F.col("pos")["block"], "_chunk": F.floor(F.col("pos")["row"] / chunk_lines).cast("bigint")})
    )
    chunk = ["_source", "_block", "_chunk"]

    def in_order(*fields: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(~F.col("head"), F.struct(*fields))))

    bare = [F.col("pos"), F.col("seps"), F.col("lost")]
    # The outcome tables read the separator counts only, never the text.
    chunk_tables = cut_lineage(
        counted.groupBy(*chunk).agg(in_order(*bare).alias("_lines"), F.max("head").alias("_headed"))
        .select("_source", "_block", F.col("_chunk").alias("key"), _chunk_table(F.col("_lines"), limit).alias("ends"), "_headed")
    )
    if header is not None:
        bad = chunk_tables.groupBy("_source").agg(F.max("_headed").alias("_headed")).where(~F.col("_headed")).first()
        if bad:
            raise ValueError(f"the files have different headers: {bad['_source']}")
    ends = chunk_tables.agg(F.min("key"), F.max("key")).first()
    chunk_starts = _chunk_starts(
        chunk_tables.drop("_headed"), limit, max(2, block_chunks), ends[0] or 0, ends[1] or 0, blocks
    ).select("_source", "_block", F.col("key").alias("_chunk"), F.col("start").alias("_start"))
    replayed = (
        counted.groupBy(*chunk).agg(in_order(*bare, F.col("text")).alias("_lines"))
        .join(chunk_starts, chunk)
        .select("_source", "_block", "_chunk", "_lines", "_start", _ends(F.col("_lines"), F.col("_start")["state"], limit).alias("_ends"))
    )
    told = F.col("_lines"), F.col("_ends"), F.col("_start")
    whole = replayed.select("_source", F.inline(_whole(*told)))
    # Only the few records that cross a chunk border move again.
    crossing = (
        replayed.select("_source", "_block", "_chunk", F.inline(_edges(*told))).groupBy("_source", "record")
        .agg(F.sort_array(F.collect_list(F.struct("_block", "_chunk", "piece"))).alias("_parts"))
        .select("_source", "record", F.aggregate(
            "_parts", F.lit(None).cast("string"),
            lambda acc, p: F.when(acc.isNull(), p["piece"]).otherwise(
                F.concat(F.left(acc, F.length(acc) - 1), p["piece"])
            ),
        ).alias("piece"))
    )
    return (
        whole.unionByName(crossing)
        .select(
            F.col("_source").alias(source), (F.col("record") if blocks else F.col("record")["row"]).alias("record_start"), F.col("piece").alias("record")
        )
    )
