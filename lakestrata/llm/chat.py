"""Chat formatting: heterogeneous records to canonical turns by schema fingerprint, then to one marked text. All native."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.llm.common import named, spare

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: Every control string, ours or another template's, starts with one of these; escaped they can't.
ESCAPES = (("&", "&a;"), ("<", "&l;"), ("[", "&b;"))


def escape(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for plain, code in ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(code))
    return out


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


TURNS = "array<struct<role:string,text:string>>"


def _turns(role: str, text: str, path: str) -> str:
    """SQL of a mapping for a list of messages."""
    kind = f"array<struct<{role}:string,{text}:string>>"
    return f"transform(try_variant_get(v, '$.{path}', '{kind}'), m -> named_struct('role', m.{role}, 'text', m.{text}))"


def _pair(user: str, assistant: str) -> str:
    """SQL of a mapping for one question and one answer."""
    part = lambda role, field: f"named_struct('role', '{role}', 'text', try_variant_get(v, '$.{field}', 'string'))"
    return f"array({part('user', user)}, {part('assistant', assistant)})"


#: Declarative mappings: the field paths of a layout → how its canonical turns are read. ``v`` is the record.
LAYOUTS = {
    ("messages[].content", "messages[].role"): _turns("role", "content", "messages"),
    ("conversations[].from", "conversations[].value"): _turns("from", "value", "conversations"),
    ("completion", "prompt"): _pair("prompt", "completion"),
    ("instruction", "output"): _pair("instruction", "output"),
    ("instruction", "input", "output"): (
        "array(named_struct('role', 'user', 'text', concat_ws('\\n', try_variant_get(v, '$.instruction', 'string'), try_variant_get(v, '$.input', 'string'))),"
        " named_struct('role', 'assistant', 'text', try_variant_get(v, '$.output', 'string')))"
    ),
}


def field_paths(record: Column) -> Column:
    """Sorted leaf paths of a nested record of up to one list of objects per field: types and values play no part."""
    shape = F.schema_of_variant(record)
    # The shape reads OBJECT<a: STRING, b: ARRAY<OBJECT<c: STRING>>>; types other than the two nesting ones are dropped.
    plain = F.regexp_replace(shape, r"`", "")
    lists = F.transform(
        F.regexp_extract_all(plain, F.lit(r"(\w+): ARRAY<OBJECT<([^<>]*)>>"), F.lit(0)),
        lambda s: F.transform(
            F.split(F.regexp_extract(s, r"ARRAY<OBJECT<([^<>]*)>>", 1), ", "),
            lambda leaf: F.concat(F.regexp_extract(s, r"^(\w+):", 1), F.lit("[]."), F.regexp_extract(leaf, r"^(\w+):", 1)),
        ),
    )
    top = F.split(F.regexp_replace(F.regexp_replace(plain, r"(\w+): ARRAY<OBJECT<[^<>]*>>(, )?", ""), r"^OBJECT<|>$|, >$", ""), ", ")
    top = F.transform(top, lambda leaf: F.regexp_extract(leaf, r"^(\w+):", 1))
    return F.array_sort(F.filter(F.concat(F.flatten(lists), top), lambda p: p != ""))


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def canonical(records: DataFrame, record: str = "record", layouts: dict[tuple[str, ...], str] = LAYOUTS) -> DataFrame:
    """``records`` with ``schema_fp`` and ``turns``; the JSON column is replaced by them.

    The fingerprint of a record's field paths picks its mapping. Records of an unknown
    layout, broken JSON and null have null turns. Other columns pass through, except those
    named like the two results.
    """
    keep = [c for c in records.columns if c.lower() not in (record.lower(), "schema_fp", "turns")]
    v = spare(records, "v")
    rows = records.select(*named(keep), F.try_parse_json(record).alias(v))
    rows = rows.withColumn("schema_fp", fingerprint(field_paths(F.col(v))))
    turns = F.lit(None).cast(TURNS)
    for paths, mapping in layouts.items():
        known = fingerprint(F.array(*(F.lit(p) for p in sorted(paths))))
        turns = F.when(F.col("schema_fp") == known, F.expr(mapping.replace("(v,", f"({v},")).cast(TURNS)).otherwise(turns)
    return rows.withColumn("turns", turns).drop(v)


def formatted(rows: DataFrame, turns: str = "turns", loss_role: str = "assistant") -> DataFrame:
    """``rows`` with ``formatted`` (one text) and ``loss_spans`` (start, length in code points of the texts to learn).

    A turn is its mark, its role, the body mark, its text and the end mark; control strings
    inside roles and texts are escaped and can be restored. Null roles and texts are empty,
    null or empty turns give an empty text without spans.
    """
    role = lambda t: escape(t["role"])
    held = spare(rows, "parts")
    parts = F.transform(
        F.coalesce(turns, F.array().cast(TURNS)),
        lambda t: F.struct(F.concat(F.lit(TURN), role(t), F.lit(BODY)).alias("head"), escape(t["text"]).alias("body"), F.coalesce(t["role"] == loss_role, F.lit(False)).alias("learn")),
    )
    size = lambda p: F.length(p["head"]) + F.length(p["body"]) + len(END)
    spans = F.aggregate(
        held, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + size(p)).alias("at"),
            F.when(p["learn"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + F.length(p["head"])).alias("start"), F.length(p["body"]).alias("length"))))).otherwise(acc["spans"]).alias("spans"),
        ),
    )
    text = F.array_join(F.transform(held, lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    return rows.withColumn(held, parts).withColumn("formatted", text).withColumn("loss_spans", spans["spans"]).drop(held)


def read_back(text: Column) -> Column:
    """The turns of a formatted text, unescaped."""
    quoted = lambda mark: mark.replace("|", r"\|")
    marked = F.filter(F.split(text, quoted(END)), lambda s: s != "")
    return F.transform(
        marked,
        lambda s: F.struct(
            unescape(F.substring_index(F.substr(s, F.lit(len(TURN) + 1)), BODY, 1)).alias("role"),
            unescape(F.substr(s, F.instr(s, BODY) + len(BODY))).alias("text"),
        ),
    )


def learned(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(text, s["start"] + 1, s["length"]))), "")


def conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, turns)``: one row per conversation, its rows by turn (ties by role and text, nulls first).

    A conversation is one record of the result, so it is as large as its longest text
    should be; ids are grouped with partial lists combined map-side.
    """
    row = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    listed = rows.groupBy(F.col(conv_id).alias("conv_id")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return listed.select("conv_id", F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("turns"))


def as_record(turns: Column, pick: Column) -> Column:
    """Turns as JSON in one of several layouts: pairs of user and assistant as prompt or instruction, all else as messages."""
    pair = (F.size(turns) == 2) & (F.get(turns, 0)["role"] == "user") & (F.get(turns, 1)["role"] == "assistant")
    first, second = F.get(turns, 0)["text"], F.get(turns, 1)["text"]
    chat = F.struct(F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("messages"))
    shared = F.struct(F.transform(turns, lambda t: F.struct(t["role"].alias("from"), t["text"].alias("value"))).alias("conversations"))
    return (
        F.when(pair & (pick == 0), F.to_json(F.struct(first.alias("prompt"), second.alias("completion"))))
        .when(pair & (pick == 1), F.to_json(F.struct(first.alias("instruction"), second.alias("output"))))
        .when(pick == 0, F.to_json(chat)).otherwise(F.to_json(shared))
    )
