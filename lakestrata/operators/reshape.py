"""Wide-to-long reshaping.

Each input row expands inside its own task (a generator, no shuffle); the
filter that follows keeps only the useful long rows before anything moves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def unpivot(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str] | Mapping[str, str],
    name: str = "column_name", value: str = "value",
) -> DataFrame:
    """One row per listed column; a mapping gives column → name to show. Null values are dropped."""
    labels = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    wide = df.select(*ids, *[F.col(f"`{c}`").alias(label) for c, label in labels.items()])
    return wide.unpivot(list(ids), list(labels.values()), name, value).where(F.col(value).isNotNull())


def unpivot_flags(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str] | Mapping[str, str], name: str = "column_name"
) -> DataFrame:
    """Distinct (ids, column) pairs whose flag is 1."""
    return unpivot(df, ids, columns, name, "_flag").where("_flag = 1").drop("_flag").dropDuplicates()


def flags_to_rows(df: DataFrame, ids: Sequence[str], labels: Mapping[str, str], name: str) -> DataFrame:
    """One row per (row, flag equal to 1), labelled; unlike ``unpivot_flags`` repeats are kept."""
    return unpivot(df, ids, labels, name, "_flag").where("_flag = 1").drop("_flag")


def unpivot_records(
    df: DataFrame, ids: Sequence[str], records: Sequence[Mapping[str, Column]], required: str
) -> DataFrame:
    """Unpivot groups of columns into records: each mapping is one output row per input row.

    Records whose ``required`` field is null are dropped, then repeats.
    """
    structs = [F.struct(*[expr.alias(field) for field, expr in record.items()]) for record in records]
    return (
        df.select(*ids, F.inline(F.array(*structs)))
        .where(F.col(required).isNotNull())
        .dropDuplicates()
    )


def edge_list(df: DataFrame, node: str, neighbours: Sequence[str], src: str = "src", dst: str = "dst") -> DataFrame:
    """Adjacency columns to edges; empty slots vanish."""
    return df.select(
        F.col(node).alias(src), F.explode(F.array(*[F.col(n) for n in neighbours])).alias(dst)
    ).where(F.col(dst).isNotNull())


def edge_list_from_text(
    lines: DataFrame, text: str = "value", separators: str = "[:|,;]", src: str = "src", dst: str = "dst"
) -> DataFrame:
    """Ragged adjacency lines (``node: a, b | c``) to integer edges.

    A line with any token that is not an integer is rejected as a whole.
    """
    tokens = F.transform(F.split(F.col(text), separators), lambda t: F.trim(t).try_cast("int"))
    return (
        lines.select(tokens.alias("_t"))
        .where(F.forall("_t", lambda t: t.isNotNull()))
        .select(
            F.element_at("_t", 1).alias(src),
            F.explode(F.slice("_t", F.lit(2), F.size("_t"))).alias(dst),
        )
    )
