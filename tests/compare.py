"""Row-for-row comparison of a Spark query with its SQL oracle."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


_FAMILY = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names, types and all values agree, else what differs first."""
    want = con.sql(sql)
    spark_types = {f.name: _FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    duck_types = {n: str(t) for n, t in zip(want.columns, want.types)}
    if spark_types != duck_types:
        return f"types {sorted(set(spark_types.items()) ^ set(duck_types.items()))}"
    got_names, got = _rows(df.columns, df.collect())
    _, expected = _rows(want.columns, want.fetchall())
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    for mine, theirs in zip(got, expected):
        if mine != theirs:
            return f"{got_names}: {mine} != {theirs}"
    return None
