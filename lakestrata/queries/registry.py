"""The query registry."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakestrata.session import table

QueryFn = Callable[[SparkSession, str], DataFrame]


class Entry(NamedTuple):
    run: QueryFn
    sql: str | None


REGISTRY: dict[str, Entry] = {}


class Source:
    """Driver tables as attributes: ``src.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Source], DataFrame]], QueryFn]:
    """Register a query; without ``sql`` it is checked by rows only."""

    def register(build: Callable[[Source], DataFrame]) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Source(spark, sf_dir))

        REGISTRY[name] = Entry(run, sql)
        return run

    return register


def cents(amount: Column) -> Column:
    """Money as whole cents: sums and means of it are exact in any order."""
    return F.round(amount * 100).cast("bigint")


# The same in SQL.
def sql_cents(amount: str) -> str:
    return f"CAST(round({amount} * 100) AS BIGINT)"


def sql_pad(code: str, width: int) -> str:
    text = f"CAST({code} AS VARCHAR)"
    return f"CASE WHEN length({text}) < {width} THEN lpad({text}, {width}, '0') ELSE {text} END"


def sql_key_number(key: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"
