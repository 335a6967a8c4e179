"""Delimited text, record lines and layer tables."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakestrata.operators.stitch import stitch_records
from lakestrata.session import Folder

LAYERS = ("Datalake", "Intermediate", "Silver", "Model", "Gold")


def read_delimited(
    spark: SparkSession, path: str | list[str], schema: StructType | str, sep: str = ";", header: bool = True,
    multiline: bool = False, malformed: str | None = None,
) -> DataFrame:
    """Delimited text with an explicit schema: no inference pass, and codes stay strings.

    ``multiline`` handles quoted line breaks, at the price of one task per file. A value
    that doesn't fit its type is null; with ``malformed`` the whole line is kept in a
    column of that name, which is null for all good lines.
    """
    if malformed:
        schema = f"{schema if isinstance(schema, str) else schema.simpleString()[7:-1]}, `{malformed}` string"
    reader = (
        spark.read.schema(schema)
        .option("sep", sep).option("header", header).option("multiLine", multiline)
        .option("escape", '"').option("mode", "PERMISSIVE")
    )
    return (reader.option("columnNameOfCorruptRecord", malformed) if malformed else reader).csv(path)


def clean_headers(df: DataFrame, remove: str = ",") -> DataFrame:
    """Column names without a character that the table format rejects."""
    return df.toDF(*[name.replace(remove, "") for name in df.columns])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def read_record_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Physical lines as (source, pos, line); ``pos`` is a struct (block, row) that increases along each file.

    ``block`` is the byte where the file split begins, ``row`` the row counter of the task
    that reads it, which only grows inside a split. So the order takes nothing but the scan.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source"),
        F.struct(F.col("_metadata.file_block_start").cast("bigint").alias("block"), row.alias("row")).alias("pos"), F.col("value").alias("line"),
    )


def read_broken_records(
    spark: SparkSession, path: str | list[str], types: Mapping[str, str] | None = None, sep: str = ",",
    min_fields: int = 245, malformed: str | None = None,
) -> DataFrame:
    """Delimited records that were split over several lines, stitched and then typed.

    Every file has the same header line: it names the columns in file order, so columns are
    found by name; ``types`` gives those that aren't text. A file without that line is an
    error; where it comes again, as in files put together from several, it is passed over.
    ``malformed`` is as in :func:`read_delimited`.
    """
    first = spark.read.text(path).first()
    header = first[0] if first else ""
    names = header.split(sep) if header else []
    schema = ", ".join([f"`{n}` {(types or {}).get(n, 'string')}" for n in names] + ([f"`{malformed}` string"] if malformed else []))
    records = stitch_records(read_record_lines(spark, path), "source", "pos", "line", min_fields, sep, header=header)
    options = {"sep": sep, "mode": "PERMISSIVE"} | ({"columnNameOfCorruptRecord": malformed} if malformed else {})
    return records.select(F.from_csv("record", schema, options).alias("r")).select("r.*")


def create_layers(spark: SparkSession, layers: Iterable[str] = LAYERS) -> None:
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


class Lake:
    """Layered tables, as catalog tables or as versioned parquet folders under ``root``.

    Below ``root`` a table is a folder of versions and a folder of commits. A version is
    written whole before a commit, a small file named by its number, tells that it holds;
    readers take the last commit. So a write that fails leaves the table as it was, and a
    reader keeps the version it began with until ``keep`` newer ones are committed. Of two
    writers at the same commit number the later one fails.

    ``buckets`` is how many buckets a table written with ``bucket_by`` has.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, buckets: int = 64, keep: int = 2) -> None:
        self.spark, self.root, self.buckets, self.keep = spark, root, buckets, keep

    def _path(self, layer: str, name: str) -> str:
        return os.path.join(self.root, layer.lower(), name.lower())

    def _commits(self, layer: str, name: str) -> list[str]:
        return sorted(n for n in Folder(self.spark, os.path.join(self._path(layer, name), "_commits")).names() if not n.startswith("."))

    def read(self, layer: str, name: str) -> DataFrame:
        if self.root is None:
            return self.spark.table(f"{layer}.{name}")
        commits = self._commits(layer, name)
        if not commits:
            raise FileNotFoundError(f"{layer}.{name} was never written below {self.root}")
        told = json.loads(Folder(self.spark, os.path.join(self._path(layer, name), "_commits")).read(commits[-1]))
        path = os.path.join(self._path(layer, name), told["version"])
        frame = self.spark.read.parquet(path)
        if not told["bucket_by"]:
            return frame
        # The catalog is what tells Spark of buckets; the entry is named by the version, so it never goes stale.
        entry = f"{layer}_{name}_{told['version']}".lower().replace("-", "_")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)
        keys = ", ".join(f"`{c}`" for c in told["bucket_by"])
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {entry} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {told['buckets']} BUCKETS LOCATION '{path}'")
        return self.spark.table(entry)

    def model_path(self, name: str) -> str:
        """Folder of a fitted model, beside the tables."""
        return os.path.join(self.root or self.spark.conf.get("spark.sql.warehouse.dir"), "models", name)

    def write(self, df: DataFrame, layer: str, name: str, partition_by: Iterable[str] = (), bucket_by: Iterable[str] = ()) -> DataFrame:
        """Overwrite the table and return it read back, which also cuts the lineage.

        Tables that are joined on ``bucket_by`` later are joined without a shuffle if they
        have as many buckets.
        """
        keys, version = list(bucket_by), f"v-{uuid.uuid4().hex}"
        writer = df.write.mode("overwrite").format("parquet").partitionBy(*partition_by)
        if keys:
            writer = df.repartition(self.buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(self.buckets, *keys).sortBy(*keys)
        if self.root is None:
            # the table as it was stays until the new one is whole
            entry = f"{layer}.{name}_{version}".replace("-", "_")
            writer.saveAsTable(entry)
            self.spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
            self.spark.sql(f"ALTER TABLE {entry} RENAME TO {layer}.{name}")
            return self.read(layer, name)
        base = self._path(layer, name)
        path = os.path.join(base, version)
        if keys:
            entry = f"{layer}_{name}_{version}".lower().replace("-", "_")
            writer.option("path", path).saveAsTable(entry)
        else:
            writer.save(path)
        commits = self._commits(layer, name)
        number = int(commits[-1]) + 1 if commits else 0
        Folder(self.spark, os.path.join(base, "_commits")).create(f"{number:012d}", json.dumps({"version": version, "bucket_by": keys, "buckets": self.buckets}))
        self._forget(layer, name)
        return self.read(layer, name)

    def _forget(self, layer: str, name: str) -> None:
        """Delete versions that ``keep`` newer commits have replaced."""
        base = self._path(layer, name)
        log = Folder(self.spark, os.path.join(base, "_commits"))
        for old in self._commits(layer, name)[: -1 - self.keep]:
            Folder(self.spark, base).remove(json.loads(log.read(old))["version"])
            log.remove(old)
