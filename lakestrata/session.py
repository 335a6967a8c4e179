"""Session defaults, table loading and durable lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def build_session(app: str = "lakestrata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; ``conf`` overrides them.

    Shuffle partitioning is left to AQE: a cluster sets a high
    ``spark.sql.shuffle.partitions`` and AQE coalesces small stages and splits
    skewed join partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        # Checkpoints go when nothing refers to them any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Spark prunes columns and pushes filters into the scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Directory for lineage cuts: the cluster's ``spark.checkpoint.dir``, never a guess.

    A machine-local folder would be lost with its executor, so one is created
    only for a local master (tests), where driver and executors share the disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="lakestrata-checkpoint-")
    sc.setCheckpointDir(shared)
    return shared


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on shared storage, so that losing an executor never replays the past."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


class Folder:
    """Small files in a folder that Spark reaches, wherever it lies."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm, self.path = spark._jvm, path
        self._at = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._at.getFileSystem(spark._jsc.hadoopConfiguration())

    def _file(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._at, name)

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._at)] if self._fs.exists(self._at) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._file(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """A file that is there whole or not at all; one of that name is an error."""
        draft = self._file(f".{name}-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self._fs.exists(self._file(name)) or not self._fs.rename(draft, self._file(name)):
            self._fs.delete(draft, False)
            raise FileExistsError(f"{self.path}/{name}")

    def remove(self, name: str) -> None:
        self._fs.delete(self._file(name), True)
