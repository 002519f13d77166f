"""Session defaults and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Bodies are large strings: bound an Arrow batch by rows and by bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Ids of a whole look-back belong on disk and not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Recording the Python call site of every Column costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "mailtally", **extra: str) -> SparkSession:
    """Session with the defaults above; the cluster's own settings come on top."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="mailtally-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; nothing is ever overwritten."""
    return f"{shared_dir(spark)}/mailtally/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Write a frame that several sinks read and read it back.

    This cuts the lineage in shared storage, so a lost executor costs a re-read and not
    another pass over the message bodies.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder from whatever store it is in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class RunFolder:
    """Stage frames of one run, removed when the run ends."""

    def __init__(self, spark: SparkSession, name: str = "run") -> None:
        self.spark, self.path = spark, scratch_path(spark, name)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, path=f"{self.path}/{name}-{uuid.uuid4().hex[:8]}")

    def __enter__(self) -> RunFolder:
        return self

    def __exit__(self, *_: object) -> None:
        delete_path(self.spark, self.path)
