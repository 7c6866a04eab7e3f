"""Session construction and lineage checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "recspark") -> SparkSession:
    """Local or cluster session with the settings every operator assumes.

    On a cluster the master, memory and shuffle width come from spark-submit; the
    values here are only applied when nothing else set them.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("RECSPARK_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session without the setting (tests) gets a fresh scratch folder; on a
    cluster a machine-local folder would lose the data, so that is an error.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="recspark-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return configured


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession):
    """Shuffle files of the queries made and run in here go when each ends.

    Otherwise they stay until the driver's JVM happens to collect what refers to them, so that a
    loop fills the disk with the files of all its rounds. A query reads its mode when it is made.
    """
    old = spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, old)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder: survives executor loss. Its shuffle files are deleted."""
    checkpoint_dir(df.sparkSession)
    with freed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def drop_checkpoint(df: DataFrame) -> None:
    """Delete the files of a frame made by ``cut_lineage`` that nothing reads any more."""
    path = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if path.isDefined():
        _delete(df.sparkSession, path.get())


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: Rows that a task of a sized shuffle gets.
ROWS_A_TASK = 1 << 21


def sized(df: DataFrame, rows: int, *cols) -> DataFrame:
    """Rows dealt by ``cols`` over as many tasks as ``rows`` of them need.

    For stages that make many rows of few: adaptive execution merges partitions by what they
    read, and leaves a stated number alone.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-int(rows) // ROWS_A_TASK)), *cols)


#: Bytes of an Arrow batch between the JVM and Python, for rows that hold whole blocks.
BATCH_BYTES, BATCH_KEY = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches in bytes, unless the session's value is already smaller."""
    if int(spark.conf.get(BATCH_KEY, str(1 << 30)).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


class Tables:
    """Successive tables of a loop, written in the shared folder and read again.

    Spark multiplies the estimated sizes of joined sides and keeps the estimate over a
    checkpoint, so in a long loop of joins the number itself grows without bound; a written
    table has its true size. ``drop`` deletes a table that nothing reads any more.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.made = spark, f"{checkpoint_dir(spark)}/tables-{uuid.uuid4().hex}", 0

    def write(self, df: DataFrame, by=()) -> tuple[DataFrame, str]:
        path = f"{self.folder}/{self.made}"
        self.made += 1
        with freed(self.spark):
            df.write.partitionBy(*by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, path: str) -> None:
        _delete(self.spark, path)
