"""Cutting lineage between the jobs of one operator."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.session import cut_lineage

#: Largest side, in bytes, that is broadcast after it has been measured.
BROADCAST_BYTES = 32 << 20

#: Bytes that a task of a table of known size gets at least.
TASK_BYTES = 1 << 20


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder named by ``spark.checkpoint.dir``."""
    return cut_lineage(df)


def let_go(spark: SparkSession) -> None:
    """Have Spark's cleaner remove the shuffles and checkpoints that nothing refers to any more.

    The cleaner follows the driver's garbage collections, which may be an hour apart.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_side(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast when its measured size is under the bound, else as it is."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def narrow(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df``, of at most ``rows`` rows, in no more tasks than its size needs.

    A loop over small tables would else write a file, and log an event, for each task of the
    session's shuffle width, empty or not. A larger table keeps its partitions.
    """
    return df.coalesce(max(1, -(-int(rows) * row_bytes // TASK_BYTES)))


def plain(name: str) -> Column:
    """A column by its literal name."""
    return F.col("`" + name.replace("`", "``") + "`")
