"""Intermediate tables in the folder the cluster shares.

A written table survives the loss of executors; what reads it does not recompute the scan of the facts behind it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
T = TypeVar("T")
Write = Callable[..., DataFrame]  # frame, path and partition columns -> the table read back: ``written`` or ``resumable``


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name under the session's ``spark.checkpoint.dir``, which has to be a folder all executors reach.

    Where that is unset, the folder given to ``SparkContext.setCheckpointDir`` serves.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    return f"{root.rstrip('/')}/wattledger-{uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A new scratch folder that is deleted at the end, for frames that are saved before."""
    path = scratch_dir(spark)
    try:
        yield path
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def written(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet to ``path``, which must not exist, and return the table read back."""
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` came to its end."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def resumable(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """As ``written``, but a table that an earlier start finished is read as it is, and leftovers of a broken one are replaced."""
    if not is_written(df.sparkSession, path):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def concurrently(spark: SparkSession, actions: Iterable[Callable[[], T]], jobs: int = 4) -> list[T]:
    """Results of independent actions, submitted to Spark ``jobs`` at a time so that one fills the tail of another.

    The threads inherit the caller's job group, tags and scheduler pool.
    """
    with ThreadPoolExecutor(jobs) as pool:
        return list(pool.map(lambda run: run(), [inheritable_thread_target(spark)(action) for action in actions]))
