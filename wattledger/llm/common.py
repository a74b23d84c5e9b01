"""What the operators share: test tables, Arrow batches, ids that hash alike everywhere."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

try:
    _TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
except (OSError, TypeError):  # no C library to ask
    _TRIM = None
ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package from where the driver did.

    On a cluster the package is installed, or shipped with ``--py-files``; the path is then merely one more.
    """
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [env.get("PYTHONPATH"), ROOT]))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release_memory() -> None:
    """Give freed memory back to the system: workers stay between tasks, and several share an executor."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    importable(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        release_memory()

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The column as UTF-8 bytes; null as empty."""
    return [x or b"" for x in batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()]


def each_text(column: pa.Array) -> Iterator[bytes]:
    """The texts one by one as UTF-8 bytes, null as empty, without a second copy of the batch."""
    for text in column.cast(pa.binary()):
        yield text.as_py() or b""


def slices(batch: pa.RecordBatch, max_bytes: int, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` with at most about ``max_bytes`` of text, one row at least."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(sizes):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + max_bytes, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id's decimal text: the fold of a document."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def crc_of_id(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
