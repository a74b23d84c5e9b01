"""Facts stored by day, so that a period reads the files of its days alone.

``day`` is a column of folders. A filter on it ends at the list of files; the same holds for days that another table names,
which Spark finds before it reads the facts (dynamic pruning).
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.plans.sizing import broadcast_within
from wattledger.schemas import TABLES

DAY = "day"


def _day(timestamp: Column | str) -> Column:
    return F.to_date(timestamp)


def write_by_day(facts: DataFrame, path: str, files_per_day: int = 1) -> None:
    """Store ``facts`` below ``path``, which must not exist, in a folder for each day of their ``timestamp``.

    files_per_day: over how many tasks, and files, the rows of one day are spread by their content, at most: adaptive
    execution joins tasks that would be small. A day with a large share of all rows needs several. Rows without timestamp have a folder of their own, which no period reads.
    """
    if files_per_day < 1:
        raise ValueError("a day has at least one file")
    spread = F.pmod(F.xxhash64(*facts.columns), F.lit(files_per_day))
    by_day = facts.withColumn(DAY, _day("timestamp")).repartition(F.col(DAY), spread)
    by_day.write.mode("errorifexists").partitionBy(DAY).parquet(path)


def read_by_day(spark: SparkSession, table: str, path: str) -> DataFrame:
    """A table of ``wattledger.schemas.TABLES`` stored by ``write_by_day``, with its ``day``."""
    ddl = TABLES[table]
    columns = ddl if isinstance(ddl, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ddl)
    return spark.read.schema(f"{columns}, {DAY} DATE").parquet(path)


def in_period(by_day: DataFrame, start: datetime | date | str, end: datetime | date | str) -> DataFrame:
    """Rows from ``start`` up to, and without, ``end``: wall-clock times, or dates for their midnights.

    The days of both ends are read whole and cut by time; all others are told by their folder alone.
    """
    first, last = (F.lit(str(x)).cast("timestamp_ntz") for x in (start, end))
    days = F.col(DAY).between(_day(first), _day(last))
    return by_day.where(days & (F.col("timestamp") >= first) & (F.col("timestamp") < last)).drop(DAY)


def read_period(spark: SparkSession, table: str, path: str, start: datetime | date | str, end: datetime | date | str) -> DataFrame:
    return in_period(read_by_day(spark, table, path), start, end)


def in_hours(by_day: DataFrame, hours: DataFrame) -> DataFrame:
    """Rows at one of the ``timestamp`` values of ``hours``, each once however often the hour is listed.

    The days of the hours are found first, and only their folders are read. Hours are hinted for broadcast if their number
    allows it: Spark then prunes with the rows it has built for the join.
    """
    listed = hours.where("timestamp IS NOT NULL").select(_day("timestamp").alias(DAY), "timestamp").distinct()
    return by_day.join(broadcast_within(listed), [DAY, "timestamp"], "left_semi").drop(DAY)
