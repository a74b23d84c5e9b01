"""Readings and meters in equal buckets by meter, so that neither is shuffled again.

Both tables are written once in the same number of buckets by (meter_id, part). A join on these, and every sum by meter, then
reads each bucket where it lies: the facts are shuffled when they are stored and not per query.

A bucket is one task, so a meter with more readings than a bucket should hold is spread: its readings are dealt over several
parts, and its row in the meters table is repeated for each. All other meters have part 0. At most as many meters as there are
buckets can be that large, which bounds what is broadcast to deal them out.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.operators import fraud
from wattledger.plans.storage import written

KEY = ("meter_id", "part")
ROWS_PER_BUCKET = 5_000_000
MAX_BUCKETS = 100_000  # what Spark takes by default


@dataclass(frozen=True)
class MeterLayout:
    """Both tables as Spark knows them, with the column ``part`` besides their own."""

    readings: DataFrame
    meters: DataFrame
    buckets: int
    names: tuple[str, str]


def _bucketed(df: DataFrame, path: str, buckets: int) -> None:
    """One file for each bucket: rows are dealt as Spark numbers buckets, so that a task writes one."""
    name = f"wattledger_{uuid4().hex}"
    dealt = df.repartition(buckets, *KEY).sortWithinPartitions(*KEY)
    dealt.write.format("parquet").bucketBy(buckets, *KEY).sortBy(*KEY).option("path", path).saveAsTable(name)
    # the files stay; readers declare them again
    df.sparkSession.sql(f"DROP TABLE {name}")


def _declare(spark: SparkSession, path: str, columns: str, buckets: int) -> str:
    """A new name in the session's catalog for the table at ``path`` and its buckets."""
    name = f"wattledger_{uuid4().hex}"
    keys = ", ".join(KEY)
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{location}'")
    return name


def write_meter_layout(readings: DataFrame, meters: DataFrame, folder: str, buckets: int | None = None) -> MeterLayout:
    """Store ``readings`` and ``meters`` below ``folder``, which must not hold such tables yet.

    buckets: one per five million readings by default. Rows without meter_id are kept, in part 0.
    """
    per_meter = written(readings.groupBy("meter_id").agg(F.count(F.lit(1)).alias("n")), f"{folder}/readings_per_meter")
    total = per_meter.agg(F.sum("n")).first()[0] or 0
    buckets = buckets or min(MAX_BUCKETS, 1 + total // ROWS_PER_BUCKET)
    share = max(1, total // buckets)
    # meters with more than a bucket's share: fewer than there are buckets
    large = per_meter.where(F.col("meter_id").isNotNull() & (F.col("n") > share))
    large = F.broadcast(large.select("meter_id", F.ceil(F.col("n") / F.lit(share)).cast("int").alias("parts")))
    dealt = readings.join(large, "meter_id", "left")
    part = F.coalesce(F.pmod(F.xxhash64(*[readings[c] for c in readings.columns]), "parts").cast("int"), F.lit(0))
    spread = meters.join(large, "meter_id", "left")
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    tables = {"readings": dealt.select(*readings.columns, part.alias("part")), "meters": spread.select(*meters.columns, parts.alias("part"))}
    for name, df in tables.items():
        _bucketed(df, f"{folder}/{name}", buckets)
    spark = readings.sparkSession
    # a table without rows has no file that would tell its columns
    columns = [", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) for df in tables.values()]
    spark.createDataFrame([(buckets, *columns)], "buckets INT, readings STRING, meters STRING").coalesce(1).write.parquet(f"{folder}/layout")
    return read_meter_layout(spark, folder)


def read_meter_layout(spark: SparkSession, folder: str) -> MeterLayout:
    """A layout written before, also by another session."""
    stored = spark.read.parquet(f"{folder}/layout").first()
    readings, meters = (_declare(spark, f"{folder}/{table}", stored[table], stored["buckets"]) for table in ("readings", "meters"))
    return MeterLayout(spark.table(readings), spark.table(meters), stored["buckets"], (readings, meters))


def forget(layout: MeterLayout) -> None:
    """Take both names out of the session's catalog; the files stay and can be declared again."""
    for name in layout.names:
        layout.readings.sparkSession.sql(f"DROP TABLE {name}")


def readings_of_meters(layout: MeterLayout, *columns: str) -> DataFrame:
    """Readings joined with the named ``columns`` of their meters, bucket by bucket. Readings of unknown meters are left out.

    The rows of a bucket's meters are a hash table in its task: the hint keeps Spark from sorting the readings for it.
    """
    meters = layout.meters.select(*KEY, *columns).hint("shuffle_hash")
    return layout.readings.join(meters, list(KEY)).drop("part")


def meter_district_sums(layout: MeterLayout) -> DataFrame:
    """``fraud.meter_district_sums`` of the readings: they stay where they are, and only sums of large meters meet again."""
    parts = layout.readings.groupBy(*KEY, "district_id").agg(F.sum("kwh").alias("kwh"))
    return fraud.meter_district_sums(parts)
