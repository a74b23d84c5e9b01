"""Facts stored by day: a period and the hours of another table read the files of their days alone."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from wattledger.plans.storage import scratch_dir
from wattledger.sources.periods import in_hours, in_period, read_by_day, read_period, write_by_day

COLUMNS = "timestamp STRING, meter_id STRING, district_id STRING, meter_type STRING, kwh DOUBLE, voltage DOUBLE, power_factor DOUBLE"


@pytest.fixture(scope="module")
def readings(spark):
    """Ten days of hours, one of them with most of the rows, and a row without time."""
    hour = F.timestamp_seconds(1_700_000_000 - 1_700_000_000 % 86400 + F.col("id") * 3600).cast("timestamp_ntz")
    rows = spark.range(240).select(hour.alias("timestamp"), F.concat(F.lit("m"), F.col("id") % 7).alias("meter_id"), F.col("id").cast("double").alias("kwh"))
    hot = rows.where("kwh = 100").withColumn("kwh", F.explode(F.sequence(F.lit(0), F.lit(499)))).withColumn("kwh", F.col("kwh").cast("double"))
    rows = rows.unionByName(hot).unionByName(rows.limit(1).withColumn("timestamp", F.lit(None).cast("timestamp_ntz")))
    return rows.select("timestamp", "meter_id", F.lit("d").alias("district_id"), F.lit("residential").alias("meter_type"), "kwh", F.lit(230.0).alias("voltage"), F.lit(1.0).alias("power_factor"))


@pytest.fixture(scope="module")
def stored(spark, readings):
    path = f"{scratch_dir(spark)}/readings"
    # tasks as small as these would be joined
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    write_by_day(readings, path, files_per_day=3)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return path


def files_of(df) -> set[str]:
    return {f.split("day=")[1].split("/")[0] for f in df.inputFiles()}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def folders_read(df) -> int:
    """Partitions that the only scan of a query has to read."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    assert leaves.size() == 1
    return leaves.apply(0).selectedPartitions().partitionCount()


def test_all_rows_are_kept(spark, readings, stored):
    whole = read_by_day(spark, "meter_readings", stored)
    assert whole.columns == [*readings.columns, "day"]
    assert values(whole.drop("day")) == values(readings)
    assert len(files_of(whole)) == 11


def test_a_period_has_its_rows_and_reads_its_days(spark, readings, stored):
    start, end = "2023-11-16 05:00:00", "2023-11-18 07:00:00"
    found = read_period(spark, "meter_readings", stored, start, end)
    expected = readings.where((F.col("timestamp") >= F.lit(start).cast("timestamp_ntz")) & (F.col("timestamp") < F.lit(end).cast("timestamp_ntz")))
    assert values(found) == values(expected) and found.count() > 500
    assert found.columns == readings.columns
    plan = plan_of(found)
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "day" in filters and "2023-11-16" in filters and "2023-11-18" in filters
    assert folders_read(found) == 3


def test_dates_are_their_midnights(spark, readings, stored):
    found = in_period(read_by_day(spark, "meter_readings", stored), "2023-11-15", "2023-11-16")
    assert found.where("meter_id IS NOT NULL").count() == 24
    assert in_period(read_by_day(spark, "meter_readings", stored), "2023-11-16", "2023-11-16").count() == 0


def test_hours_of_another_table_prune_the_days(spark, readings, stored):
    hours = readings.where("kwh IN (30, 31, 130) AND timestamp IS NOT NULL").select("timestamp")
    twice = hours.unionByName(hours).unionByName(spark.createDataFrame([(None,)], "timestamp TIMESTAMP_NTZ"))
    found = in_hours(read_by_day(spark, "meter_readings", stored), twice)
    assert "dynamicpruning" in plan_of(found)
    expected = readings.join(hours.distinct(), "timestamp", "left_semi")
    assert values(found, *readings.columns) == values(expected, *readings.columns)


def test_a_day_with_most_rows_has_several_files(spark, stored):
    per_file = read_by_day(spark, "meter_readings", stored).where("day = '2023-11-18'").groupBy(F.input_file_name()).count().collect()
    assert 1 < len(per_file) <= 3 and max(r["count"] for r in per_file) < 400


def test_nothing_is_written_over_and_empty_tables_work(spark, readings, stored):
    with pytest.raises(Exception, match="(?i)exists"):
        write_by_day(readings, stored)
    with pytest.raises(ValueError):
        write_by_day(readings, stored + "0", files_per_day=0)
    path = f"{scratch_dir(spark)}/none"
    write_by_day(readings.limit(0), path)
    assert read_period(spark, "meter_readings", path, "2023-01-01", "2024-01-01").collect() == []
