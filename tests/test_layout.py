"""Readings and meters in equal buckets: no shuffle of facts, and large meters spread."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from wattledger.operators import fraud
from wattledger.plans.meter_layout import forget, meter_district_sums, read_meter_layout, readings_of_meters, write_meter_layout
from wattledger.plans.storage import scratch_dir

METERS = "meter_id STRING, district_id STRING, base_consumption DOUBLE"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    """Meter m0 has a third of all readings; m3 moves district; one reading has no meter and one an unknown one."""
    n = F.col("id")
    meter = F.when(n % 3 == 0, "m0").otherwise(F.concat(F.lit("m"), (n % 50).cast("string")))
    district = F.when((meter == "m3") & (n > 2000), "d9").otherwise(F.concat(F.lit("d"), (F.crc32(meter.cast("binary")) % 5).cast("string")))
    readings = spark.range(6000).select(
        F.timestamp_seconds(n * 60).cast("timestamp_ntz").alias("timestamp"), meter.alias("meter_id"), district.alias("district_id"), (n % 17).cast("double").alias("kwh")
    )
    odd = spark.createDataFrame([(None, "d1", 5.0), ("unknown", "d1", 7.0)], "meter_id STRING, district_id STRING, kwh DOUBLE")
    odd = odd.select(F.lit(None).cast("timestamp_ntz").alias("timestamp"), "meter_id", "district_id", "kwh")
    meters = spark.range(60).select(F.concat(F.lit("m"), "id").alias("meter_id"), F.lit("d0").alias("district_id"), n.cast("double").alias("base_consumption"))
    return readings.unionByName(odd), meters


@pytest.fixture(scope="module")
def layout(spark, tables):
    return write_meter_layout(*tables, scratch_dir(spark), buckets=6)


def test_joined_rows_equal_a_plain_join(tables, layout):
    readings, meters = tables
    plain = readings.join(meters.select("meter_id", "base_consumption"), "meter_id")
    joined = readings_of_meters(layout, "base_consumption")
    assert values(joined, *plain.columns) == values(plain)
    assert set(joined.columns) == set(plain.columns)


def test_no_exchange_above_either_scan(layout):
    plan = plan_of(readings_of_meters(layout, "base_consumption"))
    assert "Exchange" not in plan and "ShuffledHashJoin" in plan
    assert len(re.findall(r"SelectedBucketsCount: 6 out of 6", plan)) == 2


def test_sums_leave_the_readings_where_they_are(tables, layout):
    sums = meter_district_sums(layout)
    plan = plan_of(sums)
    # the one shuffle takes sums by meter, part and district, which are complete before it
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 4
    assert values(sums, "meter_id", "district_id", "kwh") == values(fraud.meter_district_sums(tables[0]), "meter_id", "district_id", "kwh")
    assert values(fraud.one_district_per_meter(sums), "meter_id", "district_id", "total_kwh") == values(
        fraud.meter_totals(tables[0]), "meter_id", "district_id", "total_kwh"
    )


def test_a_meter_with_a_third_of_all_rows_is_spread(layout):
    per_bucket = layout.readings.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_bucket) == 6
    # without parts one bucket would hold 2,000 rows of m0 besides its own
    assert max(r["count"] for r in per_bucket) < 2000
    assert layout.readings.where("meter_id = 'm0'").select("part").distinct().count() > 1
    assert layout.readings.where("part > 0").select("meter_id").distinct().collect()[0][0] == "m0"


def test_a_layout_is_read_again_and_forgotten(spark, tables):
    folder = scratch_dir(spark)
    first = write_meter_layout(*tables, folder, buckets=3)
    forget(first)
    again = read_meter_layout(spark, folder)
    assert again.buckets == 3
    assert "Exchange" not in plan_of(readings_of_meters(again, "base_consumption"))
    assert readings_of_meters(again, "base_consumption").count() == 6000
    with pytest.raises(Exception, match="(?i)exists"):
        write_meter_layout(*tables, folder)


def test_empty_tables(spark, tables):
    readings, meters = (df.limit(0) for df in tables)
    layout = write_meter_layout(readings, meters, scratch_dir(spark))
    assert layout.buckets == 1
    assert readings_of_meters(layout, "base_consumption").collect() == [] and meter_district_sums(layout).collect() == []
