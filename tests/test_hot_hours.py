"""Hours frequent on both sides of the weather join, and gaps of few keys over many months: no task does most of the work."""

from __future__ import annotations

import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from wattledger.operators import supply, weather
from wattledger.plans import hot_hours
from wattledger.plans.storage import scratch_dir

START = datetime(2024, 6, 1)
FACTS = "timestamp STRING, plant_id STRING, output_mw DOUBLE"
WEATHER = "timestamp STRING, cloud_factor DOUBLE, wind_factor DOUBLE, precipitation_factor DOUBLE"


@pytest.fixture
def not_adaptive(spark):
    spark.conf.set("spark.sql.adaptive.enabled", False)
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def hour(i: int) -> str:
    return str(START + timedelta(hours=i))


@pytest.fixture
def sides(frame):
    """Hour 0: 900 facts and 60 weather rows; hour 1: 2 facts and 900 weather rows; hour 2: 900 and 1; others few of both."""
    facts = [(hour(0), f"p{i}", float(i)) for i in range(900)] + [(hour(1), "p", 1.0), (hour(1), "q", 2.0)]
    facts += [(hour(2), f"p{i}", float(i)) for i in range(900)] + [(hour(3 + i % 90), f"p{i}", float(i)) for i in range(300)] + [(None, "p", 1.0)]
    rows = [(hour(0), i / 60, 0.5, None) for i in range(60)] + [(hour(1), i / 900, 0.1, 1.0) for i in range(900)] + [(hour(2), 0.3, 0.3, 1.0)]
    rows += [(hour(3 + i), 0.7, None, 0.9) for i in range(60)] + [(hour(0), 0.0, 0.5, None)] + [(None, 0.1, 0.1, 0.1)]
    return frame(facts, FACTS).repartition(4), frame(rows, WEATHER).repartition(3)


@pytest.mark.parametrize("rows_per_key", [1, 100, 400, 10**9])
def test_rows_equal_the_plain_join(spark, sides, rows_per_key):
    facts, rows = sides
    found = hot_hours.enrich_split(facts, rows, scratch_dir(spark), rows_per_key)
    expected = supply.enrich_with_weather(facts, rows)
    assert set(found.columns) == set(expected.columns)
    assert values(found, *expected.columns) == values(expected)


def test_pieces_bound_the_rows_of_a_key(sides):
    found = {r["timestamp"]: r for r in hot_hours.hot_hours(*sides, rows_per_key=400).collect()}
    assert set(found) == {START, START + timedelta(hours=1), START + timedelta(hours=2)}
    pieces = [(found[t]["fact_pieces"], found[t]["weather_pieces"]) for t in sorted(found)]
    # 900 x 61 in pieces of 20 x 20; 2 x 900 and 900 x 1 in pieces of the long side
    assert pieces == [(45, 4), (1, 5), (3, 1)]


def rows_of_tasks(df) -> list[int]:
    counted = {r[0]: r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()}
    return [counted.get(i, 0) for i in range(8)]


def test_no_task_has_twice_the_median(spark, sides, not_adaptive):
    facts, rows = sides
    # larger than what is broadcast, as both sides of a hot hour are
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plain = rows_of_tasks(supply.enrich_with_weather(facts, rows))
        split = rows_of_tasks(hot_hours.enrich_split(facts, rows, scratch_dir(spark), 400))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(plain) == sum(split)
    assert max(plain) > 10 * statistics.median(plain)
    assert max(split) < 2 * statistics.median(split)


def test_gaps_by_month_equal_gaps(frame):
    rnd = random.Random(3)
    rows = []
    for key in ("a", "b", "c", None):
        at = START
        for _ in range(300):
            at += timedelta(hours=rnd.choice([1, 1, 1, 2, 5, 900, 9000]), minutes=rnd.choice([0, 0, 20]))
            rows += [(str(at), key)] * rnd.randint(1, 3)
    rows += [(None, "a"), (str(START), "once")]
    records = frame(rows, "timestamp STRING, plant STRING").repartition(5)
    expected = values(weather.reporting_gaps(records, "plant"))
    assert values(weather.reporting_gaps_by_month(records, "plant"), "id", "last_hour", "next_hour", "missing_hours") == expected
    assert len(expected) > 300
    assert weather.reporting_gaps_by_month(records.limit(0), "plant").collect() == []


def test_a_century_of_one_key_is_in_many_tasks(spark, not_adaptive):
    days = F.expr("timestamp_ntz'1920-01-01 00:00:00' + make_dt_interval(cast(id AS INT))")
    records = spark.range(36_500).select(days.alias("timestamp"), F.lit("one").alias("plant"))
    gaps = weather.reporting_gaps_by_month(records, "plant")
    assert gaps.count() == 36_499
    inside = gaps.where(F.month("last_hour") == F.month("next_hour"))
    assert min(rows_of_tasks(inside)) > 0 and max(rows_of_tasks(inside)) < 36_499 / 2
    assert sum(x > 0 for x in rows_of_tasks(weather.reporting_gaps(records, "plant"))) == 1
