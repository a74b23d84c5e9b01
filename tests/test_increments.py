"""Sums and statistics that take in day after day, against all readings at once."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from wattledger.operators import fraud
from wattledger.plans import increments
from wattledger.plans.storage import scratch_dir

READINGS = "day INT, meter_id STRING, district_id STRING, kwh DOUBLE"


def near(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def same_rows(found, expected, key: str) -> None:
    found, expected = ({r[key]: tuple(r) for r in df.select(expected.columns).collect()} for df in (found, expected))
    assert found.keys() == expected.keys()
    for k, row in expected.items():
        assert all(map(near, found[k], row)), (k, found[k], row)


def day_by_day(spark, readings, days):
    base, state = scratch_dir(spark), increments.no_readings(spark)
    for day in days:
        state = increments.with_readings(state, readings.where(F.col("day") == day), f"{base}/{day}")
        yield day, state


@pytest.fixture(scope="module")
def readings(spark):
    """Five days; meters that move to a district before or after their own, come late, or have no energy; a hot district."""
    rows = []
    for day in range(5):
        for m in range(120):
            if (m + day) % 4 == 0:
                continue
            district = "d1" if m < 80 else f"d{m % 3 + 2}"
            if m % 10 == 3 and day >= 2:
                district = "d0" if m < 80 else "d9"
            rows.append((day, f"m{m}", district, None if m == 7 else 1e6 + (m * 37 % 101) * 0.1 + day))
    rows += [(1, None, "d1", 3.0), (2, None, None, 4.0), (3, "m500", "d7", 1.0), (4, "m500", "d6", 2.0)]  # d7 loses its only meter
    return spark.createDataFrame(rows, READINGS)


def test_every_day_equals_all_readings_so_far(spark, readings):
    for day, state in day_by_day(spark, readings, range(5)):
        sofar = readings.where(F.col("day") <= day)
        totals = fraud.meter_totals(sofar)
        same_rows(increments.district_stats(state, 5), fraud.district_stats(totals, 5), "district_id")
        same_rows(increments.meter_totals(state), totals, "meter_id")
    assert state.moments.where("district_id = 'd7'").count() == 0


def test_order_of_days_does_not_matter_and_states_are_read_again(spark, readings):
    *_, (_, state) = day_by_day(spark, readings, [4, 0, 3, 1])
    base = scratch_dir(spark)
    increments.with_readings(state, readings.where("day = 2"), base)
    again = increments.read_state(spark, base)
    same_rows(increments.district_stats(again), fraud.district_stats(fraud.meter_totals(readings)), "district_id")


def test_a_state_is_not_written_over(spark, readings):
    folder = scratch_dir(spark)
    first = increments.with_readings(increments.no_readings(spark), readings.where("day = 0"), folder)
    before = first.sums.count()
    with pytest.raises(Exception, match="(?i)exists"):
        increments.with_readings(first, readings.where("day = 1"), folder)
    assert first.sums.count() == before


def test_no_readings_change_nothing(spark, readings):
    state = increments.with_readings(increments.no_readings(spark), readings.where("day = 0"), scratch_dir(spark))
    same = increments.with_readings(state, readings.limit(0), scratch_dir(spark))
    same_rows(increments.district_stats(same, 5), increments.district_stats(state, 5), "district_id")
    none = increments.with_readings(increments.no_readings(spark), readings.limit(0), scratch_dir(spark))
    assert increments.district_stats(none).collect() == []


def test_moments_of_groups_add_up(spark):
    """Totals of 1e9 that differ in their thousandths, in very many groups of one meter or some."""
    rows = [(f"d{i % 2}", f"m{i}", 1e9 + (i % 7) * 1e-3) for i in range(3000)]
    df = spark.createDataFrame(rows, "district_id STRING, meter_id STRING, kwh DOUBLE")
    merged = {r["district_id"]: r for r in increments.merged_moments(increments.meter_moments(df)).collect()}
    for district in ("d0", "d1"):
        own = [(i % 7) * 1e-3 for i in range(3000) if f"d{i % 2}" == district]
        mean = sum(own) / len(own)
        squares = sum((x - mean) ** 2 for x in own)
        found = merged[district]
        assert found["n"] == len(own) and math.isclose(found["mean"], 1e9 + mean, rel_tol=1e-15)
        assert math.isclose(found["squares"], squares, rel_tol=1e-3)  # 1e9 has thousandths to four digits
