"""Physical plans of all queries and of the operators whose plan matters at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from verification.registry import QUERIES
from wattledger.operators import balance, carbon, demand, fraud, reports, supply
from wattledger.plans import cubes
from wattledger.plans.scoring import meter_scores
from wattledger.plans.sizing import broadcast_within
from wattledger.plans.storage import written


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    """The plan as adaptive execution finally ran it, subqueries included, without the initial plans."""
    df.collect()
    kept, skip_from = [], None
    for line in planned(df).splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip_from is not None and depth >= skip_from:
            continue
        skip_from = depth if "== Initial Plan ==" in line else None
        if skip_from is None:
            kept.append(line)
    return "\n".join(kept)


FORBIDDEN = ("Python", "ExistingRDD", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("full_run_")])
def test_no_python_no_rdd_no_cross_join(grid, name):
    plan = planned(QUERIES[name](grid))
    assert not [word for word in FORBIDDEN if word in plan]


def test_scans_read_only_the_needed_columns(grid):
    plan = planned(demand.demand_by_meter_type(grid.meter_readings))
    (columns,) = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    assert sorted(c.split(":")[0] for c in columns.split(",")) == ["l_partkey", "l_quantity"]


def test_filters_reach_the_scan(spark, sf_dir, grid, tmp_path):
    path = str(tmp_path / "readings")
    grid.meter_readings.write.parquet(path)
    readings = spark.read.parquet(path).where(F.col("district_id") == "D001")
    assert "EqualTo(district_id,D001)" in planned(demand.demand_by_meter_type(readings))


def test_ranking_is_a_top_k(grid):
    assert "TakeOrderedAndProject" in planned(demand.peak_demand_districts(grid.meter_readings))
    totals = fraud.meter_totals(grid.meter_readings)
    scores = fraud.meter_zscores(totals, fraud.district_stats(totals))
    assert "TakeOrderedAndProject" in planned(fraud.top_suspicious_meters(scores))


def test_small_sides_are_broadcast(spark, grid):
    assert "BroadcastHashJoin" in planned(supply.enrich_with_weather(grid.plant_output, grid.weather_factors))
    assert "BroadcastHashJoin" in planned(
        carbon.emission_pairs_by_join(grid.plant_output, carbon.emission_factors(spark))
    )


@pytest.fixture
def without_static_broadcast(spark):
    """Plan joins as for tables too large to be estimated as small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_beyond_the_bound_the_weather_join_still_runs(grid, without_static_broadcast):
    matches = broadcast_within(supply.weather_matches(grid.weather), max_rows=10)
    weighted = supply.supply_by_district(supply.weather_weighted(grid.plant_output, matches))
    assert "SortMergeJoin" in executed(weighted)
    enriched = supply.supply_by_district(supply.enrich_with_weather(grid.plant_output, grid.weather))
    key = lambda row: row["district_id"]
    for a, b in zip(sorted(weighted.collect(), key=key), sorted(enriched.collect(), key=key), strict=True):
        assert a["total_supply_mw"] == pytest.approx(b["total_supply_mw"])


def test_statistics_are_the_broadcast_side_of_the_scores(grid, tmp_path, without_static_broadcast):
    """The totals are neither shuffled again nor salted; the statistics are broadcast, as they are counted to be few."""
    _, scores = meter_scores(fraud.meter_district_sums(grid.meter_readings), str(tmp_path / "scores"))
    plan = executed(scores)
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange") == 1 and "Generate" not in plan
    assert "valid_stats" in plan[plan.index("BroadcastExchange") :]


def test_scores_beyond_the_broadcast_bound_are_salted_and_the_same(grid, tmp_path, without_static_broadcast):
    sums = fraud.meter_district_sums(grid.meter_readings)
    _, hinted = meter_scores(sums, str(tmp_path / "hinted"))
    _, salted = meter_scores(sums, str(tmp_path / "salted"), max_districts=1)
    assert "salt" in executed(salted) and "BroadcastHashJoin" not in executed(salted)
    assert sorted(hinted.collect()) == sorted(salted.collect())


def test_factors_are_broadcast_by_themselves(spark, grid, without_static_broadcast):
    plan = planned(carbon.emission_pairs_by_join(grid.plant_output, carbon.emission_factors(spark)))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_dashboard_expands_no_facts(grid):
    for frame in (reports.supply_metrics(grid.plant_output), reports.demand_metrics(grid.meter_readings)):
        plan = executed(frame)
        assert plan.count("FileScan") == 1
        from_scan = plan[: plan.index("FileScan")]
        assert "Expand" not in from_scan[from_scan.rindex("partial_sum") :]


def test_supply_queries_scan_each_fact_once(grid):
    plan = executed(supply.supply_by_district(grid.weighted_output))
    assert plan.count("orders.parquet") <= 1 and plan.count("lineitem.parquet") == 0


def test_balance_joins_on_the_partitioning_of_its_sums(spark, grid, without_static_broadcast):
    demands = demand.demand_by_district(grid.meter_readings)
    supplies = supply.supply_by_district(grid.plant_output)
    plan = planned(balance.grid_balance(demands, supplies))
    assert "SortMergeJoin" in plan
    assert plan.count("Exchange") == 2


def test_readings_are_summed_by_hash_before_any_sort(grid):
    plan = planned(fraud.meter_totals(grid.meter_readings))
    scan_to_shuffle = plan[plan.rindex("Exchange") :]
    assert "HashAggregate" in scan_to_shuffle and "Sort" not in scan_to_shuffle


def test_shares_scan_once(grid):
    plan = executed(reports.demand_share(demand.demand_by_meter_type(grid.meter_readings)))
    assert plan.count("FileScan") == 1


def test_histogram_scans_once(grid):
    totals = fraud.meter_totals(grid.meter_readings)
    plan = executed(reports.zscore_histogram(fraud.meter_zscores(totals, fraud.district_stats(totals))))
    assert plan.count("FileScan") == 1


def test_cubes_aggregate_before_the_shuffle(grid):
    plan = planned(cubes.demand_cube(grid.meter_readings))
    assert plan.count("Exchange") == 1
    assert "partial_sum" in plan[plan.index("Exchange") :]


@pytest.fixture
def eager_skew_splitting(spark, without_static_broadcast):
    """Thresholds at the scale of the test data."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def test_a_hot_hour_is_split_beyond_the_broadcast_bound(grid, tmp_path, eager_skew_splitting):
    """A third of the plant output in one hour, joined with weather that is not broadcast."""
    hot = F.when(F.hash("plant_id", "output_mw") % 3 == 0, F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))
    output = grid.plant_output.withColumn("timestamp", F.coalesce(hot, F.col("timestamp"))).repartition(8)
    weather = written(grid.weather.dropDuplicates(["timestamp"]), str(tmp_path / "weather"))
    enriched = supply.enrich_with_weather(output, broadcast_within(weather, max_rows=10))
    assert "SortMergeJoin(skew=true)" in executed(enriched)
    assert enriched.count() == output.count()
    matches = written(supply.weather_matches(weather), str(tmp_path / "matches"))
    weighted = supply.weather_weighted(output, broadcast_within(matches, max_rows=10))
    assert "SortMergeJoin(skew=true)" in executed(weighted)
    assert weighted.count() == output.count()


def test_a_hot_district_is_spread_if_statistics_are_not_broadcast(spark, without_static_broadcast):
    """Two thirds of the meters in one district, without the help of adaptive execution."""
    meter = F.col("id")
    totals = spark.range(0, 60000, 1, 8).select(
        F.concat(F.lit("M"), meter).alias("meter_id"),
        F.when(meter % 3 > 0, "D0").otherwise(F.concat(F.lit("D"), meter % 100)).alias("district_id"),
        (meter % 17).cast("double").alias("total_kwh"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        scores = fraud.meter_zscores(totals, fraud.district_stats(totals), salts=16)
        assert "SortMergeJoin" in planned(scores)
        sizes = [r["count"] for r in scores.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 60000
    assert max(sizes) < 60000 * 0.3
