"""Time the registered queries and the full run; prints one JSON line.

BENCH_SF_DIR   test data (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default: all)
BENCH_RUNS     timed runs per query after one warm-up; the median counts (default 3)
BENCH_QUERIES  comma-separated names (default: the headline queries below)
BENCH_ROLLUPS  if set: only the ways to sum readings by district, type and hour and by meter, compared
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from verification.adapters import GridTables  # noqa: E402
from verification.registry import QUERIES  # noqa: E402
from wattledger.functions.common import hour_of  # noqa: E402
from wattledger.operators import fraud  # noqa: E402
from wattledger.plans import cubes  # noqa: E402
from wattledger.plans.full_run import run_all  # noqa: E402
from wattledger.plans.storage import scratch_dir  # noqa: E402
from wattledger.sources.writers import write_csv  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "scan_meter_readings",
    "sink_csv_roundtrip",
    "demand_by_district",
    "demand_of_period",
    "demand_by_district_hour",
    "demand_by_meter_type",
    "peak_demand_districts",
    "enrich_with_weather",
    "supply_by_district",
    "supply_by_plant_type",
    "supply_by_district_hour",
    "capacity_utilization",
    "operating_costs",
    "grid_balance",
    "grid_balance_hourly",
    "blackout_risk_summary",
    "meter_totals",
    "meter_totals_by_bucket",
    "district_stats",
    "meter_zscores",
    "fraud_cases",
    "top_suspicious_meters",
    "fraud_impact",
    "emissions_by_type",
    "emissions_by_district",
    "emissions_by_hour",
    "renewable_share",
    "carbon_summary",
    "zscore_histogram",
    "dash_demand_summary",
    "dash_supply_summary",
    "expected_output",
    "load_factor",
    "expected_consumption",
]
FULL_RUN = "full_run"


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(action) -> float:
    """Median of the timed runs."""
    action()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def rollup_ways(spark: SparkSession) -> dict[str, float]:
    """Seconds for both groupings of the readings, each way to written tables, over readings in Parquet."""
    path = f"{scratch_dir(spark)}/readings"
    GridTables(spark, SF_DIR).meter_readings.write.parquet(path)
    readings = spark.read.parquet(path)

    def save(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def two_scans() -> None:
        save(cubes.demand_cube(readings))
        save(fraud.meter_district_sums(readings))

    def finest_first() -> None:
        folder = scratch_dir(spark)
        finest = readings.groupBy("meter_id", "district_id", "meter_type", hour_of(readings)).agg(F.sum("kwh").alias("kwh"))
        finest.write.parquet(f"{folder}/finest")
        stored = spark.read.parquet(f"{folder}/finest")
        save(stored.groupBy("district_id", "meter_type", "hour").agg(F.sum("kwh")))
        save(stored.groupBy("meter_id", "district_id").agg(F.sum("kwh")))

    ways = {"one_scan_expanded": lambda: save(cubes.readings_rollup(readings)), "two_scans": two_scans, "finest_first": finest_first}
    return {name: seconds(way) for name, way in ways.items()}


def query_action(spark: SparkSession, name: str):
    """Build the query anew and compute all of its rows, without bringing them to the driver."""
    return lambda: QUERIES[name](GridTables(spark, SF_DIR)).write.format("noop").mode("overwrite").save()


def full_run_action(spark: SparkSession):
    """All results from the raw tables as CSV files, which are written before the clock starts."""
    grid, base = GridTables(spark, SF_DIR), scratch_dir(spark)
    for table in ("meter_readings", "plant_output", "weather"):
        write_csv(getattr(grid, table), f"{base}/raw/{table}.csv")
    return lambda: run_all(spark, f"{base}/raw", f"{base}/results")


def main() -> None:
    spark = session()
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else [*HEADLINE, FULL_RUN]
    times = rollup_ways(spark) if os.environ.get("BENCH_ROLLUPS") else {}
    for name in names if not times else []:
        action = full_run_action(spark) if name == FULL_RUN else query_action(spark, name)
        times[name] = seconds(action)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
