"""The complete analysis: demand, supply, balance, fraud and carbon results from the raw tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.operators import balance, carbon, demand, fraud, supply
from wattledger.plans import cubes
from wattledger.plans.scoring import meter_scores
from wattledger.plans.sizing import broadcast_within
from wattledger.plans.storage import Write, concurrently, scratch, scratch_dir, written
from wattledger.sources.readers import read_csv, read_table
from wattledger.sources.writers import write_csv, write_parquet


@dataclass(frozen=True)
class Output:
    """Where a result goes, and in what order. Results that grow with the meters have no order and many parts."""

    folder: str
    order: tuple[str, ...] = ()


OUTPUTS = {
    "total_demand": Output("demand", ("district_id",)),
    "hourly_demand": Output("demand", ("district_id", "hour")),
    "type_demand": Output("demand", ("meter_type",)),
    "total_supply": Output("supply", ("district_id",)),
    "type_supply": Output("supply", ("plant_type",)),
    "hourly_supply": Output("supply", ("district_id", "hour")),
    "utilization": Output("supply", ("plant_type",)),
    "costs": Output("supply", ("plant_type",)),
    "grid_balance": Output("balance", ("net_load_mw", "district_id")),
    "hourly_balance": Output("balance", ("district_id", "hour")),
    "district_stats": Output("fraud", ("district_id",)),
    "meter_zscores": Output("fraud"),
    "fraud_cases": Output("fraud"),
    "emissions_by_type": Output("carbon", ("plant_type",)),
    "emissions_by_district": Output("carbon", ("district_id",)),
    "emissions_hourly": Output("carbon", ("hour",)),
}


def demand_results(readings: DataFrame) -> dict[str, DataFrame]:
    """From readings or ``cubes.demand_view`` of them."""
    return {
        "demand_cube": readings,
        "total_demand": demand.demand_by_district(readings),
        "hourly_demand": demand.demand_by_district_hour(readings),
        "type_demand": demand.demand_by_meter_type(readings),
        "peak_districts": demand.peak_demand_districts(readings),
    }


def supply_results(output: DataFrame) -> dict[str, DataFrame]:
    """From plant output weighted by its weather, or ``cubes.supply_view`` of it."""
    return {
        "supply_cube": output,
        "total_supply": supply.supply_by_district(output),
        "type_supply": supply.supply_by_plant_type(output),
        "hourly_supply": supply.supply_by_district_hour(output),
        "utilization": supply.capacity_utilization(output),
        "costs": supply.operating_costs(output),
    }


def balance_results(results: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """From the demand and supply results."""
    grid = balance.grid_balance(results["total_demand"], results["total_supply"])
    return {
        "grid_balance": grid,
        "hourly_balance": balance.grid_balance_hourly(results["hourly_demand"], results["hourly_supply"]),
        "blackout_risk": balance.blackout_risk_summary(grid),
    }


def fraud_results(sums: DataFrame, folder: str, write: Write = written) -> dict[str, DataFrame]:
    """From energy per meter and district; intermediate tables go to ``folder``."""
    stats, scored = meter_scores(sums, folder, write=write)
    scored = write(scored, f"{folder}/meter_zscores")
    return {
        "district_stats": stats,
        "meter_zscores": scored,
        "fraud_cases": fraud.fraud_cases(scored),
        "top_suspicious": fraud.top_suspicious_meters(scored),
        "fraud_impact": fraud.fraud_impact(scored),
    }


def carbon_results(output: DataFrame, total_supply: DataFrame) -> dict[str, DataFrame]:
    """From plant output or ``cubes.carbon_view`` of it, and the supply by district that emissions are related to."""
    return {
        "carbon_cube": output,
        "emissions_by_type": carbon.emissions_by_type(output),
        "emissions_by_district": carbon.emissions_by_district(output),
        "emissions_hourly": carbon.emissions_by_hour(output),
        "renewable_share": carbon.renewable_share(output),
        "carbon_summary": carbon.carbon_summary(output, total_supply),
    }


def analyze(
    readings: DataFrame, plant_output: DataFrame, weather: DataFrame, folder: str | None = None, write: Write = written
) -> dict[str, DataFrame]:
    """All results and summaries by name.

    The readings and the plant output are scanned once each. Their pre-aggregates and the scored meters are written to
    ``folder`` (a new one below the session's checkpoint folder by default), which must not hold such tables yet; every
    returned frame reads only those, so the folder has to stay while the frames are in use. ``write`` may be
    ``storage.resumable``, to take up a run that broke off.
    """
    spark = readings.sparkSession
    folder = folder or scratch_dir(spark)
    matches = broadcast_within(write(supply.weather_matches(weather), f"{folder}/weather_matches"))
    rollup, generation = concurrently(
        spark,
        [
            lambda: write(cubes.readings_rollup(readings), f"{folder}/readings", "per_meter"),
            lambda: write(cubes.generation_cube(plant_output, matches), f"{folder}/generation"),
        ],
    )
    results = demand_results(cubes.demand_view(rollup)) | supply_results(cubes.supply_view(generation))
    results |= balance_results(results) | fraud_results(cubes.meter_view(rollup), folder, write)
    return results | carbon_results(cubes.carbon_view(generation), results["total_supply"])


def save_one(name: str, df: DataFrame, out_dir: str, fmt: str = "csv", single_files: bool = False) -> int:
    """Write one result to ``out_dir/<folder>/<name>`` and return its number of rows, which the write itself counts."""
    output = OUTPUTS[name]
    path = f"{out_dir}/{output.folder}/{name}"
    counted = Observation()
    ordered = df.orderBy(*output.order) if output.order else df
    ordered = ordered.observe(counted, F.count(F.lit(1)).alias("rows"))
    if fmt == "parquet":
        write_parquet(ordered, path)
    else:
        write_csv(ordered, path, single_file=single_files and bool(output.order))
    return counted.get["rows"]


def save(
    results: Mapping[str, DataFrame], out_dir: str, fmt: str = "csv", single_files: bool = False
) -> list[str]:
    """Write the results that ``OUTPUTS`` names to ``out_dir/<folder>/<name>``, sorted, and return their names.

    single_files: bring each sorted result, which districts x 24 hours bound, into one file. Others never are.
    """
    names = [name for name in OUTPUTS if name in results]
    if names:
        writes = [partial(save_one, name, results[name], out_dir, fmt, single_files) for name in names]
        concurrently(results[names[0]].sparkSession, writes)
    return names


def read_saved(spark: SparkSession, out_dir: str, name: str, schema: T.StructType | str, fmt: str = "csv") -> DataFrame:
    """A saved result."""
    path = f"{out_dir}/{OUTPUTS[name].folder}/{name}"
    return spark.read.schema(schema).parquet(path) if fmt == "parquet" else read_csv(spark, path, schema)


@dataclass(frozen=True)
class Run:
    """Where a job reads and writes: raw tables, results and their formats."""

    spark: SparkSession
    raw_dir: str
    out_dir: str
    raw_format: str = "csv"
    out_format: str = "csv"
    single_files: bool = False

    def raw(self, table: str) -> DataFrame:
        return read_table(self.spark, table, f"{self.raw_dir}/{table}.{self.raw_format}", self.raw_format)

    def saved(self, name: str) -> DataFrame:
        return read_saved(self.spark, self.out_dir, name, SAVED[name], self.out_format)

    def save(self, results: Mapping[str, DataFrame]) -> list[str]:
        return save(results, self.out_dir, self.out_format, self.single_files)


# columns of the results that later jobs read
SAVED = {
    "total_demand": "district_id STRING, total_demand_kwh DOUBLE",
    "hourly_demand": "district_id STRING, hour INT, total_demand_kwh DOUBLE",
    "total_supply": "district_id STRING, total_supply_mw DOUBLE",
    "hourly_supply": "district_id STRING, hour INT, total_supply_mw DOUBLE",
}


def run_demand(run: Run) -> None:
    """Needs the raw meter readings only."""
    with scratch(run.spark) as folder:
        run.save(demand_results(written(cubes.demand_cube(run.raw("meter_readings")), f"{folder}/demand")))


def run_supply(run: Run) -> None:
    """Needs the raw plant output and weather."""
    with scratch(run.spark) as folder:
        matches = broadcast_within(written(supply.weather_matches(run.raw("weather")), f"{folder}/weather_matches"))
        generation = written(cubes.generation_cube(run.raw("plant_output"), matches), f"{folder}/generation")
        run.save(supply_results(cubes.supply_view(generation)))


def run_balance(run: Run) -> None:
    """Needs the saved results of the demand and supply jobs."""
    run.save(balance_results({name: run.saved(name) for name in SAVED}))


def run_fraud(run: Run) -> None:
    """Needs the raw meter readings only."""
    with scratch(run.spark) as folder:
        run.save(fraud_results(fraud.meter_district_sums(run.raw("meter_readings")), folder))


def run_carbon(run: Run) -> None:
    """Needs the raw plant output and the saved supply by district."""
    run.save(carbon_results(run.raw("plant_output"), run.saved("total_supply")))


JOBS = {"demand": run_demand, "supply": run_supply, "balance": run_balance, "fraud": run_fraud, "carbon": run_carbon}


def run_all(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    *,
    raw_format: str = "csv",
    out_format: str = "csv",
    single_files: bool = False,
    folder: str | None = None,
) -> dict[str, DataFrame]:
    """Read the raw tables of ``raw_dir``, write the results to ``out_dir`` and return them with the summaries.

    The five jobs share one scan of each raw table; ``folder`` is as in ``analyze``.
    """
    run = Run(spark, raw_dir, out_dir, raw_format, out_format, single_files)
    results = analyze(run.raw("meter_readings"), run.raw("plant_output"), run.raw("weather"), folder)
    run.save(results)
    return results
