"""One query per operator: (spark, sf_dir) -> DataFrame over the whole test tables.

Sums of doubles depend in their last bits on the order of addition, so aggregated doubles are rounded to six decimals
here, at the edge, and in the SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verification.adapters import GridTables
from wattledger.functions.common import round_half_even
from wattledger.operators import balance, carbon, demand, fraud, reports, supply, weather
from wattledger.plans import hot_hours, increments, meter_layout, publishing
from wattledger.plans.full_run import OUTPUTS, Run, read_saved, run_all
from wattledger.plans.scoring import meter_scores
from wattledger.plans.storage import scratch_dir, written
from wattledger.schemas import TABLES
from wattledger.sources import periods, readers, writers

QUERIES: dict[str, Callable[[GridTables], DataFrame]] = {}


def query(build: Callable[[GridTables], DataFrame]) -> Callable[[GridTables], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({name: round_half_even(F.col(name), digits) for name in doubles})


def _csv_round_trip(g: GridTables, table: str) -> DataFrame:
    path = f"{scratch_dir(g.spark)}/{table}.csv"
    writers.write_csv(getattr(g, table), path)
    return readers.read_table(g.spark, table, path)


# sources and sinks


@query
def scan_meter_readings(g):
    return _csv_round_trip(g, "meter_readings")


@query
def scan_plant_output(g):
    return _csv_round_trip(g, "plant_output")


@query
def scan_weather(g):
    return _csv_round_trip(g, "weather")


@query
def scan_districts(g):
    return _csv_round_trip(g, "districts")


@query
def scan_meters(g):
    return _csv_round_trip(g, "meters")


@query
def scan_plants(g):
    return _csv_round_trip(g, "plants")


@query
def scan_dimensions(g):
    meters, plants = _csv_round_trip(g, "meters"), _csv_round_trip(g, "plants")
    districts = _csv_round_trip(g, "districts")
    columns = lambda kind, key, category, size: [
        F.lit(kind).alias("kind"),
        F.col(key).alias("id"),
        "district_id",
        F.col(category).alias("category"),
        F.col(size).cast("double").alias("size"),
    ]
    return (
        districts.select(*columns("district", "district_id", "district_type", "num_meters"))
        .unionByName(meters.select(*columns("meter", "meter_id", "meter_type", "base_consumption")))
        .unionByName(plants.select(*columns("plant", "plant_id", "plant_type", "capacity_mw")))
    )


@query
def sink_csv_roundtrip(g):
    """The hourly demand, written as one sorted CSV file and read back."""
    path = f"{scratch_dir(g.spark)}/hourly_demand"
    hourly = demand.demand_by_district_hour(g.meter_readings).orderBy("district_id", "hour")
    writers.write_csv(hourly, path, single_file=True)
    return readers.read_csv(g.spark, path, hourly.schema)


@query
def sink_parquet_roundtrip(g):
    path = f"{scratch_dir(g.spark)}/hourly_demand"
    hourly = demand.demand_by_district_hour(g.meter_readings)
    writers.write_parquet(hourly, path)
    return g.spark.read.schema(hourly.schema).parquet(path)


def _damaged_readings(g: GridTables) -> str:
    """CSV of readings of which every tenth meter's energy is not a number."""

    def write(path: str) -> str:
        damaged = F.when(F.col("meter_id").rlike("3$"), F.lit("much")).otherwise(F.col("kwh").cast("string"))
        writers.write_csv(g.meter_readings.withColumn("kwh", damaged), path)
        return path

    return g.shared("damaged.csv", write)


@query
def split_damaged_rows(g):
    """Whole and damaged readings, told apart by one scan, with what the whole ones sum to."""
    whole, bad = readers.split_rows(g.spark, "meter_readings", _damaged_readings(g), scratch_dir(g.spark))
    counts = [
        whole.agg(F.lit("whole").alias("kind"), F.count(F.lit(1)).alias("row_count"), F.sum("kwh").alias("kwh")),
        bad.agg(F.lit("damaged").alias("kind"), F.count("row_text").alias("row_count"), F.lit(0.0).alias("kwh")),
    ]
    return rounded(counts[0].unionByName(counts[1]))


@query
def malformed_row_counts(g):
    path = _damaged_readings(g)
    return readers.malformed_row_counts(
        {"meter_readings": readers.read_table(g.spark, "meter_readings", path, on_bad_rows="keep")}
    )


@query
def row_counts(g):
    return readers.row_counts({table: getattr(g, table) for table in TABLES})


# demand


@query
def project_demand_pairs(g):
    return demand.demand_pairs(g.meter_readings)


@query
def demand_by_district(g):
    return rounded(demand.demand_by_district(g.meter_readings))


@query
def demand_by_district_hour(g):
    return rounded(demand.demand_by_district_hour(g.meter_readings))


@query
def demand_by_meter_type(g):
    return rounded(demand.demand_by_meter_type(g.meter_readings))


@query
def peak_demand_districts(g):
    return rounded(demand.peak_demand_districts(g.meter_readings))


@query
def demand_of_period(g):
    """Demand by district over some weeks, from readings stored by day."""
    return rounded(demand.demand_by_district(periods.in_period(g.readings_by_day, "1995-03-10 05:00:00", "1995-04-02 13:00:00")))


# supply


@query
def supply_in_extreme_wind(g):
    """Plant output of the hours of a drought with extreme wind, from output stored by day: only the days of those hours."""
    hours = g.weather.where("wind_condition = 'extreme' AND precipitation_condition = 'drought' AND day(timestamp) <= 3")
    return rounded(periods.in_hours(g.output_by_day, hours).groupBy("district_id").agg(F.sum("output_mw").alias("output_mw"), F.count(F.lit(1)).alias("plant_hours")))


@query
def project_supply_pairs(g):
    return supply.supply_pairs(g.plant_output)


@query
def enrich_with_weather(g):
    return supply.enrich_with_weather(g.plant_output, g.weather_factors)


@query
def enrich_hot_hours(g):
    """As ``enrich_with_weather``, with every hour of more than 20 rows in the result split over several keys."""
    path = f"{scratch_dir(g.spark)}/hot"
    return hot_hours.enrich_split(g.plant_output, g.weather, path, rows_per_key=20)


@query
def supply_by_district(g):
    return rounded(supply.supply_by_district(g.weighted_output))


@query
def supply_by_plant_type(g):
    return rounded(supply.supply_by_plant_type(g.weighted_output))


@query
def supply_by_district_hour(g):
    return rounded(supply.supply_by_district_hour(g.weighted_output))


@query
def capacity_utilization(g):
    return rounded(supply.capacity_utilization(g.weighted_output))


@query
def operating_costs(g):
    return rounded(supply.operating_costs(g.weighted_output))


# balance


def _balance(g: GridTables) -> DataFrame:
    return balance.grid_balance(
        demand.demand_by_district(g.meter_readings), supply.supply_by_district(g.weighted_output)
    )


@query
def grid_balance(g):
    return rounded(_balance(g))


@query
def grid_balance_hourly(g):
    return rounded(
        balance.grid_balance_hourly(
            demand.demand_by_district_hour(g.meter_readings), supply.supply_by_district_hour(g.weighted_output)
        )
    )


@query
def deficit_districts(g):
    return rounded(balance.deficit_districts(_balance(g)))


@query
def critical_districts(g):
    return rounded(balance.critical_districts(_balance(g)))


@query
def balance_status_counts(g):
    return balance.status_counts(_balance(g))


@query
def blackout_risk_summary(g):
    return rounded(balance.blackout_risk_summary(_balance(g)))


# fraud


def _totals_and_stats(g: GridTables) -> tuple[DataFrame, DataFrame]:
    totals = fraud.meter_totals(g.meter_readings)
    return totals, fraud.district_stats(totals)


def _zscores(g: GridTables) -> DataFrame:
    """Totals and statistics are written once per data folder, from readings in buckets."""
    return g.shared("scores", lambda path: meter_scores(meter_layout.meter_district_sums(g.layout), path))[1]


@query
def meter_totals(g):
    return rounded(fraud.meter_totals(g.meter_readings))


@query
def district_stats(g):
    return rounded(_totals_and_stats(g)[1])


@query
def valid_district_stats(g):
    return rounded(fraud.valid_district_stats(_totals_and_stats(g)[1]))


@query
def meter_totals_by_bucket(g):
    """As ``meter_totals``, from readings that are in buckets by meter and stay there."""
    return rounded(fraud.one_district_per_meter(meter_layout.meter_district_sums(g.layout)))


@query
def district_stats_by_year(g):
    """As ``district_stats``, from states that take in the readings of one year after the other."""
    years = F.year("timestamp")
    # a handful of years
    known = sorted(r[0] for r in g.meter_readings.select(years.alias("year")).distinct().collect())
    base, state = scratch_dir(g.spark), increments.no_readings(g.spark)
    for year in known:
        state = increments.with_readings(state, g.meter_readings.where(years == year), f"{base}/{year}")
    return rounded(increments.district_stats(state))


@query
def meter_zscores(g):
    return rounded(_zscores(g))


@query
def fraud_cases(g):
    return rounded(fraud.fraud_cases(_zscores(g)))


@query
def top_suspicious_meters(g):
    return rounded(fraud.top_suspicious_meters(_zscores(g)))


@query
def fraud_impact(g):
    return rounded(fraud.fraud_impact(_zscores(g)))


@query
def fraud_status_counts(g):
    return balance.status_counts(_zscores(g))


# carbon


@query
def project_emissions(g):
    return carbon.emission_pairs(g.plant_output)


@query
def emission_factor_join(g):
    return carbon.emission_pairs_by_join(g.plant_output, carbon.emission_factors(g.spark))


@query
def emissions_by_type(g):
    return rounded(carbon.emissions_by_type(g.plant_output))


@query
def emissions_by_district(g):
    return rounded(carbon.emissions_by_district(g.plant_output))


@query
def emissions_by_hour(g):
    return rounded(carbon.emissions_by_hour(g.plant_output))


@query
def renewable_share(g):
    return rounded(carbon.renewable_share(g.plant_output))


@query
def generation_by_class(g):
    return rounded(carbon.generation_by_class(g.plant_output))


@query
def emission_intensity(g):
    return rounded(
        carbon.emission_intensity(
            carbon.emissions_by_type(g.plant_output), supply.supply_by_district(g.weighted_output)
        )
    )


@query
def carbon_summary(g):
    return rounded(carbon.carbon_summary(g.plant_output, supply.supply_by_district(g.weighted_output)))


# report frames


@query
def chart_demand_ranking(g):
    return rounded(reports.demand_ranking(demand.demand_by_district(g.meter_readings)))


@query
def chart_supply_ranking(g):
    return rounded(reports.supply_ranking(supply.supply_by_plant_type(g.weighted_output)))


@query
def chart_emission_profile(g):
    return rounded(reports.emission_profile(carbon.emissions_by_hour(g.plant_output)))


@query
def chart_demand_share(g):
    return rounded(reports.demand_share(demand.demand_by_meter_type(g.meter_readings)))


@query
def chart_utilization(g):
    return rounded(reports.utilization_ranking(supply.capacity_utilization(g.weighted_output)))


@query
def chart_grid_balance(g):
    return rounded(reports.balance_ranking(_balance(g)))


@query
def zscore_histogram(g):
    scores = written(_zscores(g).select("zscore"), f"{scratch_dir(g.spark)}/zscores")
    return rounded(reports.zscore_histogram(scores))


@query
def chart_emission_share(g):
    return rounded(reports.emission_share(carbon.emissions_by_type(g.plant_output)))


@query
def chart_renewable_mix(g):
    return rounded(reports.renewable_mix(g.plant_output))


@query
def dash_demand_summary(g):
    return rounded(reports.demand_metrics(g.meter_readings))


@query
def dash_supply_summary(g):
    return rounded(reports.supply_metrics(g.weighted_output))


@query
def dash_grid_alerts(g):
    return rounded(reports.grid_alerts(balance.blackout_risk_summary(_balance(g))))


# weather, availability and load


@query
def hourly_spine(g):
    """Every hour from each plant's first recorded hour to its last, counted by month."""
    period = g.plant_output.groupBy(F.col("plant_id").alias("id")).agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    spine = weather.recorded_spine(period, F.col("first"), F.col("last"))
    month = F.date_format("timestamp", "yyyy-MM").alias("month")
    return spine.groupBy("id", month).agg(
        F.count(F.lit(1)).alias("hours"), F.min("timestamp").alias("first_hour"), F.max("timestamp").alias("last_hour")
    )


@query
def reporting_gaps(g):
    return weather.reporting_gaps(g.plant_output, "plant_id")


@query
def reporting_gaps_by_month(g):
    """As ``reporting_gaps``, by plant and month with the ends of months stitched."""
    return weather.reporting_gaps_by_month(g.plant_output, "plant_id")


@query
def weather_factors(g):
    return weather.weather_factors(g.weather)


@query
def wind_band(g):
    return weather.wind_bands(g.weather)


@query
def plant_availability(g):
    return rounded(
        weather.plant_availability(g.plant_hours.drop("efficiency", "operating_cost"), g.weather_factors)
    )


@query
def expected_output(g):
    return weather.expected_output(g.plant_hours, g.weather_factors)


@query
def weather_adjusted_supply(g):
    """Supply by district as the weather should have left it."""
    return rounded(supply.supply_by_district(weather.expected_output(g.plant_hours, g.weather_factors)))


@query
def load_factor(g):
    return weather.load_factors(g.meter_readings)


@query
def expected_consumption(g):
    """Every reading next to what its meter was expected to use."""
    return weather.expected_consumption(meter_layout.readings_of_meters(g.layout, "base_consumption"))


@query
def weather_condition_distribution(g):
    return rounded(weather.condition_distribution(g.weather))


@query
def plant_summary_by_type(g):
    return rounded(weather.plant_summary_by_type(g.plants))


# everything

_RUNS: dict[tuple[str, str], tuple[str, dict[str, DataFrame]]] = {}


def _full_run(g: GridTables) -> tuple[str, dict[str, DataFrame]]:
    """Folder and results of a full run over the raw tables as CSV: one per session and data folder."""
    key = (g.spark.sparkContext.applicationId, g.sf_dir)
    if key not in _RUNS:
        base = scratch_dir(g.spark)
        for table in ("meter_readings", "plant_output", "weather"):
            writers.write_csv(getattr(g, table), f"{base}/raw/{table}.csv")
        _RUNS[key] = f"{base}/results", run_all(g.spark, f"{base}/raw", f"{base}/results")
    return _RUNS[key]


def _saved(g: GridTables, name: str) -> DataFrame:
    folder, results = _full_run(g)
    return read_saved(g.spark, folder, name, results[name].schema)


@query
def full_run_row_counts(g):
    """Rows of each of the saved results of a full run."""
    return readers.row_counts({name: _saved(g, name) for name in OUTPUTS})


@query
def published_row_counts(g):
    """The manifest of a run that was published: rows of its results, counted as they were written."""

    def publish(base: str) -> str:
        for table in publishing.RAW_TABLES:
            writers.write_parquet(getattr(g, table), f"{base}/raw/{table}.parquet")
        publishing.publish_run(Run(g.spark, f"{base}/raw", f"{base}/out", "parquet", "parquet"), "first")
        return f"{base}/out"

    out = g.shared("published", publish)
    return publishing.manifest(g.spark, out, publishing.published_run(g.spark, out))


def _register_full_run() -> None:
    for name in OUTPUTS:
        QUERIES[f"full_run_{name}"] = lambda g, name=name: rounded(_saved(g, name))
    for name in ("blackout_risk", "fraud_impact", "carbon_summary"):
        QUERIES[f"full_run_{name}"] = lambda g, name=name: rounded(_full_run(g)[1][name])


_register_full_run()


def bind(build: Callable[[GridTables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(GridTables(spark, sf_dir))
