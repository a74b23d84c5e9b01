"""The six grid tables as views over the TPC-H-like test tables, whole tables always."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger import constants as C
from wattledger.operators import supply
from wattledger.plans.meter_layout import MeterLayout, write_meter_layout
from wattledger.plans.sizing import broadcast_within
from wattledger.plans.storage import scratch_dir, written
from wattledger.sources.periods import read_by_day, write_by_day


def _hour_of_order(day: Column, order_key: Column) -> Column:
    return day + F.make_dt_interval(F.lit(0), (order_key % 24).cast("int"))


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _pick(index: Column, names: list[str], other: str) -> Column:
    cases = F
    for position, name in enumerate(names):
        cases = cases.when(index == position, name)
    return cases.otherwise(other)


def _pick_number(index: Column, numbers: dict, other: float) -> Column:
    cases = F
    for key, number in numbers.items():
        cases = cases.when(index == key, F.lit(float(number)))
    return cases.otherwise(F.lit(float(other)))


def _meter_columns(part: Column) -> dict[str, Column]:
    return {
        "meter_id": _text("M", part),
        "district_id": F.when(part % 100 == 99, "D010").otherwise(_text("D00", part % 10)),
        "meter_type": _pick(part % 3, ["residential", "commercial"], "industrial"),
    }


def _plant_columns(plant: Column) -> dict[str, Column]:
    """``plant`` is 0 to 49."""
    kind = plant % 7
    return {
        "plant_id": _text("P", plant),
        "plant_type": _pick(kind, ["nuclear", "coal", "gas", "hydro", "wind", "solar"], "geothermal"),
        "district_id": _text("D00", plant % 10),
        "capacity_mw": F.when(kind == 6, F.lit(0.0)).otherwise((25 + plant).cast("double")),
    }


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


# tables that queries share: written once per session and data folder
_SHARED: dict[tuple[str, str, str], object] = {}


class GridTables:
    """Lazy frames; each use plans its own scan of the Parquet files, or of tables that were derived from them once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _parquet(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def shared(self, name: str, build):
        """What ``build`` gives for a new folder, once per session and data folder."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _SHARED:
            _SHARED[key] = build(f"{scratch_dir(self.spark)}/{name}")
        return _SHARED[key]

    @cached_property
    def meter_readings(self) -> DataFrame:
        return self._parquet("lineitem").select(
            _hour_of_order(F.col("l_shipdate"), F.col("l_orderkey")).alias("timestamp"),
            *_named(_meter_columns(F.col("l_partkey"))),
            F.col("l_quantity").alias("kwh"),
            (240 + F.col("l_linenumber")).cast("double").alias("voltage"),
            (F.lit(1.0) - F.col("l_discount")).alias("power_factor"),
        )

    @cached_property
    def plant_output(self) -> DataFrame:
        scale = (75 + 9 * (F.col("o_custkey") % 10)).cast("double") / F.lit(100.0)
        return self._parquet("orders").select(
            _hour_of_order(F.col("o_orderdate"), F.col("o_orderkey")).alias("timestamp"),
            *_named(_plant_columns(F.col("o_custkey") % 50)),
            (F.col("o_totalprice") / F.lit(2600000.0) * scale).alias("output_mw"),
            F.lit(0.5).alias("availability"),
            (F.col("o_totalprice") / F.lit(62500.0)).alias("operating_cost"),
        )

    @cached_property
    def weather(self) -> DataFrame:
        """The hours of the meter readings, those of every 11th day of the month twice.

        Plants also report at other hours, which have no weather. Some cloud factors are missing. The table is written once,
        as a table of its own would be, so that queries need no scan of the readings for it.
        """
        return self.shared("weather", lambda path: written(self._weather(), path))

    def _weather(self) -> DataFrame:
        ts = F.col("timestamp")
        hours = self.meter_readings.select("timestamp").distinct()
        hours = hours.withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(F.day(ts) % 11 == 0, 1).otherwise(0))))
        cloud, wind, rain = F.day(ts) % 5, F.hour(ts) % 5, F.month(ts) % 5
        return hours.select(
            "timestamp",
            _pick(cloud, ["clear", "partly_cloudy", "cloudy", "overcast"], "rainy").alias("cloud_condition"),
            _pick(wind, ["calm", "light", "moderate", "strong"], "extreme").alias("wind_condition"),
            _pick(rain, ["drought", "low", "normal", "high"], "flood").alias("precipitation_condition"),
            F.when(F.hour(ts) % 7 != 3, _pick_number(cloud, {0: 1.0, 1: 0.7, 2: 0.3, 3: 0.1}, 0.05)).alias("cloud_factor"),
            _pick_number(wind, {1: 0.3, 2: 0.7, 3: 1.0}, 0.0).alias("wind_factor"),
            _pick_number(rain, {0: 0.4, 1: 0.7, 2: 1.0, 3: 1.1}, 0.8).alias("precipitation_factor"),
            (20 + F.hour(ts)).cast("double").alias("temperature_c"),
            F.day(ts).cast("double").alias("wind_speed_ms"),
            (50 + F.day(ts)).cast("double").alias("humidity_pct"),
        )

    @cached_property
    def plants(self) -> DataFrame:
        numbers = self._parquet("customer").select((F.col("c_custkey") % 50).alias("plant")).distinct()
        unit_cost = _pick_number(F.col("plant_type"), C.OPERATING_COSTS, 20)
        efficiency = (80 + 2 * (F.col("plant") % 10)).cast("double") / F.lit(100.0)
        return numbers.select(*_named(_plant_columns(F.col("plant"))), efficiency.alias("efficiency")).select(
            "plant_id",
            _text(F.col("plant_id"), " ", F.col("plant_type")).alias("plant_name"),
            "plant_type",
            "district_id",
            "capacity_mw",
            "efficiency",
            unit_cost.alias("operating_cost"),
            F.lit(40.0).alias("latitude"),
            F.lit(-100.0).alias("longitude"),
        )

    @cached_property
    def meters(self) -> DataFrame:
        parts = self._parquet("part")
        base = _pick_number(F.col("meter_type"), {"residential": 1.5, "commercial": 5.0}, 25.0)
        return parts.select(*_named(_meter_columns(F.col("p_partkey")))).select(
            "meter_id",
            "district_id",
            "meter_type",
            base.alias("base_consumption"),
            F.lit(False).alias("is_fraud"),
            _text(F.col("meter_id"), " street").alias("address"),
        )

    @cached_property
    def districts(self) -> DataFrame:
        number = F.substring("district_id", 2, 10).cast("int") % 4
        return self.meters.groupBy("district_id").agg(F.count(F.lit(1)).cast("int").alias("num_meters")).select(
            "district_id",
            _text("City ", F.col("district_id")).alias("district_name"),
            _pick(number, ["industrial", "commercial", "residential"], "mixed").alias("district_type"),
            _pick_number(number, {0: 2.5, 1: 1.5, 2: 1.0}, 1.3).alias("base_demand_factor"),
            F.when(number == 0, 2).when(number == 2, 1).otherwise(0).alias("peak_shift"),
            "num_meters",
        )

    # the small sides of joins with the plant output, counted before they are hinted for broadcast; they are written
    # first, as the tables they stand for would be, so that the count does not derive them a second time

    def _small_side(self, name: str, df: DataFrame) -> DataFrame:
        return self.shared(name, lambda path: broadcast_within(written(df, path)))

    @cached_property
    def weather_factors(self) -> DataFrame:
        return self._small_side("weather_factors", supply.weather_factors_of_hour(self.weather))

    @cached_property
    def weighted_output(self) -> DataFrame:
        matches = self._small_side("weather_matches", supply.weather_matches(self.weather))
        return supply.weather_weighted(self.plant_output, matches)

    @cached_property
    def layout(self) -> MeterLayout:
        """Readings and meters in buckets by meter."""
        return self.shared("layout", lambda path: write_meter_layout(self.meter_readings, self.meters, path))

    @cached_property
    def readings_by_day(self) -> DataFrame:
        return read_by_day(self.spark, "meter_readings", self._by_day("meter_readings"))

    @cached_property
    def output_by_day(self) -> DataFrame:
        return read_by_day(self.spark, "plant_output", self._by_day("plant_output"))

    def _by_day(self, table: str) -> str:
        def write(path: str) -> str:
            write_by_day(getattr(self, table), path)
            return path

        return self.shared(f"{table}_by_day", write)

    @cached_property
    def plant_hours(self) -> DataFrame:
        """Every recorded plant-hour with its plant's efficiency and cost per MWh.

        The plants are the remainders by 50 of a key, which bounds their broadcast.
        """
        plant = F.broadcast(self.plants.select("plant_id", "efficiency", "operating_cost"))
        recorded = self.plant_output.select("timestamp", "plant_id", "plant_type", "district_id", "capacity_mw")
        return recorded.join(plant, "plant_id")
