"""Weather conditions, and what plants and meters are expected to do under them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattledger import constants as C
from wattledger.functions import generation, load
from wattledger.functions.common import literal_rows, round_half_even
from wattledger.operators.supply import enrich_with_weather


def hourly_spine(
    dimension: DataFrame, start: datetime | str | Column, hours: int = C.DEFAULT_HOURS, partitions: int | None = None
) -> DataFrame:
    """Every row of ``dimension`` at every hour of the period, as an added ``timestamp`` column.

    ``start`` is one time for all rows, or a column of ``dimension`` with each row's own. Hours are generated within each row, so nothing is joined or shuffled. A dimension that sits in few files can be
    spread over ``partitions`` tasks first.
    """
    if hours < 1:
        raise ValueError("a period has at least one hour")
    first = start if isinstance(start, Column) else F.lit(str(start)).cast("timestamp_ntz")
    timestamps = F.sequence(first, first + F.make_dt_interval(F.lit(0), F.lit(hours - 1)), F.expr("INTERVAL 1 HOUR"))
    spread = dimension.repartition(partitions) if partitions else dimension
    return spread.withColumn("timestamp", F.explode(timestamps))


def recorded_spine(dimension: DataFrame, first: Column, last: Column, piece: str = "31 days") -> DataFrame:
    """Every row of ``dimension`` at every hour from its ``first`` to its ``last``, both included, as an added ``timestamp``.

    A row's period is cut into pieces before its hours are listed, so that no row holds more hours at once than a piece has.
    Rows without a period, or with one that ends before it begins, have no hours.
    """
    until = F.least(F.col("_until") + F.expr(f"INTERVAL {piece}") - F.expr("INTERVAL 1 HOUR"), last)
    some = dimension.where(first <= last)
    pieces = some.withColumn("_until", F.explode(F.sequence(first, last, F.expr(f"INTERVAL {piece}"))))
    return pieces.withColumn("timestamp", F.explode(F.sequence(F.col("_until"), until, F.expr("INTERVAL 1 HOUR")))).drop("_until")


def reporting_gaps(records: DataFrame, key: str) -> DataFrame:
    """Hours between two records of the same ``key`` that have none: id, last_hour, next_hour and missing_hours.

    Records need a ``timestamp``; rows without one, or without a key, are left out. Equal hours are reduced to one before
    they are ordered, so a key holds as many rows as it has hours.
    """
    hour = F.date_trunc("HOUR", "timestamp").cast("timestamp_ntz")
    known = records.where(F.col(key).isNotNull() & F.col("timestamp").isNotNull())
    hours = known.select(F.col(key).alias("id"), hour.alias("next_hour")).distinct()
    before = F.lag("next_hour").over(Window.partitionBy("id").orderBy("next_hour"))
    missing = F.timestamp_diff("HOUR", F.col("last_hour"), F.col("next_hour")) - 1
    gaps = hours.withColumn("last_hour", before).withColumn("missing_hours", missing)
    return gaps.where("missing_hours > 0").select("id", "last_hour", "next_hour", "missing_hours")


def reporting_gaps_by_month(records: DataFrame, key: str) -> DataFrame:
    """``reporting_gaps`` with a key's hours spread over its months, so that few keys still make many tasks.

    Gaps inside a month are found in the month. Between months only the first and the last hour of each count: one row for each
    key and month, which are put in order and compared with the month before.
    """
    hour = F.date_trunc("HOUR", "timestamp").cast("timestamp_ntz")
    known = records.where(F.col(key).isNotNull() & F.col("timestamp").isNotNull())
    month = (F.year("next_hour") * 12 + F.month("next_hour")).alias("month")
    hours = known.select(F.col(key).alias("id"), hour.alias("next_hour")).select("id", "next_hour", month)
    distinct = hours.distinct()
    within = F.lag("next_hour").over(Window.partitionBy("id", "month").orderBy("next_hour"))
    inside = distinct.withColumn("last_hour", within)
    ends = distinct.groupBy("id", "month").agg(F.min("next_hour").alias("next_hour"), F.max("next_hour").alias("latest"))
    between = ends.withColumn("last_hour", F.lag("latest").over(Window.partitionBy("id").orderBy("month")))
    missing = F.timestamp_diff("HOUR", F.col("last_hour"), F.col("next_hour")) - 1
    columns = ["id", "last_hour", "next_hour"]
    gaps = inside.select(columns).unionByName(between.select(columns)).withColumn("missing_hours", missing)
    return gaps.where("missing_hours > 0")


def weather_factors(weather: DataFrame) -> DataFrame:
    """Factors of the named conditions; NULL for an unknown name."""
    return weather.select(
        "timestamp",
        generation.cloud_factor(F.col("cloud_condition")).alias("cloud_factor"),
        generation.wind_factor(F.col("wind_condition")).alias("wind_factor"),
        generation.precipitation_factor(F.col("precipitation_condition")).alias("precipitation_factor"),
    )


def wind_bands(weather: DataFrame) -> DataFrame:
    """Condition and factor that follow from the measured wind speed."""
    return weather.select(
        "wind_speed_ms", generation.wind_condition(F.col("wind_speed_ms")).alias("wind_condition")
    ).withColumn("wind_factor", generation.wind_factor(F.col("wind_condition")))


def plant_availability(plant_hours: DataFrame, weather: DataFrame) -> DataFrame:
    """Add the availability of each plant-hour (plant_type, timestamp) under the weather of the hour."""
    return (
        enrich_with_weather(plant_hours, weather)
        .withColumn(
            "availability",
            generation.availability(
                F.col("plant_type"),
                F.hour("timestamp"),
                F.col("cloud_factor"),
                F.col("wind_factor"),
                F.col("precipitation_factor"),
            ),
        )
        .drop(*C.MISSING_WEATHER)
    )


def expected_output(plant_hours: DataFrame, weather: DataFrame) -> DataFrame:
    """Output and cost of each plant-hour under its weather.

    ``plant_hours`` has plant columns with ``efficiency`` and, as ``operating_cost``, the cost per MWh; the result has
    the columns of plant output, so the supply operators apply to it.
    """
    output = generation.expected_output_mw(F.col("capacity_mw"), F.col("availability"), F.col("efficiency"))
    return (
        plant_availability(plant_hours, weather)
        .withColumn("expected_mw", output)
        .select(
            "timestamp",
            "plant_id",
            "plant_type",
            "district_id",
            "capacity_mw",
            round_half_even(F.col("availability"), 3).alias("availability"),
            round_half_even(F.col("expected_mw"), 2).alias("output_mw"),
            round_half_even(F.col("expected_mw") * F.col("operating_cost"), 2).alias("operating_cost"),
        )
    )


def load_factors(meter_hours: DataFrame) -> DataFrame:
    """Demand of each row's meter type and hour relative to its base consumption."""
    return meter_hours.select(
        "timestamp", "meter_type", load.load_factor(F.col("meter_type"), F.col("timestamp")).alias("load_factor")
    )


def expected_consumption(meter_hours: DataFrame) -> DataFrame:
    """Energy each meter is expected to use in each hour, next to the recorded ``kwh`` where there is such a column.

    ``meter_hours`` has the meters' base_consumption and meter_type: recorded hours joined with the meters, or a spine over
    the meters table for hours to come.
    """
    recorded = ["kwh"] if "kwh" in meter_hours.columns else []
    return meter_hours.select(
        "timestamp",
        "meter_id",
        *recorded,
        load.expected_kwh(F.col("base_consumption"), F.col("meter_type"), F.col("timestamp")).alias("expected_kwh"),
    )


def condition_distribution(weather: DataFrame) -> DataFrame:
    """Hours and percentage of every known cloud and wind condition, conditions that never occurred included.

    Percentages are of all hours, those with other conditions included.
    """
    kinds = {"cloud": C.CLOUD_FACTORS, "wind": C.WIND_FACTORS}
    pairs = [(kind, name) for kind, names in kinds.items() for name in names]
    known = literal_rows(weather.sparkSession, ["kind", "condition"], pairs)
    combined = weather.groupBy("cloud_condition", "wind_condition").agg(F.count(F.lit(1)).alias("n"))
    by_kind = combined.select(
        F.inline(
            F.array(
                F.struct(F.lit("cloud").alias("kind"), F.col("cloud_condition").alias("condition"), F.col("n")),
                F.struct(F.lit("wind").alias("kind"), F.col("wind_condition").alias("condition"), F.col("n")),
            )
        )
    )
    counted = by_kind.groupBy("kind", "condition").agg(F.sum("n").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("kind")) * 100
    # at most one row per known condition, hence the hint
    observed = counted.withColumn("pct", share).where(F.col("condition").isin([name for _, name in pairs]))
    return known.join(F.broadcast(observed), ["kind", "condition"], "left").select(
        "kind",
        "condition",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("hours"),
        F.coalesce("pct", F.lit(0.0)).alias("pct"),
    )


def plant_summary_by_type(plants: DataFrame) -> DataFrame:
    return plants.groupBy("plant_type").agg(
        F.count("plant_id").alias("count"), F.sum("capacity_mw").alias("total_capacity")
    )
