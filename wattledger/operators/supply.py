"""Power supply from plant output, enriched with the weather of the hour.

The grid-wide weather table holds one row per hour. Enrichment is a left join, so an hour listed twice counts its plant
rows twice in every sum over the enriched frame. ``weather_weighted`` gives the same sums without producing the copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger import constants as C
from wattledger.functions.common import hour_of, ratio_or

MEASURES = ("output_mw", "capacity_mw", "operating_cost")


def supply_pairs(plant_output: DataFrame) -> DataFrame:
    """District and power of every plant reading."""
    return plant_output.select("district_id", "output_mw")


def weather_factors_of_hour(weather: DataFrame) -> DataFrame:
    """The columns of the weather table the enrichment needs; all of fixed width."""
    return weather.select("timestamp", *C.MISSING_WEATHER)


def enrich_with_weather(plant_output: DataFrame, weather: DataFrame) -> DataFrame:
    """Add the weather factors of the hour; hours without weather get the defaults."""
    return plant_output.join(weather_factors_of_hour(weather), "timestamp", "left").fillna(C.MISSING_WEATHER)


def weather_matches(weather: DataFrame) -> DataFrame:
    """Number of weather rows per timestamp; one fixed-width row per distinct hour."""
    return weather.groupBy("timestamp").agg(F.count(F.lit(1)).alias("matches"))


def weather_weighted(plant_output: DataFrame, matches: DataFrame) -> DataFrame:
    """Plant output whose measures are multiplied by the weather rows of their hour (1 where there are none).

    Sums over this frame equal sums over the enriched frame, but no row is copied: an hour that is frequent on both
    sides costs the sum of its rows, not their product.
    """
    weight = F.coalesce(F.col("matches"), F.lit(1))
    joined = plant_output.join(matches, "timestamp", "left")
    return joined.withColumns({m: F.col(m) * weight for m in MEASURES}).drop("matches")


def supply_by_district(output: DataFrame) -> DataFrame:
    return output.groupBy("district_id").agg(F.sum("output_mw").alias("total_supply_mw"))


def supply_by_plant_type(output: DataFrame) -> DataFrame:
    return output.groupBy("plant_type").agg(F.sum("output_mw").alias("total_supply_mw"))


def supply_by_district_hour(output: DataFrame) -> DataFrame:
    return output.groupBy("district_id", hour_of(output)).agg(F.sum("output_mw").alias("total_supply_mw"))


def capacity_utilization(output: DataFrame) -> DataFrame:
    """Output relative to capacity per plant type; 0 for a type without capacity."""
    totals = output.groupBy("plant_type").agg(
        F.sum("output_mw").alias("total_output_mw"), F.sum("capacity_mw").alias("total_capacity_mw")
    )
    return totals.withColumn(
        "utilization_rate", ratio_or(F.col("total_output_mw"), F.col("total_capacity_mw"), 0.0)
    )


def operating_costs(output: DataFrame) -> DataFrame:
    return output.groupBy("plant_type").agg(F.sum("operating_cost").alias("total_operating_cost"))
