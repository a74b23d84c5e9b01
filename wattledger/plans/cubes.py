"""Pre-aggregates that answer many operators from one scan of the facts.

Their size is bounded by districts x types x 24 hours, whatever the number of readings, and map-side aggregation brings
each task's output down to that before the shuffle. They keep the column names of the facts (with ``hour`` in place of
``timestamp``), so the operators run on them unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.functions.common import hour_of
from wattledger.operators.supply import MEASURES


def demand_cube(readings: DataFrame) -> DataFrame:
    """Energy by district, meter type and hour of day: serves the demand operators."""
    return readings.groupBy("district_id", "meter_type", hour_of(readings)).agg(F.sum("kwh").alias("kwh"))


def readings_rollup(readings: DataFrame) -> DataFrame:
    """``demand_cube`` and the sums by meter and district in one scan, told apart by ``per_meter``."""
    keys = ["meter_id", "district_id", "meter_type", "hour"]
    sets = [["district_id", "meter_type", "hour"], ["meter_id", "district_id"]]
    return readings.withColumn("hour", hour_of(readings)).groupingSets(sets, *keys).agg(
        (F.grouping("meter_id") == 0).alias("per_meter"), F.sum("kwh").alias("kwh")
    )


def demand_view(rollup: DataFrame) -> DataFrame:
    return rollup.where(~F.col("per_meter")).select("district_id", "meter_type", "hour", "kwh")


def meter_view(rollup: DataFrame) -> DataFrame:
    return rollup.where("per_meter").select("meter_id", "district_id", "kwh")


def generation_cube(plant_output: DataFrame, matches: DataFrame) -> DataFrame:
    """Sums by district, plant type and hour of day.

    ``raw_output_mw`` sums the plant output itself, for the carbon operators; the other measures are weighted by the
    ``matches`` of the weather join, for the supply operators.
    """
    weight = F.coalesce(F.col("matches"), F.lit(1))
    joined = plant_output.join(matches, "timestamp", "left")
    return joined.groupBy("district_id", "plant_type", hour_of(joined)).agg(
        F.sum("output_mw").alias("raw_output_mw"), *[F.sum(F.col(m) * weight).alias(m) for m in MEASURES]
    )


def supply_view(cube: DataFrame) -> DataFrame:
    return cube.drop("raw_output_mw")


def carbon_view(cube: DataFrame) -> DataFrame:
    return cube.select("district_id", "plant_type", "hour", F.col("raw_output_mw").alias("output_mw"))
