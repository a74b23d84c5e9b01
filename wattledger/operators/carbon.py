"""CO2 emissions and the renewable share of generation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger import constants as C
from wattledger.functions import emissions as E
from wattledger.functions.common import hour_of, literal_rows, ratio_or


def with_emissions(plant_output: DataFrame) -> DataFrame:
    return plant_output.withColumn("co2_tons", E.co2_tons(F.col("plant_type"), F.col("output_mw")))


def emission_pairs(plant_output: DataFrame) -> DataFrame:
    """Plant type and emissions of every plant reading."""
    return with_emissions(plant_output).select("plant_type", "co2_tons")


def emission_factors(spark: SparkSession) -> DataFrame:
    """The constant factor table as a frame: one row per known plant type, which bounds the broadcast it is hinted for."""
    return F.broadcast(literal_rows(spark, ["plant_type", "factor"], list(C.EMISSION_FACTORS.items())))


def emission_pairs_by_join(plant_output: DataFrame, factors: DataFrame) -> DataFrame:
    """``emission_pairs`` with the factors taken from a table with one row per plant type."""
    factor = F.coalesce(F.col("factor"), F.lit(C.DEFAULT_EMISSION_FACTOR))
    return plant_output.join(factors, "plant_type", "left").select(
        "plant_type", (F.col("output_mw") * factor).alias("co2_tons")
    )


def emissions_by_type(plant_output: DataFrame) -> DataFrame:
    return with_emissions(plant_output).groupBy("plant_type").agg(F.sum("co2_tons").alias("total_co2_tons"))


def emissions_by_district(plant_output: DataFrame) -> DataFrame:
    return with_emissions(plant_output).groupBy("district_id").agg(F.sum("co2_tons").alias("total_co2_tons"))


def emissions_by_hour(plant_output: DataFrame) -> DataFrame:
    return with_emissions(plant_output).groupBy(hour_of(plant_output)).agg(F.sum("co2_tons").alias("total_co2_tons"))


def _sum_where(condition, value: str):
    return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0.0))


def _renewable_sums():
    renewable = E.is_renewable(F.col("plant_type"))
    return [
        _sum_where(renewable, "output_mw").alias("renewable_mw"),
        _sum_where(~renewable, "output_mw").alias("non_renewable_mw"),
    ]


def _with_renewable_share(sums: DataFrame) -> DataFrame:
    share = F.col("renewable_percentage")
    reached = lambda pct: F.coalesce((share >= pct) & ~F.isnan(share), F.lit(False))
    return (
        sums.withColumn("total_mw", F.col("renewable_mw") + F.col("non_renewable_mw"))
        .withColumn("renewable_percentage", ratio_or(F.col("renewable_mw"), F.col("total_mw"), 0.0) * 100)
        .withColumns(
            {"meets_target": reached(C.RENEWABLE_TARGET_PCT), "meets_minimum": reached(C.RENEWABLE_MINIMUM_PCT)}
        )
    )


def renewable_share(plant_output: DataFrame) -> DataFrame:
    """One row: generation by class, the renewable percentage and whether it reaches the goals."""
    return _with_renewable_share(plant_output.agg(*_renewable_sums()))


def generation_by_class(plant_output: DataFrame) -> DataFrame:
    """Output of renewable and non-renewable plants; a class without plants has no row."""
    by_type = plant_output.groupBy("plant_type").agg(F.sum("output_mw").alias("mw"))
    return by_type.groupBy(E.energy_class(F.col("plant_type")).alias("energy_class")).agg(F.sum("mw").alias("total_output_mw"))


def _total(frame: DataFrame, column: str) -> DataFrame:
    return frame.agg(F.coalesce(F.sum(column), F.lit(0.0)).alias(column))


def emission_intensity(emissions: DataFrame, supply: DataFrame) -> DataFrame:
    """One row: total emissions per unit of total supply, 0 without supply.

    ``emissions`` has total_co2_tons and ``supply`` total_supply_mw; the supply total enters as a scalar subquery.
    """
    supplied = _total(supply, "total_supply_mw").scalar()
    return _total(emissions, "total_co2_tons").select(
        ratio_or(F.col("total_co2_tons"), supplied, 0.0).alias("emission_intensity")
    )


def carbon_summary(plant_output: DataFrame, supply: DataFrame) -> DataFrame:
    """One row: total emissions, intensity, status and the renewable share, from one pass over the plant output."""
    supplied = _total(supply, "total_supply_mw").scalar()
    sums = with_emissions(plant_output).agg(
        F.coalesce(F.sum("co2_tons"), F.lit(0.0)).alias("total_emissions_tons"), *_renewable_sums()
    )
    return (
        _with_renewable_share(sums)
        .withColumn("emission_intensity", ratio_or(F.col("total_emissions_tons"), supplied, 0.0))
        .select(
            "total_emissions_tons",
            "emission_intensity",
            E.emission_status(F.col("emission_intensity")).alias("emission_status"),
            "renewable_mw",
            "non_renewable_mw",
            "total_mw",
            "renewable_percentage",
            "meets_target",
            "meets_minimum",
        )
    )
