"""Energy demand from smart-meter readings.

All measures are sums, so each operator accepts the readings or any pre-aggregate of them that keeps its keys
(``wattledger.plans.cubes``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.functions.common import hour_of


def demand_pairs(readings: DataFrame) -> DataFrame:
    """District and energy of every reading."""
    return readings.select("district_id", "kwh")


def demand_by_district(readings: DataFrame) -> DataFrame:
    return readings.groupBy("district_id").agg(F.sum("kwh").alias("total_demand_kwh"))


def demand_by_district_hour(readings: DataFrame) -> DataFrame:
    return readings.groupBy("district_id", hour_of(readings)).agg(F.sum("kwh").alias("total_demand_kwh"))


def demand_by_meter_type(readings: DataFrame) -> DataFrame:
    return readings.groupBy("meter_type").agg(F.sum("kwh").alias("total_demand_kwh"))


def peak_demand_districts(readings: DataFrame, top_n: int = 5) -> DataFrame:
    """The ``top_n`` districts by demand; equal demands by district id."""
    return demand_by_district(readings).orderBy(F.desc("total_demand_kwh"), "district_id").limit(top_n)
