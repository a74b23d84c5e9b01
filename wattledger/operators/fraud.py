"""Meters whose consumption stands out within their district (two-pass z-scores).

Readings are summed per meter before anything is grouped by district, and district statistics are partial aggregates,
so a district with a large share of all meters is no single task's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger import constants as C
from wattledger.functions import anomaly


def meter_district_sums(readings: DataFrame) -> DataFrame:
    """Energy per meter and district."""
    return readings.groupBy("meter_id", "district_id").agg(F.sum("kwh").alias("kwh"))


def one_district_per_meter(sums: DataFrame) -> DataFrame:
    """Totals per meter from ``meter_district_sums``. A meter seen in several districts belongs to the first by id."""
    return sums.groupBy("meter_id").agg(
        F.min("district_id").alias("district_id"), F.sum("kwh").alias("total_kwh")
    )


def meter_totals(readings: DataFrame) -> DataFrame:
    """Energy and district of each meter.

    The readings are summed by meter and district, which hash aggregation can do; a minimum of strings makes Spark sort
    its input, so that step only sees the sums.
    """
    return one_district_per_meter(meter_district_sums(readings))


def district_stats(totals: DataFrame, min_meters: int = C.MIN_METERS_PER_DISTRICT) -> DataFrame:
    """Mean and population standard deviation of the meter totals; 0 and invalid below ``min_meters`` meters."""
    stats = totals.groupBy("district_id").agg(
        F.avg("total_kwh").alias("mean"),
        F.stddev_pop("total_kwh").alias("stddev"),
        F.count("total_kwh").alias("meter_count"),
    )
    enough = F.col("meter_count") >= min_meters
    return stats.select(
        "district_id",
        F.when(enough, F.col("mean")).otherwise(F.lit(0.0)).alias("mean_kwh"),
        F.when(enough, F.col("stddev")).otherwise(F.lit(0.0)).alias("stddev_kwh"),
        "meter_count",
        enough.alias("valid_stats"),
    )


def valid_district_stats(stats: DataFrame) -> DataFrame:
    return stats.where("valid_stats")


def meter_zscores(totals: DataFrame, stats: DataFrame, salts: int = 1) -> DataFrame:
    """Score, status and fraud type of every meter of a district with valid statistics.

    Statistics are joined back rather than computed by a window over the district, which would bring all meters of a
    district into one task. Hint them for broadcast where their number is known to be small; where it is not, ``salts``
    spreads each district over that many join keys.
    """
    reference = valid_district_stats(stats).select(
        "district_id", F.col("mean_kwh").alias("district_mean"), F.col("stddev_kwh").alias("district_stddev")
    )
    keys = ["district_id"]
    if salts > 1:
        keys.append("salt")
        reference = reference.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        # never NULL, and known to be: a check for NULL salts would reach the readings and cost the shared shuffle
        totals = totals.withColumn("salt", F.coalesce(F.pmod(F.hash("meter_id"), F.lit(salts)), F.lit(0)))
    z = F.col("zscore")
    return (
        totals.join(reference, keys)
        .select("meter_id", "district_id", "total_kwh", "district_mean", "district_stddev")
        .withColumn("zscore", anomaly.zscore(F.col("total_kwh"), F.col("district_mean"), F.col("district_stddev")))
        .withColumns({"status": anomaly.meter_status(z), "fraud_type": anomaly.fraud_type(z)})
    )


def fraud_cases(zscores: DataFrame) -> DataFrame:
    return zscores.where(anomaly.is_fraud_case(F.col("status")))


def top_suspicious_meters(zscores: DataFrame, top_n: int = 20) -> DataFrame:
    """The ``top_n`` meters by size of the score; equal sizes by meter id."""
    return zscores.orderBy(F.abs("zscore").desc(), "meter_id").limit(top_n)


def fraud_impact(zscores: DataFrame, price_per_kwh: float = C.PRICE_PER_KWH) -> DataFrame:
    """One row: cases, meters analyzed, rate, and the energy and revenue under-reporting is estimated to cost."""
    case = anomaly.is_fraud_case(F.col("status"))
    stolen = anomaly.stolen_kwh(F.col("total_kwh"), F.col("district_mean"), F.col("zscore"), F.col("fraud_type"))
    totals = zscores.agg(
        F.count_if(case).alias("total_fraud_cases"),
        F.count(F.lit(1)).alias("total_meters_analyzed"),
        F.coalesce(F.sum(F.when(case, stolen)), F.lit(0.0)).alias("estimated_stolen_kwh"),
    )
    cases, meters = F.col("total_fraud_cases"), F.col("total_meters_analyzed")
    return totals.select(
        cases,
        meters,
        F.when(meters > 0, cases / meters * 100).otherwise(F.lit(0.0)).alias("fraud_rate_pct"),
        "estimated_stolen_kwh",
        (F.col("estimated_stolen_kwh") * F.lit(float(price_per_kwh))).alias("estimated_revenue_loss"),
    )
