"""Tables behind the charts and the dashboard; drawing them is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.functions.common import clamp, is_positive, ratio_or
from wattledger.operators.carbon import renewable_share


def _with_share(frame: DataFrame, value: str) -> DataFrame:
    """Add the percentage of the frame's total, which enters as a scalar subquery that shares the frame's shuffle."""
    total = frame.agg(F.sum(value)).scalar()
    return frame.withColumn("pct", ratio_or(F.col(value) * 100, total, 0.0))


# charts


def demand_ranking(demand_by_district: DataFrame) -> DataFrame:
    return demand_by_district.orderBy("total_demand_kwh", "district_id")


def demand_share(demand_by_meter_type: DataFrame) -> DataFrame:
    labelled = demand_by_meter_type.withColumn("meter_type", F.initcap("meter_type"))
    return _with_share(labelled, "total_demand_kwh")


def supply_ranking(supply_by_plant_type: DataFrame) -> DataFrame:
    return supply_by_plant_type.orderBy(F.desc("total_supply_mw"), "plant_type")


def utilization_ranking(capacity_utilization: DataFrame) -> DataFrame:
    return capacity_utilization.select(
        "plant_type", (F.col("utilization_rate") * 100).alias("utilization_pct")
    ).orderBy("utilization_pct", "plant_type")


def balance_ranking(grid_balance: DataFrame) -> DataFrame:
    return grid_balance.select("district_id", "net_load_mw", "status").orderBy("net_load_mw", "district_id")


def zscore_histogram(zscores: DataFrame, bins: int = 50, limit: float = 5.0) -> DataFrame:
    """Meters per z-score bin: ``bins`` equal bins between the least and the greatest score within +-``limit``.

    Scores beyond the limit count in the outermost bins. A bin holds its lower edge and the last one both of its edges;
    a flat range is widened by half a unit on each side, and without scores the range is [0, 1]. Empty bins are kept.
    The scores are read twice, for the range and for the counts: pass a written table where they are costly to derive.
    """
    scores = zscores.where(F.col("zscore").isNotNull()).select(
        clamp(F.col("zscore"), -float(limit), float(limit)).alias("z")
    )
    least, greatest = F.min("z"), F.max("z")
    flat = least == greatest
    span = scores.agg(
        F.struct(
            F.when(flat, least - 0.5).otherwise(F.coalesce(least, F.lit(0.0))).alias("lo"),
            F.when(flat, greatest + 0.5).otherwise(F.coalesce(greatest, F.lit(1.0))).alias("hi"),
        )
    ).scalar()
    lo, hi = F.col("span.lo"), F.col("span.hi")

    def edge(index):
        return F.when(index == bins, hi).otherwise(lo + index * ((hi - lo) / F.lit(float(bins))))

    # the division may round across an edge, so the guess is checked against the edges themselves
    guess = F.least(F.floor((F.col("z") - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    index = F.col("guess")
    too_high = F.col("z") < edge(index)
    too_low = (F.col("z") >= edge(index + 1)) & (index < bins - 1)
    counts = (
        scores.withColumn("span", span)
        .withColumn("guess", guess)
        .groupBy((index - too_high.cast("int") + too_low.cast("int")).alias("bin"))
        .count()
    )
    every_bin = zscores.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        every_bin.join(F.broadcast(counts), "bin", "left")  # at most one row per bin
        .withColumn("span", span)
        .select(
            "bin",
            edge(F.col("bin")).alias("bin_lo"),
            edge(F.col("bin") + 1).alias("bin_hi"),
            F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
        )
    )


def emission_share(emissions_by_type: DataFrame) -> DataFrame:
    """Share of each plant type that emits anything."""
    return _with_share(emissions_by_type.where(is_positive(F.col("total_co2_tons"))), "total_co2_tons")


def emission_profile(emissions_by_hour: DataFrame) -> DataFrame:
    return emissions_by_hour.orderBy("hour")


def renewable_mix(plant_output: DataFrame) -> DataFrame:
    """Two rows: renewable and non-renewable generation and their percentages."""
    row = renewable_share(plant_output)
    total = F.col("total_mw")
    source = lambda name, mw: F.struct(
        F.lit(name).alias("source"), F.col(mw).alias("mw"), ratio_or(F.col(mw) * 100, total, 0.0).alias("pct")
    )
    return row.select(
        F.inline(F.array(source("Renewable", "renewable_mw"), source("Non-Renewable", "non_renewable_mw")))
    )


# dashboard


def demand_metrics(readings: DataFrame) -> DataFrame:
    """Metric rows: total demand, number of districts, demand of each meter type. One pass over the readings.

    The two totals are there, as zeros, without readings too.
    """
    base = readings.groupBy("district_id", "meter_type").agg(F.sum("kwh").alias("kwh"))
    districts = F.count_distinct("district_id") + F.coalesce(F.max(F.col("district_id").isNull().cast("int")), F.lit(0))
    totals = base.agg(F.coalesce(F.sum("kwh"), F.lit(0.0)).alias("kwh"), districts.cast("double").alias("districts"))
    metric = lambda name, value: F.struct(F.lit(name).alias("metric"), F.col(value).alias("value"))
    rows = F.array(metric("Total Demand", "kwh"), metric("Districts Monitored", "districts"))
    by_type = base.groupBy("meter_type").agg(F.sum("kwh").alias("value"))
    return totals.select(F.inline(rows)).unionByName(by_type.select(F.initcap("meter_type").alias("metric"), "value"))


def supply_metrics(output: DataFrame) -> DataFrame:
    """Output and utilization per plant type, and a Total row without utilization, which is 0 without output.

    The facts are aggregated by type first; only those sums are rolled up, next to a row of NULLs that keeps the total.
    """
    by_type = output.groupBy("plant_type").agg(
        F.sum("output_mw").alias("output"), F.sum("capacity_mw").alias("capacity"), F.lit(True).alias("known")
    )
    nothing = output.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("plant_type"),
        F.lit(None).cast("double").alias("output"),
        F.lit(None).cast("double").alias("capacity"),
        F.lit(False).alias("known"),
    )
    rolled = by_type.unionByName(nothing).rollup("plant_type").agg(
        (F.grouping("plant_type") == 1).alias("is_total"),
        F.sum("output").alias("output"),
        F.sum("capacity").alias("capacity"),
        F.max("known").alias("known"),
    )
    is_total = F.col("is_total")
    return rolled.where(is_total | F.col("known")).select(
        F.when(is_total, "Total").otherwise(F.initcap("plant_type")).alias("plant_type"),
        F.when(is_total, F.coalesce("output", F.lit(0.0))).otherwise(F.col("output")).alias("total_output_mw"),
        F.when(~is_total, ratio_or(F.col("output"), F.col("capacity"), 0.0)).alias("utilization_rate"),
    )


def grid_alerts(blackout_risk_summary: DataFrame) -> DataFrame:
    """The alert row, or no row while no district is critical."""
    return blackout_risk_summary.where(F.col("districts_at_risk") > 0).select(
        "critical_districts", "total_deficit_mw", "districts_at_risk"
    )
