"""Meter sums and district statistics that take in new days without the readings of old ones.

Kept are the energy per meter and district, and the count, mean and sum of squared deviations of the meter totals of each
district and group of meters; a meter's group follows from its id. New readings change the totals of some meters. The moments of
their groups are computed anew from the kept sums, those of all other groups stay, and moments of disjoint groups add up.

Nothing is ever taken away from moments: that would lose the digits of small deviations between large totals. A meter that moves
to another district stays in its group, so it leaves the moments of the old district.

Each update is written as a table of its own: an update that breaks off leaves the state before it as it was.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger import constants as C
from wattledger.operators import fraud
from wattledger.plans.storage import written

GROUPS = 1_024  # of meters; more would leave more of them untouched, and make more rows of moments
SUMS = "meter_id STRING, district_id STRING, kwh DOUBLE, meter_group INT"
MOMENTS = "district_id STRING, meter_group INT, n BIGINT, mean DOUBLE, squares DOUBLE"


@dataclass(frozen=True)
class FraudState:
    """sums: energy per meter and district; moments: count, mean and squared deviations of meter totals by district and group."""

    sums: DataFrame
    moments: DataFrame


def no_readings(spark: SparkSession) -> FraudState:
    return FraudState(spark.createDataFrame([], SUMS), spark.createDataFrame([], MOMENTS))


def read_state(spark: SparkSession, folder: str) -> FraudState:
    return FraudState(spark.read.schema(SUMS).parquet(f"{folder}/sums"), spark.read.schema(MOMENTS).parquet(f"{folder}/moments"))


def group_of(meter_id: Column) -> Column:
    """A meter's group; NULL is a meter like any other, as it is for a grouping."""
    return F.pmod(F.xxhash64(meter_id), F.lit(GROUPS)).cast("int")


def meter_moments(sums: DataFrame) -> DataFrame:
    """Moments by district and group of the totals behind ``sums``; a NULL total does not count."""
    totals = fraud.one_district_per_meter(sums)
    return totals.groupBy("district_id", group_of(F.col("meter_id")).alias("meter_group")).agg(
        F.count("total_kwh").alias("n"),
        F.avg("total_kwh").alias("mean"),
        (F.var_pop("total_kwh") * F.count("total_kwh")).alias("squares"),
    )


def merged_moments(moments: DataFrame) -> DataFrame:
    """district_id, n, mean and squares of all groups of a district together.

    Deviations of the groups are taken from the common mean, so that no digits are lost between large numbers.
    """
    # as many rows as there are groups
    groups = moments.groupBy("district_id").agg(F.collect_list(F.struct("n", "mean", "squares")).alias("groups"))

    def total(term: Callable[[Column], Column]) -> Column:
        return F.aggregate("groups", F.lit(0.0), lambda x, group: x + F.when(group["n"] > 0, term(group)).otherwise(F.lit(0.0)))

    counted = groups.withColumn("n", F.aggregate("groups", F.lit(0).cast("bigint"), lambda x, group: x + group["n"]))
    # around the mean of some group: sums of small numbers
    some = F.try_element_at(F.transform(F.filter("groups", lambda group: group["n"] > 0), lambda group: group["mean"]), F.lit(1))
    mean = F.when(F.col("n") > 0, F.col("some") + total(lambda group: group["n"] * (group["mean"] - F.col("some"))) / F.col("n"))
    apart = lambda group: group["squares"] + group["n"] * (group["mean"] - F.col("mean")) * (group["mean"] - F.col("mean"))
    return (
        counted.withColumn("some", some)
        .withColumn("mean", mean)
        .select("district_id", "n", "mean", F.when(F.col("n") > 0, total(apart)).alias("squares"))
    )


def with_readings(state: FraudState, readings: DataFrame, folder: str) -> FraudState:
    """The state after ``readings``, written to ``folder``, which must not hold one yet.

    The new readings are summed by meter and district before they meet the state; of the state, only the groups they touch
    are looked at for the moments.
    """
    new = fraud.meter_district_sums(readings).withColumn("meter_group", group_of(F.col("meter_id")))
    new = written(new, f"{folder}/new")
    touched = F.broadcast(new.select("meter_group").distinct())  # GROUPS rows at most
    old = state.sums.join(touched, "meter_group", "left_semi")
    after = old.unionByName(new).groupBy("meter_id", "district_id", "meter_group").agg(F.sum("kwh").alias("kwh"))
    after = written(after, f"{folder}/after")
    sums = written(state.sums.join(touched, "meter_group", "left_anti").unionByName(after), f"{folder}/sums")
    kept = state.moments.join(touched, "meter_group", "left_anti")
    return FraudState(sums, written(kept.unionByName(meter_moments(after)), f"{folder}/moments"))


def district_stats(state: FraudState, min_meters: int = C.MIN_METERS_PER_DISTRICT) -> DataFrame:
    """``fraud.district_stats`` of all readings so far, from the moments alone."""
    enough = F.col("n") >= min_meters
    return merged_moments(state.moments).select(
        "district_id",
        F.when(enough, F.col("mean")).otherwise(F.lit(0.0)).alias("mean_kwh"),
        F.when(enough, F.sqrt(F.col("squares") / F.col("n"))).otherwise(F.lit(0.0)).alias("stddev_kwh"),
        F.col("n").alias("meter_count"),
        enough.alias("valid_stats"),
    )


def meter_totals(state: FraudState) -> DataFrame:
    """``fraud.meter_totals`` of all readings so far."""
    return fraud.one_district_per_meter(state.sums)
