"""Balance of supply against demand per district, and the risk of blackouts.

Both inputs are grouped by the join keys already, so their partitioning serves the join without another shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger import constants as C
from wattledger.functions import grid


def _balanced(demand: DataFrame, supply: DataFrame, keys: list[str], status) -> DataFrame:
    joined = demand.join(supply, keys, "inner").select(
        *keys,
        grid.demand_mwh(F.col("total_demand_kwh")).alias("demand_mwh"),
        F.col("total_supply_mw").alias("supply_mw"),
    )
    return (
        joined.withColumn("net_load_mw", F.col("supply_mw") - F.col("demand_mwh"))
        .withColumn("balance_ratio", grid.balance_ratio(F.col("net_load_mw"), F.col("supply_mw")))
        .withColumn("status", status(F.col("balance_ratio")))
    )


def grid_balance(demand_by_district: DataFrame, supply_by_district: DataFrame) -> DataFrame:
    """Net load, ratio and five-band status of the districts that have both demand and supply."""
    return _balanced(demand_by_district, supply_by_district, ["district_id"], grid.balance_status)


def grid_balance_hourly(demand_by_district_hour: DataFrame, supply_by_district_hour: DataFrame) -> DataFrame:
    """Net load, ratio and three-band status per district and hour of day."""
    return _balanced(
        demand_by_district_hour, supply_by_district_hour, ["district_id", "hour"], grid.hourly_balance_status
    )


def deficit_districts(balance: DataFrame) -> DataFrame:
    return balance.where(F.col("net_load_mw") < 0)


def critical_districts(balance: DataFrame) -> DataFrame:
    return balance.where(F.col("status") == "CRITICAL")


def status_counts(frame: DataFrame) -> DataFrame:
    """Rows per status, of balanced districts or scored meters."""
    return frame.groupBy("status").count()


def blackout_risk_summary(balance: DataFrame) -> DataFrame:
    """One row: districts per status, ids of the critical ones, total deficit.

    The id list has at most one short id per district; ``critical_districts`` gives the same as rows.
    """
    critical = F.col("status") == "CRITICAL"
    net = F.col("net_load_mw")
    counts = [F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in C.BALANCE_STATUSES]
    return balance.agg(
        *counts,
        F.array_join(F.sort_array(F.collect_list(F.when(critical, F.col("district_id")))), ", ").alias(
            "critical_districts"
        ),
        F.coalesce(F.sum(F.when(net < 0, net)), F.lit(0.0)).alias("total_deficit_mw"),
        F.count_if(critical).alias("districts_at_risk"),
    )
