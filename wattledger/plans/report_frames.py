"""All report tables of a full run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from wattledger.operators import balance, reports


def chart_frames(results: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The table behind each chart, from the results of ``wattledger.plans.full_run.analyze``."""
    return {
        "demand_by_district": reports.demand_ranking(results["total_demand"]),
        "demand_by_type": reports.demand_share(results["type_demand"]),
        "supply_by_type": reports.supply_ranking(results["type_supply"]),
        "capacity_utilization": reports.utilization_ranking(results["utilization"]),
        "grid_balance": reports.balance_ranking(results["grid_balance"]),
        "zscore_distribution": reports.zscore_histogram(results["meter_zscores"]),
        "meter_status": balance.status_counts(results["meter_zscores"]),
        "emissions_by_type": reports.emission_share(results["emissions_by_type"]),
        "hourly_emissions": reports.emission_profile(results["emissions_hourly"]),
        "renewable_mix": reports.renewable_mix(results["carbon_cube"]),
    }


def dashboard_frames(results: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The table behind each panel of the dashboard."""
    return {
        "demand": reports.demand_metrics(results["demand_cube"]),
        "supply": reports.supply_metrics(results["supply_cube"]),
        "balance": balance.status_counts(results["grid_balance"]),
        "alerts": reports.grid_alerts(results["blackout_risk"]),
        "fraud": results["fraud_impact"],
        "carbon": results["carbon_summary"],
    }
