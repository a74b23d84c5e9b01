"""Relations between results, over the test data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from wattledger.operators import balance, carbon, demand, fraud, reports, supply, weather


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_demand_is_the_same_by_every_key(grid):
    readings = grid.meter_readings
    expected = total(readings, "kwh")
    for df in (
        demand.demand_by_district(readings),
        demand.demand_by_district_hour(readings),
        demand.demand_by_meter_type(readings),
    ):
        assert total(df, "total_demand_kwh") == pytest.approx(expected)
    assert total(fraud.meter_totals(readings), "total_kwh") == pytest.approx(expected)


def test_supply_is_the_same_by_every_key_and_either_join(grid):
    enriched = supply.enrich_with_weather(grid.plant_output, grid.weather)
    expected = total(enriched, "output_mw")
    for output in (enriched, grid.weighted_output):
        for operator in (supply.supply_by_district, supply.supply_by_plant_type, supply.supply_by_district_hour):
            assert total(operator(output), "total_supply_mw") == pytest.approx(expected)
    assert total(supply.capacity_utilization(grid.weighted_output), "total_output_mw") == pytest.approx(expected)


def test_emissions_are_the_same_by_every_key(spark, grid):
    output = grid.plant_output
    expected = total(carbon.emission_pairs(output), "co2_tons")
    for df in (carbon.emissions_by_type(output), carbon.emissions_by_district(output), carbon.emissions_by_hour(output)):
        assert total(df, "total_co2_tons") == pytest.approx(expected)
    joined = carbon.emission_pairs_by_join(output, carbon.emission_factors(spark))
    assert values(joined) == values(carbon.emission_pairs(output))


def test_status_counts_cover_all_rows(grid):
    totals = fraud.meter_totals(grid.meter_readings)
    scores = fraud.meter_zscores(totals, fraud.district_stats(totals))
    meters = scores.count()
    assert total(balance.status_counts(scores), "count") == meters
    assert total(reports.zscore_histogram(scores), "count") == meters
    impact = fraud.fraud_impact(scores).first()
    assert impact["total_meters_analyzed"] == meters
    assert impact["total_fraud_cases"] == fraud.fraud_cases(scores).count()


def test_shares_sum_to_100(grid):
    for df in (
        reports.demand_share(demand.demand_by_meter_type(grid.meter_readings)),
        reports.emission_share(carbon.emissions_by_type(grid.plant_output)),
        reports.renewable_mix(grid.plant_output),
    ):
        assert total(df, "pct") == pytest.approx(100.0)
    by_kind = weather.condition_distribution(grid.weather).groupBy("kind").agg(F.sum("pct")).collect()
    assert [pct for _, pct in by_kind] == pytest.approx([100.0, 100.0])


def test_net_load_is_supply_less_demand(grid):
    balances = balance.grid_balance(
        demand.demand_by_district(grid.meter_readings), supply.supply_by_district(grid.weighted_output)
    )
    for row in balances.collect():
        assert row["net_load_mw"] == row["supply_mw"] - row["demand_mwh"]
    deficits = total(balance.deficit_districts(balances), "net_load_mw")
    assert balance.blackout_risk_summary(balances).first()["total_deficit_mw"] == pytest.approx(deficits)
