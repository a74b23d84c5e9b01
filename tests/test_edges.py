"""Literal frames for every rule on thresholds, NULL, NaN, zero divisors and empty input."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from wattledger import schemas
from wattledger.functions import anomaly, common, emissions, generation, grid, load
from wattledger.operators import balance, carbon, demand, fraud, reports, supply, weather

NAN = float("nan")
READING = "timestamp STRING, meter_id STRING, district_id STRING, meter_type STRING, kwh DOUBLE"
OUTPUT = (
    "timestamp STRING, plant_id STRING, plant_type STRING, district_id STRING, "
    "capacity_mw DOUBLE, output_mw DOUBLE, availability DOUBLE, operating_cost DOUBLE"
)
T0 = "2024-06-01 00:00:00"


def evaluate(frame, column, value, kind="double"):
    """The value of a one-argument expression."""
    return frame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


def output_row(plant_type="coal", mw=10.0, district="D1", ts=T0, capacity=20.0, cost=1.0):
    return (ts, "P1", plant_type, district, capacity, mw, 0.5, cost)


# balance


def balanced(frame, demand_kwh, supply_mw):
    demands = frame([("D1", demand_kwh)], "district_id STRING, total_demand_kwh DOUBLE")
    supplies = frame([("D1", supply_mw)], "district_id STRING, total_supply_mw DOUBLE")
    return balance.grid_balance(demands, supplies).first()


@pytest.mark.parametrize(
    ("demand_kwh", "status", "hourly"),
    [
        (115000.0, "WARNING", "WARNING"),
        (115001.0, "CRITICAL", "CRITICAL"),
        (105000.0, "OK", "OK"),
        (105001.0, "WARNING", "WARNING"),
        (100000.0, "NORMAL", "OK"),
        (80000.0, "NORMAL", "OK"),
        (79000.0, "OK", "OK"),
        (70000.0, "OK", "OK"),
        (69000.0, "EXCESS", "OK"),
    ],
)
def test_balance_thresholds(frame, demand_kwh, status, hourly):
    row = balanced(frame, demand_kwh, 100.0)
    assert row["status"] == status
    assert row["demand_mwh"] == demand_kwh / 1000
    assert row["net_load_mw"] == 100.0 - demand_kwh / 1000
    assert row["balance_ratio"] == row["net_load_mw"] / 100.0
    by_hour = balance.grid_balance_hourly(
        frame([("D1", 5, demand_kwh)], "district_id STRING, hour INT, total_demand_kwh DOUBLE"),
        frame([("D1", 5, 100.0)], "district_id STRING, hour INT, total_supply_mw DOUBLE"),
    ).first()
    assert by_hour["status"] == hourly


@pytest.mark.parametrize("supply_mw", [0.0, -1.0, None, NAN])
def test_no_positive_supply_is_critical(frame, supply_mw):
    row = balanced(frame, 1000.0, supply_mw)
    assert (row["balance_ratio"], row["status"]) == (-1.0, "CRITICAL")


def test_undefined_demand_is_ok(frame):
    row = balanced(frame, NAN, 100.0)
    assert math.isnan(row["balance_ratio"])
    assert row["status"] == "OK"
    assert evaluate(frame, grid.hourly_balance_status, NAN) == "OK"
    deficits = balance.deficit_districts(
        frame([("D1", NAN), ("D2", -1.0)], "district_id STRING, net_load_mw DOUBLE")
    )
    assert values(deficits, "district_id") == [("D2",)]


def test_join_gaps_and_null_keys_drop(frame):
    demands = frame([("D1", 1.0), (None, 1.0)], "district_id STRING, total_demand_kwh DOUBLE")
    supplies = frame([("D2", 1.0), (None, 1.0)], "district_id STRING, total_supply_mw DOUBLE")
    assert balance.grid_balance(demands, supplies).count() == 0


def test_risk_summary(frame):
    rows = [("D2", -5.0, "CRITICAL"), ("D1", -2.0, "CRITICAL"), ("D3", -1.0, "WARNING"), ("D4", 3.0, "EXCESS")]
    balances = frame(rows, "district_id STRING, net_load_mw DOUBLE, status STRING")
    summary = balance.blackout_risk_summary(balances)
    row = summary.first()
    assert row["critical_districts"] == "D1, D2"
    assert (row["n_critical"], row["n_warning"], row["n_normal"], row["n_ok"], row["n_excess"]) == (2, 1, 0, 0, 1)
    assert (row["total_deficit_mw"], row["districts_at_risk"]) == (-8.0, 2)
    assert values(reports.grid_alerts(summary)) == [("D1, D2", -8.0, 2)]
    calm = balance.blackout_risk_summary(balances.where("status = 'EXCESS'"))
    assert (calm.first()["critical_districts"], calm.first()["total_deficit_mw"]) == ("", 0.0)
    assert reports.grid_alerts(calm).count() == 0


# fraud


@pytest.mark.parametrize(
    ("total", "status", "kind"),
    [
        (3.0, "FRAUD_LIKELY", "NONE"),
        (-3.0, "FRAUD_LIKELY", "NONE"),
        (3.0001, "FRAUD_LIKELY", "OVER_REPORTING"),
        (-3.0001, "FRAUD_LIKELY", "UNDER_REPORTING"),
        (2.5, "SUSPICIOUS", "NONE"),
        (2.0, "MONITOR", "NONE"),
        (1.99, "NORMAL", "NONE"),
        (None, "NORMAL", "NONE"),
    ],
)
def test_zscore_bands(frame, total, status, kind):
    totals = frame([("M1", "D1", total)], "meter_id STRING, district_id STRING, total_kwh DOUBLE")
    stats = frame(
        [("D1", 0.0, 1.0, 30, True)],
        "district_id STRING, mean_kwh DOUBLE, stddev_kwh DOUBLE, meter_count BIGINT, valid_stats BOOLEAN",
    )
    row = fraud.meter_zscores(totals, stats).first()
    assert (row["zscore"], row["status"], row["fraud_type"]) == (total, status, kind)


def district_meters(district, count, kwh=lambda i: 5.0):
    return [(T0, f"{district}-{i}", district, "residential", kwh(i)) for i in range(count)]


def test_min_meters_per_district(frame):
    rows = district_meters("D1", 29) + district_meters("D2", 30, float) + district_meters("D3", 30)
    totals = fraud.meter_totals(frame(rows, READING))
    stats = fraud.district_stats(totals)
    by_district = {r["district_id"]: r for r in stats.collect()}
    assert tuple(by_district["D1"])[1:] == (0.0, 0.0, 29, False)
    assert by_district["D2"]["valid_stats"] and by_district["D2"]["mean_kwh"] == 14.5
    assert by_district["D2"]["stddev_kwh"] == pytest.approx(math.sqrt((30**2 - 1) / 12))
    assert tuple(by_district["D3"])[1:] == (5.0, 0.0, 30, True)
    assert values(fraud.valid_district_stats(stats), "district_id") == [("D2",), ("D3",)]
    scores = fraud.meter_zscores(totals, stats)
    assert {r["district_id"] for r in scores.collect()} == {"D2", "D3"}
    assert {r["zscore"] for r in scores.where("district_id = 'D3'").collect()} == {0.0}
    assert fraud.fraud_impact(scores).first()["total_meters_analyzed"] == 60


def test_nan_reading_silences_its_district(frame):
    rows = district_meters("D1", 30, lambda i: NAN if i == 0 else float(i))
    totals = fraud.meter_totals(frame(rows, READING))
    stats = fraud.district_stats(totals)
    assert math.isnan(stats.first()["mean_kwh"])
    scores = fraud.meter_zscores(totals, stats).collect()
    assert len(scores) == 30
    assert {(r["zscore"], r["status"], r["fraud_type"]) for r in scores} == {(0.0, "NORMAL", "NONE")}


def test_meter_in_two_districts_takes_the_first(frame):
    rows = [(T0, "M1", "D2", "residential", 1.0), (T0, "M1", "D1", "residential", 2.0), (T0, "M1", None, "x", 4.0)]
    assert values(fraud.meter_totals(frame(rows, READING))) == [("M1", "D1", 7.0)]


SCORED = (
    "meter_id STRING, district_id STRING, total_kwh DOUBLE, district_mean DOUBLE, district_stddev DOUBLE, "
    "zscore DOUBLE, status STRING, fraud_type STRING"
)


def test_fraud_impact(frame):
    rows = [
        ("M1", "D1", 10.0, 100.0, 1.0, -6.0, "FRAUD_LIKELY", "UNDER_REPORTING"),  # 100 * 3 - 10
        ("M2", "D1", 900.0, 100.0, 1.0, -6.0, "FRAUD_LIKELY", "UNDER_REPORTING"),  # negative, counts 0
        ("M3", "D1", 900.0, 100.0, 1.0, 6.0, "FRAUD_LIKELY", "OVER_REPORTING"),
        ("M4", "D1", 100.0, 100.0, 1.0, 0.0, "NORMAL", "NONE"),
    ]
    row = fraud.fraud_impact(frame(rows, SCORED)).first()
    assert (row["total_fraud_cases"], row["total_meters_analyzed"], row["fraud_rate_pct"]) == (3, 4, 75.0)
    assert row["estimated_stolen_kwh"] == 290.0
    assert row["estimated_revenue_loss"] == pytest.approx(34.8)
    assert tuple(fraud.fraud_impact(frame([], SCORED)).first()) == (0, 0, 0.0, 0.0, 0.0)
    assert evaluate(frame, lambda x: anomaly.stolen_kwh(x, F.lit(1.0), F.lit(-4.0), F.lit("UNDER_REPORTING")), NAN) == 0


def test_topk_ties_are_ordered_by_id(frame):
    rows = [(T0, f"M{i}", f"D{i}", "residential", 1.0) for i in (3, 1, 2)]
    top = demand.peak_demand_districts(frame(rows, READING), top_n=2)
    assert [r["district_id"] for r in top.collect()] == ["D1", "D2"]
    scored = frame([(m, "D", 0.0, 0.0, 0.0, z, "", "") for m, z in (("b", -4.0), ("a", 4.0), ("c", 5.0))], SCORED)
    assert [r["meter_id"] for r in fraud.top_suspicious_meters(scored, 2).collect()] == ["c", "a"]


# sums over missing values


def test_null_measures_and_keys(frame):
    rows = [
        (T0, "M1", "D1", "residential", 1.0),
        (T0, "M1", "D1", "residential", None),
        (None, "M2", "D1", "commercial", 2.0),
        (T0, "M3", "D2", None, None),
    ]
    readings = frame(rows, READING)
    assert values(demand.demand_by_district(readings)) == [("D1", 3.0), ("D2", None)]
    assert values(demand.demand_by_district_hour(readings)) == [("D1", 0, 1.0), ("D1", None, 2.0), ("D2", 0, None)]
    assert values(demand.demand_by_meter_type(readings)) == [("commercial", 2.0), ("residential", 1.0), (None, None)]
    output = frame([output_row(None, 10.0), output_row("tidal", 10.0), output_row("solar", None)], OUTPUT)
    assert values(carbon.emissions_by_type(output)) == [("solar", None), ("tidal", 5.0), (None, 5.0)]
    share = carbon.renewable_share(output).first()
    assert (share["renewable_mw"], share["non_renewable_mw"]) == (0.0, 20.0)
    assert (share["meets_target"], share["meets_minimum"]) == (False, False)


def test_district_count_includes_a_null_district(frame):
    rows = [(T0, "M", d, "residential", 1.0) for d in ("D1", "D2", "D2", None)]
    metrics = dict(values(reports.demand_metrics(frame(rows, READING))))
    assert metrics == {"Total Demand": 4.0, "Districts Monitored": 3.0, "Residential": 4.0}


# supply


WEATHER = "timestamp STRING, cloud_factor DOUBLE, wind_factor DOUBLE, precipitation_factor DOUBLE"
T1, T2 = "2024-06-01 01:00:00", "2024-06-01 02:00:00"


def test_weather_gap_and_duplicate(frame):
    output = frame([output_row(ts=t, mw=10.0 + i) for i, t in enumerate((T0, T1, T2))], OUTPUT)
    factors = frame([(T0, 1.0, 1.0, 1.1), (T1, 0.3, None, 1.0), (T1, 0.1, 0.7, 0.4)], WEATHER)
    enriched = supply.enrich_with_weather(output, factors)
    assert values(enriched, "output_mw", "cloud_factor", "wind_factor", "precipitation_factor") == [
        (10.0, 1.0, 1.0, 1.1),
        (11.0, 0.1, 0.7, 0.4),
        (11.0, 0.3, 0.5, 1.0),
        (12.0, 0.7, 0.5, 1.0),
    ]
    weighted = supply.weather_weighted(output, supply.weather_matches(factors))
    assert weighted.count() == 3
    for operator in (
        supply.supply_by_district,
        supply.supply_by_plant_type,
        supply.supply_by_district_hour,
        supply.capacity_utilization,
        supply.operating_costs,
    ):
        assert values(operator(weighted)) == values(operator(enriched))
    assert values(supply.supply_by_district(weighted)) == [("D1", 44.0)]


@pytest.mark.parametrize(("capacity", "rate"), [(0.0, 0.0), (-1.0, 0.0), (NAN, 0.0), (None, 0.0), (40.0, 0.25)])
def test_utilization_without_capacity(frame, capacity, rate):
    output = frame([output_row(capacity=capacity)], OUTPUT)
    assert supply.capacity_utilization(output).first()["utilization_rate"] == rate
    total = values(reports.supply_metrics(output))
    assert total == [("Coal", 10.0, rate), ("Total", 10.0, None)]


# carbon


@pytest.mark.parametrize(
    ("intensity", "status"),
    [
        (0.8, "CRITICAL"),
        (0.79, "WARNING"),
        (0.5, "WARNING"),
        (0.49, "OK"),
        (0.2, "GREEN"),
        (0.0, "GREEN"),
        (NAN, "OK"),
    ],
)
def test_emission_status(frame, intensity, status):
    assert evaluate(frame, emissions.emission_status, intensity) == status


def test_emission_factors_by_expression_and_by_join(spark, frame):
    kinds = ["nuclear", "coal", "gas", "hydro", "wind", "solar", "tidal", None]
    output = frame([output_row(k, 10.0) for k in kinds], OUTPUT)
    expected = dict(zip(kinds, [0.0, 10.0, 4.0, 0.0, 0.0, 0.0, 5.0, 5.0], strict=True))
    assert dict(values(carbon.emission_pairs(output))) == expected
    assert dict(values(carbon.emission_pairs_by_join(output, carbon.emission_factors(spark)))) == expected


def test_intensity(frame):
    emitted = frame([("a", 30.0), ("b", None)], "plant_type STRING, total_co2_tons DOUBLE")
    for supplied, expected in [([60.0, 40.0], 0.3), ([0.0], 0.0), ([-1.0], 0.0), ([None], 0.0), ([], 0.0)]:
        supplies = frame([(mw,) for mw in supplied], "total_supply_mw DOUBLE")
        assert carbon.emission_intensity(emitted, supplies).first()[0] == expected


def test_renewable_goals(frame):
    output = frame([output_row("wind", 20.0), output_row("solar", 20.0), output_row("nuclear", 60.0)], OUTPUT)
    row = carbon.renewable_share(output).first()
    assert (row["total_mw"], row["renewable_percentage"]) == (100.0, 40.0)
    assert (row["meets_target"], row["meets_minimum"]) == (True, True)
    assert values(reports.renewable_mix(output)) == [("Non-Renewable", 60.0, 60.0), ("Renewable", 40.0, 40.0)]


# histogram


def histogram(frame, scores, **options):
    df = frame([(z,) for z in scores], "zscore DOUBLE")
    return sorted(reports.zscore_histogram(df, **options).collect())


def test_histogram_clips_and_keeps_empty_bins(frame):
    rows = histogram(frame, [-9.0, -5.0, 0.0, 5.0, 9.0, None])
    assert len(rows) == 50
    assert {r["bin"]: r["count"] for r in rows if r["count"]} == {0: 2, 25: 1, 49: 2}
    assert (rows[0]["bin_lo"], rows[-1]["bin_hi"]) == (-5.0, 5.0)
    assert sum(r["count"] for r in rows) == 5


def test_histogram_of_a_flat_range(frame):
    rows = histogram(frame, [1.0, 1.0])
    assert (rows[0]["bin_lo"], rows[-1]["bin_hi"]) == (0.5, 1.5)
    assert {r["bin"]: r["count"] for r in rows if r["count"]} == {25: 2}


def test_histogram_without_scores(frame):
    rows = histogram(frame, [None])
    assert len(rows) == 50 and sum(r["count"] for r in rows) == 0
    assert (rows[0]["bin_lo"], rows[-1]["bin_hi"]) == (0.0, 1.0)


def test_histogram_equals_numpy(frame):
    np = pytest.importorskip("numpy")
    scores = np.concatenate([np.linspace(-3, 3, 601), np.random.default_rng(7).normal(0, 2, 2000)])
    counts, edges = np.histogram(np.clip(scores, -5, 5), bins=50)
    rows = histogram(frame, [float(z) for z in scores])
    assert [r["count"] for r in rows] == counts.tolist()
    assert [r["bin_lo"] for r in rows] == pytest.approx(edges[:-1].tolist())


# weather and load


@pytest.mark.parametrize(
    ("speed", "condition", "factor"),
    [
        (0.0, "calm", 0.0),
        (2.9, "calm", 0.0),
        (3.0, "light", 0.3),
        (6.0, "moderate", 0.7),
        (12.0, "strong", 1.0),
        (25.0, "strong", 1.0),
        (25.1, "extreme", 0.0),
        (None, None, None),
    ],
)
def test_wind_bands(frame, speed, condition, factor):
    row = weather.wind_bands(frame([(speed,)], "wind_speed_ms DOUBLE")).first()
    assert (row["wind_condition"], row["wind_factor"]) == (condition, factor)
    assert evaluate(frame, generation.wind_condition, NAN) is None


@pytest.mark.parametrize(
    ("hour", "expected"), [(5, 0.0), (6, math.exp(-36 / 32)), (12, 1.0), (19, math.exp(-49 / 32)), (20, 0.0)]
)
def test_solar_curve(frame, hour, expected):
    assert evaluate(frame, generation.solar_curve, hour, "int") == pytest.approx(expected)


def availability(frame, plant_type, factors=(1.0, 1.0, 1.0), ts="2024-06-01 12:00:00"):
    hours = frame([output_row(plant_type, ts=ts)], OUTPUT).drop("availability")
    conditions = frame([(ts, *factors)], WEATHER)
    return weather.plant_availability(hours, conditions).first()["availability"]


def test_availability_by_type(frame):
    assert availability(frame, "nuclear") == 0.92
    assert availability(frame, "solar", (0.7, 0.0, 0.0)) == 0.7
    assert availability(frame, "solar", (3.0, 0.0, 0.0)) == 1.0
    assert availability(frame, "wind", (0.0, 0.3, 0.0)) == pytest.approx(0.105)
    assert availability(frame, "hydro", (0.0, 0.0, 1.1)) == pytest.approx(0.968)
    assert availability(frame, "hydro", (0.0, 0.0, -1.0)) == 0.0
    assert availability(frame, "tidal") is None
    assert availability(frame, "wind", (1.0, None, 1.0)) == pytest.approx(0.35 * 0.5)


def test_expected_output(frame):
    plants = frame(
        [("P1", "coal", "D1", 100.0, 0.9, 40.0), ("P2", "gas", "D1", 100.0, 2.0, 50.0), ("P3", "x", "D1", 1.0, 1.0, 1.0)],
        "plant_id STRING, plant_type STRING, district_id STRING, capacity_mw DOUBLE, efficiency DOUBLE, "
        "operating_cost DOUBLE",
    )
    hours = weather.hourly_spine(plants, T0, hours=1)
    rows = values(
        weather.expected_output(hours, frame([], WEATHER)), "plant_id", "availability", "output_mw", "operating_cost"
    )
    assert rows == [("P1", 0.85, 76.5, 3060.0), ("P2", 0.9, 100.0, 5000.0), ("P3", None, None, None)]
    plant_output_columns = [column.split()[0] for column in schemas.PLANT_OUTPUT.split(", ")]
    assert sorted(weather.expected_output(hours, frame([], WEATHER)).columns) == sorted(plant_output_columns)


def test_unknown_conditions_have_no_factor(frame):
    conditions = frame(
        [(T0, "rainy", "strong", "flood"), (T1, "hail", None, "normal")],
        "timestamp STRING, cloud_condition STRING, wind_condition STRING, precipitation_condition STRING",
    )
    rows = values(weather.weather_factors(conditions), "cloud_factor", "wind_factor", "precipitation_factor")
    assert rows == [(0.05, 1.0, 0.8), (None, None, 1.0)]


@pytest.mark.parametrize(
    ("day", "factor"), [("2024-06-07", 0.6), ("2024-06-08", 0.6 * 0.5), ("2024-06-09", 0.6 * 0.5), ("2024-06-10", 0.6)]
)
def test_weekend_load(frame, day, factor):
    hours = frame([(f"{day} 06:00:00", "commercial"), (f"{day} 06:00:00", "unknown")], "timestamp STRING, meter_type STRING")
    assert values(weather.load_factors(hours), "meter_type", "load_factor") == [("commercial", factor), ("unknown", None)]


def test_expected_consumption_has_a_floor(frame):
    meters = frame(
        [("M1", "industrial", 25.0), ("M2", "residential", 0.0), ("M3", "unknown", 1.0)],
        "meter_id STRING, meter_type STRING, base_consumption DOUBLE",
    )
    rows = values(weather.expected_consumption(weather.hourly_spine(meters, "2024-06-03 07:00:00", 1)), "meter_id", "expected_kwh")
    assert rows == [("M1", 30.0), ("M2", 0.01), ("M3", None)]
    assert evaluate(frame, lambda x: load.expected_kwh(x, F.lit("residential"), F.lit(T0).cast("timestamp_ntz")), NAN) == 0.01


def test_spine_covers_the_period(frame):
    dims = frame([("a",), ("b",)], "id STRING")
    spine = weather.hourly_spine(dims, T0, hours=72, partitions=4)
    assert spine.count() == 144
    ends = spine.agg(F.min("timestamp").cast("string"), F.max("timestamp").cast("string")).first()
    assert tuple(ends) == (T0, "2024-06-03 23:00:00")
    assert values(weather.hourly_spine(dims, T0, hours=1), "id") == [("a",), ("b",)]
    with pytest.raises(ValueError, match="hour"):
        weather.hourly_spine(dims, T0, hours=0)


def test_condition_distribution_counts_all_hours(frame):
    rows = [("clear", "calm"), ("clear", "calm"), ("hail", "calm"), (None, "strong")]
    found = weather.condition_distribution(frame(rows, "cloud_condition STRING, wind_condition STRING"))
    by_name = {(r["kind"], r["condition"]): (r["hours"], r["pct"]) for r in found.collect()}
    assert len(by_name) == 10
    assert by_name["cloud", "clear"] == (2, 50.0)
    assert by_name["cloud", "rainy"] == (0, 0.0)
    assert by_name["wind", "calm"] == (3, 75.0)
    assert by_name["wind", "strong"] == (1, 25.0)


def test_clamp_keeps_null(frame):
    clamped = lambda x: common.clamp(x, 0.0, 1.0)
    assert [evaluate(frame, clamped, v) for v in (None, NAN, -1.0, 0.5, 2.0)] == [None, 0.0, 0.0, 0.5, 1.0]


@pytest.mark.parametrize(
    ("x", "digits", "expected"),
    [
        (0.406, 2, 0.41),
        (1.004, 2, 1.0),
        (-1.236, 2, -1.24),
        (0.0, 2, 0.0),
        (0.125, 2, 0.12),
        (-0.125, 2, -0.12),
        (-0.375, 2, -0.38),
        (-2.5, 0, -2.0),
        (123456789.126, 2, 123456789.13),
        (4.0e13, 6, 4.0e13),
        (-2.5e13, 6, -2.5e13),
        (9.3e18, 2, 9.3e18),
        (1e300, 6, 1e300),
        (1.7e308, 6, 1.7e308),
        (-1.7e308, 2, -1.7e308),
        (float(2**52 + 1), 6, float(2**52 + 1)),
        (float("inf"), 6, float("inf")),
        (float("-inf"), 2, float("-inf")),
        (None, 2, None),
    ],
)
def test_rounding(frame, x, digits, expected):
    rounding = lambda c: common.round_half_even(c, digits)
    assert evaluate(frame, rounding, x) == expected
    assert math.isnan(evaluate(frame, rounding, NAN))


def test_the_hour_comes_from_the_timestamp(frame):
    """A column that is called hour in the facts is not the hour of the day."""
    readings = frame([("2024-06-01 05:00:00", "D1", 1.0, 99)], "timestamp STRING, district_id STRING, kwh DOUBLE, hour INT")
    assert values(demand.demand_by_district_hour(readings), "hour") == [(5,)]


def test_generation_by_class(frame):
    rows = [("wind", 1.0), ("solar", 2.0), ("coal", 4.0), (None, 8.0), ("coal", None)]
    found = carbon.generation_by_class(frame(rows, "plant_type STRING, output_mw DOUBLE"))
    assert values(found) == [("non_renewable", 12.0), ("renewable", 3.0)]


def test_reporting_gaps(frame):
    rows = [("2024-06-01 05:00:00", "P1"), ("2024-06-01 05:30:00", "P1"), ("2024-06-01 09:00:00", "P1"), ("2024-06-01 10:00:00", "P1"),
            ("2024-06-01 05:00:00", "P2"), (None, "P2"), ("2024-06-02 05:00:00", None)]
    gaps = weather.reporting_gaps(frame(rows, "timestamp STRING, plant_id STRING"), "plant_id")
    assert [(r["id"], str(r["last_hour"]), str(r["next_hour"]), r["missing_hours"]) for r in gaps.collect()] == [
        ("P1", "2024-06-01 05:00:00", "2024-06-01 09:00:00", 3)
    ]


def test_spine_from_each_rows_own_start(frame):
    dims = frame([("2024-06-01 00:00:00", "a"), ("2024-07-01 00:00:00", "b")], "timestamp STRING, id STRING")
    dims = dims.withColumnRenamed("timestamp", "first")
    spine = weather.hourly_spine(dims, F.col("first"), hours=2)
    assert [(r["id"], str(r["timestamp"])) for r in sorted(spine.collect())] == [
        ("a", "2024-06-01 00:00:00"), ("a", "2024-06-01 01:00:00"), ("b", "2024-07-01 00:00:00"), ("b", "2024-07-01 01:00:00")
    ]


# empty input


def test_empty_input(frame):
    readings, output = frame([], READING), frame([], OUTPUT)
    totals = fraud.meter_totals(readings)
    stats = fraud.district_stats(totals)
    scores = fraud.meter_zscores(totals, stats)
    supplies = supply.supply_by_district(output)
    balances = balance.grid_balance(demand.demand_by_district(readings), supplies)
    for empty in (
        demand.demand_by_district_hour(readings),
        demand.peak_demand_districts(readings),
        supply.capacity_utilization(output),
        balances,
        stats,
        scores,
        carbon.emissions_by_hour(output),
        reports.demand_share(demand.demand_by_meter_type(readings)),
    ):
        assert empty.count() == 0
    assert tuple(fraud.fraud_impact(scores).first()) == (0, 0, 0.0, 0.0, 0.0)
    assert values(reports.demand_metrics(readings)) == [("Districts Monitored", 0.0), ("Total Demand", 0.0)]
    assert values(reports.supply_metrics(output)) == [("Total", 0.0, None)]
    assert tuple(balance.blackout_risk_summary(balances).first()) == (0, 0, 0, 0, 0, "", 0.0, 0)
    assert tuple(carbon.renewable_share(output).first()) == (0.0, 0.0, 0.0, 0.0, False, False)
    assert tuple(carbon.carbon_summary(output, supplies).first()) == (0.0, 0.0, "GREEN", 0.0, 0.0, 0.0, 0.0, False, False)


def test_ranked_reports(frame):
    districts = frame([("D2", 1.0), ("D1", 1.0), ("D3", 0.5)], "district_id STRING, total_demand_kwh DOUBLE")
    assert [r[0] for r in reports.demand_ranking(districts).collect()] == ["D3", "D1", "D2"]
    kinds = frame([("gas", 1.0), ("coal", 2.0)], "plant_type STRING, total_supply_mw DOUBLE")
    assert [r[0] for r in reports.supply_ranking(kinds).collect()] == ["coal", "gas"]
    hours = frame([(5, 1.0), (0, 2.0)], "hour INT, total_co2_tons DOUBLE")
    assert [r[0] for r in reports.emission_profile(hours).collect()] == [0, 5]
    shares = reports.emission_share(
        frame([("coal", 3.0), ("gas", 1.0), ("solar", 0.0)], "plant_type STRING, total_co2_tons DOUBLE")
    )
    assert values(shares) == [("coal", 3.0, 75.0), ("gas", 1.0, 25.0)]
