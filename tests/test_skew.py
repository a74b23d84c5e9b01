"""Hot keys: a third of all readings in one meter and district, a third of plant output and weather in one hour.

The complete run is compared with plain Python over the same rows.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest

from tests.conftest import values
from wattledger import constants as C
from wattledger.operators import fraud
from wattledger.plans import cubes
from wattledger.plans.full_run import OUTPUTS, analyze, save
from wattledger.plans.report_frames import chart_frames, dashboard_frames
from wattledger.sources.readers import read_csv

START = datetime(2024, 6, 1)
KINDS = ["nuclear", "coal", "gas", "hydro", "wind", "solar", "tidal"]


def hour(i):
    return str(START + timedelta(hours=i))


@pytest.fixture(scope="module")
def rows():
    readings, output, weather = [], [], []
    for i in range(9000):
        hot = i % 3 == 0
        district = "D0" if hot else f"D{i % 7}"
        meter = "hot" if i % 6 == 0 else f"{district}-M{i % 211}"
        kwh = 1.0 + (i * 37 % 101) / 4
        readings.append((hour(i % 60), meter, district, ["residential", "commercial"][i % 2], kwh, 240.0, 0.9))
    for i in range(3000):
        ts = hour(0) if i % 3 == 0 else hour(i % 50)
        mw = (i * 53 % 97) / 8
        output.append((ts, f"P{i % 9}", KINDS[i % 7], f"D{i % 5}", 12.0, mw, 0.5, mw * 3))
    for i in range(45):
        weather.append((hour(0) if i % 3 == 0 else hour(i), 0.7, 0.3, 1.0))
    return readings, output, weather


@pytest.fixture(scope="module")
def frames(spark, rows):
    from wattledger import schemas

    readings, output, weather = rows

    def build(data, ddl):
        df = spark.createDataFrame(data, ddl.replace("TIMESTAMP_NTZ", "STRING"))
        return df.withColumn("timestamp", df["timestamp"].cast("timestamp_ntz")).repartition(8)

    return (
        build(readings, schemas.METER_READINGS),
        build(output, schemas.PLANT_OUTPUT),
        build(weather, "timestamp STRING, cloud_factor DOUBLE, wind_factor DOUBLE, precipitation_factor DOUBLE"),
    )


@pytest.fixture(scope="module")
def results(frames):
    return analyze(*frames)


def hour_of(ts):
    return int(ts[11:13])


def sums(pairs):
    out = defaultdict(float)
    for key, value in pairs:
        out[key] += value
    return dict(out)


def keyed(df, keys, value):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r[value] for r in df.collect()}


def assert_close(actual, expected):
    assert actual.keys() == expected.keys()
    for key, value in expected.items():
        assert actual[key] == pytest.approx(value), key


def test_demand(results, rows):
    readings = rows[0]
    assert_close(keyed(results["total_demand"], ["district_id"], "total_demand_kwh"), sums((r[2], r[4]) for r in readings))
    assert_close(keyed(results["type_demand"], ["meter_type"], "total_demand_kwh"), sums((r[3], r[4]) for r in readings))
    assert_close(
        keyed(results["hourly_demand"], ["district_id", "hour"], "total_demand_kwh"),
        sums(((r[2], hour_of(r[0])), r[4]) for r in readings),
    )


def test_supply_counts_every_weather_match(results, rows):
    _, output, weather = rows
    matches = Counter(w[0] for w in weather)
    copies = [(o, max(1, matches[o[0]])) for o in output]
    assert max(n for _, n in copies) == 15
    assert_close(
        keyed(results["total_supply"], ["district_id"], "total_supply_mw"), sums((o[3], o[5] * n) for o, n in copies)
    )
    assert_close(
        keyed(results["hourly_supply"], ["district_id", "hour"], "total_supply_mw"),
        sums(((o[3], hour_of(o[0])), o[5] * n) for o, n in copies),
    )
    assert_close(
        keyed(results["costs"], ["plant_type"], "total_operating_cost"), sums((o[2], o[7] * n) for o, n in copies)
    )
    mw, capacity = sums((o[2], o[5] * n) for o, n in copies), sums((o[2], o[4] * n) for o, n in copies)
    assert_close(
        keyed(results["utilization"], ["plant_type"], "utilization_rate"), {k: mw[k] / capacity[k] for k in mw}
    )


def test_emissions_ignore_weather_matches(results, rows):
    output = rows[1]
    tons = [(o, o[5] * C.EMISSION_FACTORS.get(o[2], 0.5)) for o in output]
    assert_close(keyed(results["emissions_by_type"], ["plant_type"], "total_co2_tons"), sums((o[2], t) for o, t in tons))
    assert_close(
        keyed(results["emissions_by_district"], ["district_id"], "total_co2_tons"), sums((o[3], t) for o, t in tons)
    )
    assert_close(
        keyed(results["emissions_hourly"], ["hour"], "total_co2_tons"), sums((hour_of(o[0]), t) for o, t in tons)
    )
    summary = results["carbon_summary"].first()
    supplied = sum(r["total_supply_mw"] for r in results["total_supply"].collect())
    assert summary["emission_intensity"] == pytest.approx(sum(t for _, t in tons) / supplied)
    green = sum(o[5] for o in output if o[2] in C.RENEWABLE_TYPES)
    assert results["renewable_share"].first()["renewable_mw"] == pytest.approx(green)


def test_zscores(results, rows):
    readings = rows[0]
    totals = sums((r[1], r[4]) for r in readings)
    home = {}
    for r in readings:
        home[r[1]] = min(home.get(r[1], r[2]), r[2])
    by_district = defaultdict(list)
    for meter, kwh in totals.items():
        by_district[home[meter]].append(kwh)
    expected = {}
    for meter, kwh in totals.items():
        group = by_district[home[meter]]
        if len(group) >= 30:
            mean = sum(group) / len(group)
            spread = math.sqrt(sum((x - mean) ** 2 for x in group) / len(group))
            expected[meter] = (kwh - mean) / spread
    assert expected["hot"] > 3
    assert_close(keyed(results["meter_zscores"], ["meter_id"], "zscore"), expected)
    cases = {r["meter_id"] for r in results["fraud_cases"].collect()}
    assert cases == {m for m, z in expected.items() if abs(z) >= 2.5}


def test_balance(results):
    demands = keyed(results["total_demand"], ["district_id"], "total_demand_kwh")
    supplies = keyed(results["total_supply"], ["district_id"], "total_supply_mw")
    expected = {d: supplies[d] - demands[d] / 1000 for d in demands.keys() & supplies.keys()}
    assert_close(keyed(results["grid_balance"], ["district_id"], "net_load_mw"), expected)
    assert results["blackout_risk"].first()["total_deficit_mw"] == pytest.approx(
        sum(min(0.0, net) for net in expected.values())
    )


def test_cubes_stay_small(frames):
    demand_cube = cubes.demand_cube(frames[0])
    assert demand_cube.count() <= 7 * 2 * 24


def test_rollup_is_the_cube_and_the_meter_sums(frame):
    """Missing keys are groups of their own, not confused with keys a grouping leaves out."""
    rows = [
        (hour(0), "M1", "D1", "residential", 1.0),
        (hour(24), "M1", "D1", "residential", 2.0),
        (hour(1), "M1", None, None, 4.0),
        (None, None, "D2", "commercial", 8.0),
    ]
    readings = frame(rows, "timestamp STRING, meter_id STRING, district_id STRING, meter_type STRING, kwh DOUBLE")
    rollup = cubes.readings_rollup(readings)
    assert values(cubes.demand_view(rollup)) == values(cubes.demand_cube(readings))
    assert values(cubes.meter_view(rollup)) == values(fraud.meter_district_sums(readings))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_saved_results(spark, results, tmp_path, fmt):
    save(results, str(tmp_path), fmt, single_files=True)
    assert len(OUTPUTS) == 16
    for name, output in OUTPUTS.items():
        path = tmp_path / output.folder / name
        reader = spark.read.schema(results[name].schema)
        saved = reader.parquet(str(path)) if fmt == "parquet" else read_csv(spark, str(path), results[name].schema)
        assert len(saved.columns) == len(results[name].columns)
        assert saved.count() == results[name].count(), name
        if output.order and fmt == "csv":
            assert len(list(path.glob("part-*.csv"))) == 1
            keys = [tuple(r[c] for c in output.order) for r in saved.collect()]
            assert keys == sorted(keys), name


def test_report_frames_agree_with_the_results(results):
    charts, panels = chart_frames(results), dashboard_frames(results)
    meters = results["meter_zscores"].count()
    assert len(charts) == 10 and len(panels) == 6
    for name in ("zscore_distribution", "meter_status"):
        assert sum(r["count"] for r in charts[name].collect()) == meters
    metrics = {r["metric"]: r["value"] for r in panels["demand"].collect()}
    demands = keyed(results["total_demand"], ["district_id"], "total_demand_kwh")
    assert metrics["Total Demand"] == pytest.approx(sum(demands.values()))
    assert metrics["Districts Monitored"] == len(demands)
    supply_rows = {r["plant_type"]: r["total_output_mw"] for r in panels["supply"].collect()}
    supplies = keyed(results["type_supply"], ["plant_type"], "total_supply_mw")
    assert supply_rows["Total"] == pytest.approx(sum(supplies.values()))
    mix = {r["source"]: r["mw"] for r in charts["renewable_mix"].collect()}
    assert mix["Renewable"] == pytest.approx(results["renewable_share"].first()["renewable_mw"])
    for frame in (*charts.values(), *panels.values()):
        frame.collect()
