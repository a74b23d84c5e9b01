"""Classification expressions against plain Python over random and special doubles, one Spark job each."""

from __future__ import annotations

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from wattledger.functions import anomaly, emissions, generation, grid

SPECIAL = [0.0, -0.0, 1.0, -1.0, math.inf, -math.inf, math.nan, 1e-300, 1e300]
THRESHOLDS = [-0.15, -0.05, 0.2, 0.3, 0.5, 0.8, 2.0, 2.5, 3.0, 6.0, 12.0, 25.0]


def doubles(count, seed, spread):
    rng = random.Random(seed)
    near = [f(t, math.inf) for t in THRESHOLDS for f in (math.nextafter, lambda x, _: math.nextafter(x, -math.inf))]
    return SPECIAL + THRESHOLDS + near + [rng.uniform(-spread, spread) for _ in range(count)]


def compare(spark, column, function, xs):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i INT, x DOUBLE")
    actual = dict(rows.select("i", column(F.col("x"))).collect())
    for i, x in enumerate(xs):
        assert actual[i] == function(x), x


def five_bands(ratio):
    if ratio < -0.15:
        return "CRITICAL"
    if ratio < -0.05:
        return "WARNING"
    if 0.0 <= ratio <= 0.20:
        return "NORMAL"
    return "EXCESS" if ratio > 0.30 else "OK"


def three_bands(ratio):
    return "CRITICAL" if ratio < -0.15 else "WARNING" if ratio < -0.05 else "OK"


def meter_status(z):
    size = abs(z)
    return "FRAUD_LIKELY" if size >= 3 else "SUSPICIOUS" if size >= 2.5 else "MONITOR" if size >= 2 else "NORMAL"


def fraud_type(z):
    return "UNDER_REPORTING" if z < -3 else "OVER_REPORTING" if z > 3 else "NONE"


def emission_status(x):
    return "CRITICAL" if x >= 0.8 else "WARNING" if x >= 0.5 else "GREEN" if x <= 0.2 else "OK"


def wind_band(x):
    if math.isnan(x):
        return None
    return "calm" if x < 3 else "light" if x < 6 else "moderate" if x < 12 else "strong" if x <= 25 else "extreme"


@pytest.mark.parametrize(
    ("column", "function", "xs"),
    [
        (grid.balance_status, five_bands, doubles(3000, 1, 0.5)),
        (grid.hourly_balance_status, three_bands, doubles(3000, 2, 0.5)),
        (anomaly.meter_status, meter_status, doubles(3000, 3, 4)),
        (anomaly.fraud_type, fraud_type, doubles(3000, 4, 4)),
        (emissions.emission_status, emission_status, doubles(3000, 5, 1)),
        (generation.wind_condition, wind_band, doubles(3000, 6, 40)),
    ],
)
def test_bands(spark, column, function, xs):
    compare(spark, column, function, xs)


def test_ratio_of_all_pairs(spark):
    values = doubles(20, 7, 100)
    pairs = list(itertools.product(values, values))
    df = spark.createDataFrame([(i, n, s) for i, (n, s) in enumerate(pairs)], "i INT, net DOUBLE, supply DOUBLE")
    actual = dict(df.select("i", grid.balance_ratio(F.col("net"), F.col("supply"))).collect())
    for i, (net, supply) in enumerate(pairs):
        expected = net / supply if supply > 0 else -1.0
        assert actual[i] == expected or (math.isnan(actual[i]) and math.isnan(expected)), (net, supply)


def test_zscore_of_all_triples(spark):
    values = [*SPECIAL, 2.0, 30.0]
    triples = list(itertools.product(values, repeat=3))
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(triples)], "i INT, x DOUBLE, m DOUBLE, s DOUBLE")
    actual = dict(df.select("i", anomaly.zscore(F.col("x"), F.col("m"), F.col("s"))).collect())
    for i, (x, mean, stddev) in enumerate(triples):
        expected = (x - mean) / stddev if stddev > 0 else 0.0
        assert actual[i] == expected or (math.isnan(actual[i]) and math.isnan(expected)), (x, mean, stddev)
