"""Comparisons, ratios and lookups with explicit NULL and NaN rules.

Spark orders NaN above every number, so a bare ``x > 0`` is true for NaN. The guards here treat NaN as not comparable.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def is_positive(x: Column) -> Column:
    """x > 0, false for NaN and NULL for NULL."""
    return (x > 0) & ~F.isnan(x)


def ratio_or(numerator: Column, denominator: Column, fallback: float) -> Column:
    """numerator / denominator where the denominator is positive, else ``fallback``."""
    return F.when(is_positive(denominator), numerator / denominator).otherwise(F.lit(fallback))


def clamp(x: Column, low: Column | float, high: Column | float | None = None) -> Column:
    """x limited to [low, high]; NaN becomes ``low`` and NULL stays NULL (``greatest``/``least`` would skip it)."""
    low = low if isinstance(low, Column) else F.lit(low)
    limited = F.when(F.isnan(x) | (x < low), low)
    if high is not None:
        high = high if isinstance(high, Column) else F.lit(high)
        limited = limited.when(x > high, high)
    return limited.otherwise(x)


def round_half_even(x: Column, digits: int) -> Column:
    """x to ``digits`` decimals, halves to the even neighbour, in double arithmetic; NaN and infinities stay as they are.

    So do numbers from 2^52 on, which have no decimals; scaling them could overflow. ``F.round`` goes through a decimal object
    per value, which takes longer than all else a projection here does.
    """
    scale = F.lit(10.0**digits)
    return F.when(F.abs(x) < 2.0**52, F.rint(x * scale) / scale).otherwise(x)


def lookup(key: Column, table: Mapping[str, float], default: float | None = None) -> Column:
    """The value of ``key`` in a constant table; ``default`` (NULL if not given) for other and NULL keys."""
    fallback = F.lit(default).cast("double")
    if not table:
        return fallback
    cases = F
    for name, value in table.items():
        cases = cases.when(key == name, F.lit(float(value)))
    return cases.otherwise(fallback)


def hour_of(df: DataFrame) -> Column:
    """Hour of day, 0-23 with all days folded together.

    Facts have a ``timestamp``; a column that happens to be called ``hour`` in them means nothing here. Pre-aggregates
    have no ``timestamp`` and give the hour they were grouped by.
    """
    return (F.hour("timestamp") if "timestamp" in df.columns else F.col("hour")).alias("hour")


def literal_rows(spark: SparkSession, names: Sequence[str], rows: Sequence[Sequence]) -> DataFrame:
    """A small constant table, kept as literals of the plan so that its size is known to the optimizer."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
