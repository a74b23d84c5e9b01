"""z-scores of meters within their district and what they suggest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattledger import constants as C
from wattledger.functions.common import is_positive


def zscore(value: Column, mean: Column, stddev: Column) -> Column:
    """Standard score; 0 in a district without spread (stddev 0 or NaN)."""
    return F.when(is_positive(stddev), (value - mean) / stddev).otherwise(F.lit(0.0))


def meter_status(
    z: Column, *, critical: float = C.Z_CRITICAL, warning: float = C.Z_WARNING, monitor: float = C.Z_MONITOR
) -> Column:
    size = F.abs(z)
    return (
        F.when(F.isnan(z), "NORMAL")
        .when(size >= critical, "FRAUD_LIKELY")
        .when(size >= warning, "SUSPICIOUS")
        .when(size >= monitor, "MONITOR")
        .otherwise("NORMAL")
    )


def fraud_type(z: Column, *, critical: float = C.Z_CRITICAL) -> Column:
    """Direction of the deviation; strict, so a score of exactly ``critical`` has none."""
    return (
        F.when(F.isnan(z), "NONE")
        .when(z < -critical, "UNDER_REPORTING")
        .when(z > critical, "OVER_REPORTING")
        .otherwise("NONE")
    )


def is_fraud_case(status: Column) -> Column:
    return status.isin(*C.FRAUD_STATUSES)


def stolen_kwh(total: Column, mean: Column, z: Column, kind: Column) -> Column:
    """Energy an under-reporting meter is estimated to hide: mean * (1 + |z| / 3) less what it reported."""
    hidden = mean * (1 + F.abs(z) / 3) - total
    return F.when((kind == "UNDER_REPORTING") & is_positive(hidden), hidden).otherwise(F.lit(0.0))
