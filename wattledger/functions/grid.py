"""Supply-demand balance of a district."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattledger import constants as C
from wattledger.functions.common import ratio_or


def demand_mwh(total_kwh: Column) -> Column:
    return total_kwh / F.lit(1000.0)


def balance_ratio(net_load: Column, supply: Column) -> Column:
    """Net load relative to supply; -1 where there is no positive supply."""
    return ratio_or(net_load, supply, -1.0)


def balance_status(
    ratio: Column,
    *,
    critical: float = C.BALANCE_CRITICAL,
    warning: float = C.BALANCE_WARNING,
    normal: tuple[float, float] = C.BALANCE_NORMAL,
    excess: float = C.BALANCE_EXCESS,
) -> Column:
    """Five bands. The gaps [warning, normal low) and (normal high, excess] are OK, and so is an undefined ratio."""
    return (
        F.when(F.isnan(ratio), "OK")
        .when(ratio < critical, "CRITICAL")
        .when(ratio < warning, "WARNING")
        .when(ratio.between(*normal), "NORMAL")
        .when(ratio > excess, "EXCESS")
        .otherwise("OK")
    )


def hourly_balance_status(
    ratio: Column, *, critical: float = C.BALANCE_CRITICAL, warning: float = C.BALANCE_WARNING
) -> Column:
    """Three bands: by the hour a surplus of any size is OK."""
    return (
        F.when(F.isnan(ratio), "OK")
        .when(ratio < critical, "CRITICAL")
        .when(ratio < warning, "WARNING")
        .otherwise("OK")
    )
