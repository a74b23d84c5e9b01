"""CO2 emissions and renewable shares."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattledger import constants as C
from wattledger.functions.common import lookup


def co2_tons(
    plant_type: Column,
    output_mw: Column,
    *,
    factors: Mapping[str, float] = C.EMISSION_FACTORS,
    default: float = C.DEFAULT_EMISSION_FACTOR,
) -> Column:
    """Emissions of an hour at ``output_mw``; types without a factor (and NULL) use ``default``."""
    return output_mw * lookup(plant_type, factors, default)


def is_renewable(plant_type: Column) -> Column:
    """True for the renewable types and false for all others, NULL included."""
    return F.coalesce(plant_type.isin(*C.RENEWABLE_TYPES), F.lit(False))


def energy_class(plant_type: Column) -> Column:
    return F.when(is_renewable(plant_type), "renewable").otherwise("non_renewable")


def emission_status(
    intensity: Column,
    *,
    critical: float = C.INTENSITY_CRITICAL,
    warning: float = C.INTENSITY_WARNING,
    target: float = C.INTENSITY_TARGET,
) -> Column:
    return (
        F.when(F.isnan(intensity), "OK")
        .when(intensity >= critical, "CRITICAL")
        .when(intensity >= warning, "WARNING")
        .when(intensity <= target, "GREEN")
        .otherwise("OK")
    )
