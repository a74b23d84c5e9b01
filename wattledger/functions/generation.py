"""Weather conditions and what they leave of a plant's capacity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattledger import constants as C
from wattledger.functions.common import clamp, lookup


def cloud_factor(condition: Column) -> Column:
    return lookup(condition, C.CLOUD_FACTORS)


def wind_factor(condition: Column) -> Column:
    return lookup(condition, C.WIND_FACTORS)


def precipitation_factor(condition: Column) -> Column:
    return lookup(condition, C.PRECIPITATION_FACTORS)


def wind_condition(speed_ms: Column) -> Column:
    """Name of the wind band; NULL for NULL and NaN speeds."""
    return (
        F.when(speed_ms.isNull() | F.isnan(speed_ms), F.lit(None).cast("string"))
        .when(speed_ms < C.WIND_CALM_BELOW, "calm")
        .when(speed_ms < C.WIND_LIGHT_BELOW, "light")
        .when(speed_ms < C.WIND_MODERATE_BELOW, "moderate")
        .when(speed_ms <= C.WIND_STRONG_UP_TO, "strong")
        .otherwise("extreme")
    )


def solar_curve(hour: Column) -> Column:
    """Bell curve around noon, 0 outside daylight."""
    offset = (hour - C.SOLAR_PEAK_HOUR).cast("double")
    bell = F.exp(-(offset * offset) / F.lit(2.0 * C.SOLAR_SPREAD_HOURS**2))
    return F.when(hour.between(C.SOLAR_FIRST_HOUR, C.SOLAR_LAST_HOUR), bell).otherwise(F.lit(0.0))


def availability(plant_type: Column, hour: Column, cloud: Column, wind: Column, precipitation: Column) -> Column:
    """Share of capacity a plant can use in an hour, within [0, 1]; NULL for an unknown type."""
    left_by_weather = (
        F.when(plant_type == "wind", wind).when(plant_type == "hydro", precipitation).otherwise(F.lit(1.0))
    )
    share = F.when(plant_type == "solar", solar_curve(hour) * cloud).otherwise(
        lookup(plant_type, C.BASE_AVAILABILITY) * left_by_weather
    )
    return clamp(share, 0.0, 1.0)


def expected_output_mw(capacity: Column, available: Column, efficiency: Column) -> Column:
    return clamp(capacity * available * efficiency, 0.0, capacity)
