"""Expected consumption of a meter by hour and weekday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattledger import constants as C
from wattledger.functions.common import clamp, lookup, round_half_even

SATURDAY = 5


def hourly_shape(meter_type: Column, hour: Column) -> Column:
    """Entry of the 24-hour load shape; NULL for an unknown type."""
    shape = F
    for name, values in C.HOURLY_LOAD.items():
        shape = shape.when(meter_type == name, F.array(*[F.lit(v) for v in values])[hour])
    return shape.otherwise(F.lit(None).cast("double"))


def load_factor(meter_type: Column, timestamp: Column) -> Column:
    shape = hourly_shape(meter_type, F.hour(timestamp))
    weekend = F.weekday(timestamp) >= SATURDAY
    return F.when(weekend, shape * lookup(meter_type, C.WEEKEND_LOAD)).otherwise(shape)


def expected_kwh(base_consumption: Column, meter_type: Column, timestamp: Column) -> Column:
    kwh = clamp(base_consumption * load_factor(meter_type, timestamp), C.MIN_EXPECTED_KWH)
    return round_half_even(kwh, 4)
