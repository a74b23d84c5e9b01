"""Declared schemas of the input tables, as DDL. Every column is nullable.

Timestamps are wall-clock times without a zone, so the hour of a reading does not depend on the session's time zone.
"""

METER_READINGS = (
    "timestamp TIMESTAMP_NTZ, meter_id STRING, district_id STRING, meter_type STRING, "
    "kwh DOUBLE, voltage DOUBLE, power_factor DOUBLE"
)
PLANT_OUTPUT = (
    "timestamp TIMESTAMP_NTZ, plant_id STRING, plant_type STRING, district_id STRING, "
    "capacity_mw DOUBLE, output_mw DOUBLE, availability DOUBLE, operating_cost DOUBLE"
)
WEATHER = (
    "timestamp TIMESTAMP_NTZ, cloud_condition STRING, wind_condition STRING, precipitation_condition STRING, "
    "cloud_factor DOUBLE, wind_factor DOUBLE, precipitation_factor DOUBLE, "
    "temperature_c DOUBLE, wind_speed_ms DOUBLE, humidity_pct DOUBLE"
)
DISTRICTS = (
    "district_id STRING, district_name STRING, district_type STRING, base_demand_factor DOUBLE, "
    "peak_shift INT, num_meters INT"
)
METERS = (
    "meter_id STRING, district_id STRING, meter_type STRING, base_consumption DOUBLE, is_fraud BOOLEAN, address STRING"
)
PLANTS = (
    "plant_id STRING, plant_name STRING, plant_type STRING, district_id STRING, capacity_mw DOUBLE, "
    "efficiency DOUBLE, operating_cost DOUBLE, latitude DOUBLE, longitude DOUBLE"
)

TABLES = {
    "meter_readings": METER_READINGS,
    "plant_output": PLANT_OUTPUT,
    "weather": WEATHER,
    "districts": DISTRICTS,
    "meters": METERS,
    "plants": PLANTS,
}
