"""Lookup tables, thresholds and parameters the results depend on."""

# --- fixed values: generation -------------------------------------------------

# tons of CO2 per MWh; a type missing here counts with DEFAULT_EMISSION_FACTOR
EMISSION_FACTORS = {
    "nuclear": 0.0,
    "coal": 1.0,
    "gas": 0.4,
    "hydro": 0.0,
    "wind": 0.0,
    "solar": 0.0,
}
DEFAULT_EMISSION_FACTOR = 0.5

# $ per MWh
OPERATING_COSTS = {
    "nuclear": 30.0,
    "coal": 40.0,
    "gas": 50.0,
    "hydro": 10.0,
    "wind": 5.0,
    "solar": 3.0,
}

RENEWABLE_TYPES = ("solar", "wind", "hydro")

# share of capacity available before weather; solar follows the daylight curve instead
BASE_AVAILABILITY = {
    "nuclear": 0.92,
    "coal": 0.85,
    "gas": 0.90,
    "hydro": 0.88,
    "wind": 0.35,
}
SOLAR_FIRST_HOUR = 6
SOLAR_LAST_HOUR = 19
SOLAR_PEAK_HOUR = 12
SOLAR_SPREAD_HOURS = 4

# --- fixed values: weather ----------------------------------------------------

CLOUD_FACTORS = {"clear": 1.0, "partly_cloudy": 0.7, "cloudy": 0.3, "overcast": 0.1, "rainy": 0.05}
WIND_FACTORS = {"calm": 0.0, "light": 0.3, "moderate": 0.7, "strong": 1.0, "extreme": 0.0}
PRECIPITATION_FACTORS = {"drought": 0.4, "low": 0.7, "normal": 1.0, "high": 1.1, "flood": 0.8}

# upper wind speed in m/s of each band, exclusive except for "strong"; faster is "extreme"
WIND_CALM_BELOW = 3.0
WIND_LIGHT_BELOW = 6.0
WIND_MODERATE_BELOW = 12.0
WIND_STRONG_UP_TO = 25.0

# factors of an hour without weather
MISSING_WEATHER = {"cloud_factor": 0.7, "wind_factor": 0.5, "precipitation_factor": 1.0}

# --- fixed values: load -------------------------------------------------------

# demand relative to the base consumption, hours 0 to 23
HOURLY_LOAD = {
    "residential": [
        0.4, 0.3, 0.3, 0.3, 0.4, 0.6, 0.9, 1.2, 1.0, 0.7, 0.6, 0.7,
        0.8, 0.7, 0.7, 0.8, 1.0, 1.4, 1.6, 1.5, 1.3, 1.0, 0.7, 0.5,
    ],
    "commercial": [
        0.3, 0.3, 0.3, 0.3, 0.3, 0.4, 0.6, 0.9, 1.3, 1.5, 1.5, 1.4,
        1.3, 1.4, 1.5, 1.5, 1.4, 1.2, 0.8, 0.5, 0.4, 0.3, 0.3, 0.3,
    ],
    "industrial": [
        0.8, 0.8, 0.8, 0.8, 0.8, 0.9, 1.0, 1.2, 1.3, 1.3, 1.3, 1.2,
        1.1, 1.2, 1.3, 1.3, 1.2, 1.1, 1.0, 0.9, 0.9, 0.8, 0.8, 0.8,
    ],
}
WEEKEND_LOAD = {"residential": 1.1, "commercial": 0.5, "industrial": 0.7}
MIN_EXPECTED_KWH = 0.01

# --- fixed values: thresholds -------------------------------------------------

# (supply - demand) / supply
BALANCE_CRITICAL = -0.15
BALANCE_WARNING = -0.05
BALANCE_NORMAL = (0.0, 0.20)
BALANCE_EXCESS = 0.30
BALANCE_STATUSES = ("CRITICAL", "WARNING", "NORMAL", "OK", "EXCESS")

Z_CRITICAL = 3.0
Z_WARNING = 2.5
Z_MONITOR = 2.0
MIN_METERS_PER_DISTRICT = 30
FRAUD_STATUSES = ("FRAUD_LIKELY", "SUSPICIOUS")

# tons of CO2 per MWh
INTENSITY_CRITICAL = 0.8
INTENSITY_WARNING = 0.5
INTENSITY_TARGET = 0.2

RENEWABLE_TARGET_PCT = 40.0
RENEWABLE_MINIMUM_PCT = 20.0

PRICE_PER_KWH = 0.12

# hours of the default planning period: three days
DEFAULT_HOURS = 72
