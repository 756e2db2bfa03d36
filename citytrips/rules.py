"""Fixed values that results must carry exactly.

Every label, threshold and word list used by the dimension, fact, metric and
quality code is stated here once. The modules hold the logic, this one the data.
"""

from __future__ import annotations

from typing import NamedTuple


class Bands(NamedTuple):
    """``labels[i]`` applies below ``edges[i]``; the last label to all the rest, nulls included."""

    edges: tuple
    labels: tuple


# --- fixed values: modes --------------------------------------------------
YELLOW, FHV, BIKE = "yellow_taxi", "fhv", "citibike"
MODES = (YELLOW, FHV, BIKE)
RIDEABLE_TYPES = ("classic_bike", "electric_bike", "docked_bike")
RIDER_TYPES = ("member", "casual")

# --- fixed values: placeholder for a null part of a surrogate key ----------
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"

# --- fixed values: weather bands -------------------------------------------
TEMPERATURE = Bands((0, 10, 20, 30), ("cold", "cool", "mild", "warm", "hot"))
FEELS_LIKE = Bands((0, 10, 20, 30), ("very_cold", "cold", "comfortable", "warm", "hot"))
INTENSITY = Bands((2.5, 7.6, 50), ("light", "moderate", "heavy", "extreme"))
WIND = Bands((5, 10, 15, 20), ("calm", "breezy", "windy", "very_windy", "strong"))
CLOUD = Bands((25, 50, 75), ("clear", "partly_cloudy", "mostly_cloudy", "overcast"))
HUMIDITY = Bands((30, 60, 80), ("dry", "comfortable", "humid", "very_humid"))
PRECIPITATION_TYPES = ("none", "rain", "snow", "mixed")
INTENSITIES = ("none", "light", "moderate", "heavy", "extreme")
COMPASS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")
COMPASS_UNKNOWN = "VARIABLE"
MPH_PER_MS = 2.237

# --- fixed values: hours of the day (inclusive ranges) ----------------------
DAY_PARTS = {"morning": (6, 11), "afternoon": (12, 17), "evening": (18, 21)}
DAY_PART_REST = "night"
DAY_PART_NAMES = ("morning", "afternoon", "evening", "night")
BUSINESS_HOURS = ((9, 17),)
RUSH_HOURS = ((7, 9), (17, 19))
LATE_NIGHT_HOURS = ((23, 23), (0, 4))
DINING_HOURS = ((12, 14), (18, 21))
TIME_PERIODS = {
    "overnight": (0, 5),
    "early_morning": (6, 8),
    "late_morning": (9, 11),
    "early_afternoon": (12, 14),
    "late_afternoon": (15, 17),
    "early_evening": (18, 20),
    "late_evening": (21, 22),
}
TIME_PERIOD_REST = "late_night"

# --- fixed values: zones -----------------------------------------------------
LOCATION_TIERS = {
    "core": ("Manhattan",),
    "urban": ("Brooklyn", "Queens"),
    "outer": ("Bronx", "Staten Island"),
    "airport": ("EWR",),
}
LOCATION_TIER_REST = "unknown"
BOROUGH_REGIONS = {
    "Manhattan": ("Manhattan",),
    "Western_Boroughs": ("Brooklyn", "Queens"),
    "Outer_Boroughs": ("Bronx", "Staten Island"),
    "Airport": ("EWR",),
}
BOROUGH_REGION_REST = "Other"
HIGH_DEMAND_ZONES = (
    "Midtown Center", "Midtown East", "Midtown North", "Midtown South",
    "Times Sq/Theatre District", "Penn Station/Madison Sq West",
    "Financial District North", "Financial District South",
    "Upper East Side North", "Upper East Side South",
    "Upper West Side North", "Upper West Side South",
)
HUB_ZONES = (
    "JFK Airport", "LaGuardia Airport", "Newark Airport",
    "Penn Station/Madison Sq West", "Grand Central",
)
TOURIST_ZONES = (
    "Times Sq/Theatre District", "Central Park", "SoHo",
    "Greenwich Village North", "Greenwich Village South",
    "East Village", "West Village", "Chinatown", "Little Italy/NoLiTa",
)
BUSINESS_ZONES = (
    "Financial District North", "Financial District South",
    "Midtown Center", "Midtown East", "Midtown North", "Midtown South",
)

# --- fixed values: report labels and limits ----------------------------------
RAIN_LEVELS = Bands((0.1, 0.3), ("Light", "Moderate", "Heavy"))
RAIN_LEVEL_DRY = "No Rain"
TEMPERATURE_RANGES = Bands(
    (5, 15, 25), ("Cold (<5°C)", "Cool (5-15°C)", "Mild (15-25°C)", "Warm (>25°C)")
)
MONTH_MINIMUM = 100_000
DAY_MINIMUM = 10_000
GAP_DAYS = 3
COVERAGE_MINIMUM = 99.99
COVERAGE_GRADES = ((99.99, "Excellent"), (99.0, "Good"), (95.0, "Fair"))
COVERAGE_GRADE_REST = "Poor"
MONTH_WEATHER_MINIMUM = 99.0
MONTH_DAYS_MINIMUM = 28
PARTIAL_MONTH_SHARE = 0.3
MISSING_MONTH_SHARE = 0.43
LOW_MONTH_MESSAGE = "Month has suspiciously low trip count - check for backfill issues"
GAP_MESSAGE = "Large date gap detected - possible backfill failure or data ingestion issue"
FILE_DEVIATION_PCT = 30.0
FILE_SMALL_MB = 50.0
SPINE_START, SPINE_END = "2025-09-01", "2026-01-01"
MIN_PICKUP = "2025-01-01"
