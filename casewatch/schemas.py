"""Declared schemas. Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()

RAW_COLUMNS = [
    "states", "year", "week", "label", "m1", "m2", "m3", "m4",
    "m1_flag", "m2_flag", "m3_flag", "m4_flag", "sort_order", "geocode_coordinates",
]

# Raw weekly records: everything is text except the coordinate pair.
RAW = T.StructType(
    [T.StructField(c, _S, True) for c in RAW_COLUMNS[:-1]]
    + [T.StructField("geocode_coordinates", T.ArrayType(T.DoubleType(), True), True)]
)

# Landed JSON before flattening: the coordinates sit inside a nested object.
LANDED = T.StructType(
    [T.StructField(c, _S, True) for c in RAW_COLUMNS[:-1]]
    + [T.StructField("geocode", T.StructType([
        T.StructField("type", _S, True),
        T.StructField("coordinates", T.ArrayType(T.DoubleType(), True), True),
    ]), True)]
)

WATERMARK = T.StructType([
    T.StructField("year", T.LongType(), True),
    T.StructField("week", T.LongType(), True),
    T.StructField("loaded_at", T.TimestampType(), True),
])

DISEASE_LIST = T.StructType([T.StructField("disease_name", _S, True)])

US_HOLIDAYS = T.StructType([
    T.StructField("year", T.LongType(), True),
    T.StructField("week", T.LongType(), True),
    T.StructField("holiday_name", _S, True),
])

POPULATION = T.StructType([
    T.StructField("state_name", _S, True),
    T.StructField("year", T.LongType(), True),
    T.StructField("population", T.LongType(), True),
])

STAGING_COLUMNS = [
    "sort_order_masked", "longitude_masked", "latitude_masked", "state_name", "region_name",
    "year", "week", "disease_name", "current_week_cases", "previous_52_weeks_max",
    "cumulative_ytd_cases", "previous_year_cumulative", "current_week_cases_flag",
    "previous_52_weeks_max_flag", "cumulative_ytd_cases_flag", "previous_year_cumulative_flag",
]

MEASURES = [
    ("m1", "current_week_cases"),
    ("m2", "previous_52_weeks_max"),
    ("m3", "cumulative_ytd_cases"),
    ("m4", "previous_year_cumulative"),
]
FLAGS = [(f"{raw}_flag", f"{name}_flag") for raw, name in MEASURES]

GRAIN = ["state_name", "year", "week", "disease_name"]
