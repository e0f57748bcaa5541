"""Dimensions: location, date and disease, each derived from staging."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewatch.functions import (
    date_id, half_of, lookup, match_first, mmwr_period, quarter_of, season_of, short_name,
    surrogate_key, week_label,
)
from casewatch.operators import bounded_broadcast
from casewatch.reference_data import (
    DISEASE_CATEGORY_RULES, DISEASE_DEMOGRAPHIC_RULES, DISEASE_DETECTION_RULES,
    DISEASE_EXCLUDE_CONTAINS, DISEASE_GROUP_PREFIX_RULES, DISEASE_SEVERITY_RULES,
    DISEASE_STATUS_RULES, DISEASE_SUBTYPE_RULES, DIVISION_REGION, NO_HOLIDAY, STATE_ABBREVIATION,
    STATE_DIVISION,
)

DIM_LOCATION_COLUMNS = ["location_id", "state_name", "state_abbreviation", "region_name", "census_division"]
DIM_DATE_COLUMNS = ["date_id", "year", "week", "mmwr_period", "week_label", "quarter", "half_year",
                    "season", "is_holiday_week", "holiday_name"]
DIM_DISEASES_COLUMNS = ["disease_id", "disease_name_long", "disease_status", "target_demographic",
                        "disease_category", "severity_or_stage", "pathogen_subtype", "detection_method",
                        "disease_group", "disease_name_short"]

# Upper bound of dim_location rows: staging keeps only states of the lookup.
LOCATION_BOUND = len(STATE_DIVISION)


def dimension_bounds(stg: DataFrame) -> dict[str, int]:
    """Row-count upper bounds of the three dimensions of `stg`, from one aggregate.

    dim_location is bounded by the state lookup; dim_date has one row per
    distinct (year, week) pair (a struct, so pairs with a null part count
    too) and dim_diseases at most one per distinct name. One pass instead of
    counting each dimension.
    """
    r = stg.agg(F.count_distinct(F.struct("year", "week")).alias("d"),
                F.count_distinct("disease_name").alias("n")).first()
    return {"dim_location": LOCATION_BOUND, "dim_date": int(r["d"]), "dim_diseases": int(r["n"])}


# ---- location ---------------------------------------------------------------

def dim_location(stg: DataFrame, abbreviations: Mapping[str, str] = STATE_ABBREVIATION,
                 regions: Mapping[str, str] = DIVISION_REGION) -> DataFrame:
    base = stg.where(F.col("state_name").isNotNull()).select("state_name", "region_name").distinct()
    return base.select(
        surrogate_key("state_name").alias("location_id"),
        "state_name",
        lookup("state_name", abbreviations).alias("state_abbreviation"),
        "region_name",
        lookup("region_name", regions).alias("census_division"),
    )


# ---- date -------------------------------------------------------------------

def date_attributes(year: Column, week: Column) -> list[Column]:
    return [
        date_id(year, week).alias("date_id"),
        year.alias("year"),
        week.alias("week"),
        mmwr_period(year, week).alias("mmwr_period"),
        week_label(year, week).alias("week_label"),
        quarter_of(week).alias("quarter"),
        half_of(week).alias("half_year"),
        season_of(week).alias("season"),
    ]


def with_holidays(df: DataFrame, holidays: DataFrame, known_rows: int | None = None) -> DataFrame:
    """Left join the holiday seed on (year, week): flag plus name or N/A."""
    h = holidays.select(
        F.col("year").cast("long").alias("__h_year"),
        F.col("week").cast("long").alias("__h_week"),
        F.col("holiday_name").alias("__h_name"),
    )
    h = bounded_broadcast(h, known_rows=known_rows)
    joined = df.join(h, (F.col("year") == F.col("__h_year")) & (F.col("week") == F.col("__h_week")), "left")
    return joined.select(
        *[c for c in df.columns],
        F.col("__h_name").isNotNull().alias("is_holiday_week"),
        F.coalesce(F.col("__h_name"), F.lit(NO_HOLIDAY)).alias("holiday_name"),
    )


def dim_date(stg: DataFrame, holidays: DataFrame, holiday_rows: int | None = None) -> DataFrame:
    spine = stg.select(F.col("year").cast("long").alias("year"), F.col("week").cast("long").alias("week")).distinct()
    dated = spine.select(*date_attributes(F.col("year"), F.col("week")))
    return with_holidays(dated, holidays, holiday_rows).select(*DIM_DATE_COLUMNS)


# ---- diseases ---------------------------------------------------------------

def disease_attributes(name: Column) -> list[Column]:
    return [
        match_first(name, DISEASE_STATUS_RULES).alias("disease_status"),
        match_first(name, DISEASE_DEMOGRAPHIC_RULES).alias("target_demographic"),
        match_first(name, DISEASE_CATEGORY_RULES).alias("disease_category"),
        match_first(name, DISEASE_SEVERITY_RULES).alias("severity_or_stage"),
        match_first(name, DISEASE_SUBTYPE_RULES).alias("pathogen_subtype"),
        match_first(name, DISEASE_DETECTION_RULES).alias("detection_method"),
        match_first(name, DISEASE_GROUP_PREFIX_RULES, kind="prefix").alias("disease_group"),
        short_name(name).alias("disease_name_short"),
    ]


def has_disease_row(name: Column) -> Column:
    """True for names that get a disease-dimension row (null for a null name)."""
    return ~name.contains(DISEASE_EXCLUDE_CONTAINS)


def dim_diseases(stg: DataFrame) -> DataFrame:
    """Distinct names first (a small set), then the text parsing over those few rows."""
    names = stg.select("disease_name").distinct().where(has_disease_row(F.col("disease_name")))
    n = F.col("disease_name")
    return names.select(
        surrogate_key(n).alias("disease_id"),
        n.alias("disease_name_long"),
        *disease_attributes(n),
    )
