"""Staging: typed, normalised, filtered and deduplicated weekly rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.functions import lookup, mask, measure, norm_disease, trim_ws
from casewatch.operators import dedup_first
from casewatch.reference_data import STATE_DIVISION, TOTAL_SUFFIX_LIKE
from casewatch.schemas import FLAGS, GRAIN, MEASURES

# Total order inside a grain group: masked sort order first (nulls first),
# then the remaining columns, so ties on the sort order resolve the same way
# on every run.
STAGING_ORDER = [
    "sort_order_masked", "longitude_masked", "latitude_masked",
    *[name for _, name in MEASURES], *[name for _, name in FLAGS],
]


def state_name(c="states"):
    return F.upper(trim_ws(c))


def clean_weekly(raw: DataFrame, divisions: Mapping[str, str] = STATE_DIVISION) -> DataFrame:
    """Mask identifiers, normalise state and disease, type the time fields and measures."""
    coords = F.col("geocode_coordinates")
    return raw.select(
        mask("sort_order").alias("sort_order_masked"),
        mask(F.coalesce(F.get(coords, 0).cast("string"), F.lit(""))).alias("longitude_masked"),
        mask(F.coalesce(F.get(coords, 1).cast("string"), F.lit(""))).alias("latitude_masked"),
        state_name().alias("state_name"),
        lookup(state_name(), divisions).alias("region_name"),
        F.col("year").cast("long").alias("year"),
        F.col("week").cast("long").alias("week"),
        norm_disease("label").alias("disease_name"),
        *[measure(raw_c).alias(name) for raw_c, name in MEASURES],
        *[F.col(raw_c).alias(name) for raw_c, name in FLAGS],
    )


def with_region(df: DataFrame, divisions: Mapping[str, str] = STATE_DIVISION,
                state_col: str = "state_name") -> DataFrame:
    """Add `region_name` (the Census division) for a normalised state column; null when unknown."""
    return df.withColumn("region_name", lookup(state_col, divisions))


def keep_reportable(df: DataFrame) -> DataFrame:
    """Rows with a known division and a disease that is not a ', TOTAL' line (null names go too)."""
    return df.where(F.col("region_name").isNotNull() & ~F.col("disease_name").like(TOTAL_SUFFIX_LIKE))


def dedup_grain(df: DataFrame) -> DataFrame:
    """First row per (state, year, week, disease) by masked sort order."""
    return dedup_first(df, GRAIN, [F.col(c).asc_nulls_first() for c in STAGING_ORDER])


def reportable(raw: DataFrame, divisions: Mapping[str, str] = STATE_DIVISION) -> DataFrame:
    """Staging before the dedup: cleaned rows that survive the filters.

    The dedup keeps exactly one row of every grain group, so the set of
    distinct values of any grain column (state, division, year, week,
    disease) is the same here as in staging. Dimensions and their size
    bounds can be built from these rows: a projection of a few columns plus
    a partial aggregate, without the sort-based shuffle of the dedup.

    The null checks on the raw columns are implied by the filters (a null
    state has no division, a null label no disease name); written out they
    reach the Parquet reader as pushed filters.
    """
    present = raw.where(F.col("states").isNotNull() & F.col("label").isNotNull())
    return keep_reportable(clean_weekly(present, divisions))


def stage_weekly(raw: DataFrame, divisions: Mapping[str, str] = STATE_DIVISION) -> DataFrame:
    return dedup_grain(reportable(raw, divisions))
