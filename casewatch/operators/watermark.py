"""High-water mark of the incremental load: read, fall back, compare, advance.

All comparisons use the integer stamp year*100 + week, never text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewatch.functions.calendar import week_stamp
from casewatch.reference_data import DEFAULT_START


def latest_watermark(wm: DataFrame) -> DataFrame:
    """The newest watermark row by loaded_at (ties: the larger stamp); no rows if empty."""
    top = wm.agg(F.max(F.struct("loaded_at", week_stamp("year", "week").alias("stamp"),
                                "year", "week")).alias("m"))
    return top.where(F.col("m").isNotNull()).select(
        F.col("m.year").cast("long").alias("year"),
        F.col("m.week").cast("long").alias("week"),
        F.col("m.loaded_at").alias("loaded_at"),
    )


def watermark_from_raw(raw: DataFrame, default: tuple[int, int] = DEFAULT_START) -> DataFrame:
    """(year, week) of the greatest stamp in a raw table, or `default` when there is none."""
    stamp = raw.agg(F.max(week_stamp("year", "week")).alias("stamp"))
    return stamp.select(
        F.coalesce(F.floor(F.col("stamp") / 100).cast("long"), F.lit(default[0]).cast("long")).alias("year"),
        F.coalesce((F.col("stamp") % 100).cast("long"), F.lit(default[1]).cast("long")).alias("week"),
    )


def has_newer(available: DataFrame, wm_year: int, wm_week: int) -> DataFrame:
    """One row: newest stamp available, the watermark stamp, and whether to run."""
    wm_stamp = wm_year * 100 + wm_week
    top = available.agg(F.max(week_stamp("year", "week")).alias("available_stamp"))
    return top.select(
        "available_stamp",
        F.lit(wm_stamp).cast("long").alias("watermark_stamp"),
        F.coalesce(F.col("available_stamp") > F.lit(wm_stamp), F.lit(False)).alias("has_newer"),
    )


def advance_watermark(batch: DataFrame, loaded_at: dt.datetime | Column | None = None) -> DataFrame:
    """The watermark row to append after a load: the composite maximum of the batch.

    Year and week come from the greatest stamp, not from independent maxima
    (which could combine one row's year with another row's week).
    """
    if isinstance(loaded_at, Column):
        ts = loaded_at
    else:
        ts = F.lit(loaded_at).cast("timestamp") if loaded_at is not None else F.current_timestamp()
    top = batch.agg(F.max(week_stamp("year", "week")).alias("stamp"))
    return top.where(F.col("stamp").isNotNull()).select(
        F.floor(F.col("stamp") / 100).cast("long").alias("year"),
        (F.col("stamp") % 100).cast("long").alias("week"),
        ts.alias("loaded_at"),
    )
