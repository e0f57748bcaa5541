"""Week-based calendar attributes (year and week are integers, never dates)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewatch.reference_data import HALF_BANDS, QUARTER_BANDS, SEASON_BANDS, SEASON_OTHERWISE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _bands(week: Column, bands, otherwise=None) -> Column:
    out = None
    for lo, hi, label in bands:
        cond = week.between(lo, hi)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(otherwise) if otherwise is not None else out


def quarter_of(week: Column | str) -> Column:
    return _bands(_col(week), QUARTER_BANDS)


def half_of(week: Column | str) -> Column:
    return _bands(_col(week), HALF_BANDS)


def season_of(week: Column | str) -> Column:
    return _bands(_col(week), SEASON_BANDS, SEASON_OTHERWISE)


def _week2(week: Column) -> Column:
    return F.lpad(week.cast("string"), 2, "0")


def date_id(year: Column | str, week: Column | str) -> Column:
    """YYYYWW as a long, built from the padded text exactly as the key is defined."""
    return F.concat(_col(year).cast("string"), _week2(_col(week))).cast("long")


def mmwr_period(year: Column | str, week: Column | str) -> Column:
    return F.concat(_col(year).cast("string"), F.lit("-W"), _week2(_col(week)))


def week_label(year: Column | str, week: Column | str) -> Column:
    return F.concat(F.lit("Week "), _col(week).cast("string"), F.lit(", "), _col(year).cast("string"))


def week_stamp(year: Column | str, week: Column | str) -> Column:
    """Composite integer stamp year*100 + week, for ordering and comparison."""
    return _col(year).cast("long") * 100 + _col(week).cast("long")


def sunday_week_of(d: Column | str) -> Column:
    """Week of the year counted from Sundays, 0-53 (days before the first Sunday are week 0).

    dayofweek is 1 for Sunday ... 7 for Saturday.
    """
    d = _col(d)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("long")
