"""Ordered-window measures: previous-row change and running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def period_change(df: DataFrame, value: str, partition: Sequence[str | Column], order: Sequence[str | Column],
                  previous: str = "previous_value", change: str = "change",
                  pct: str = "pct_change") -> DataFrame:
    """Previous row's value (0 for the first row), the change, and the change in percent.

    The previous value is computed once and reused. The percentage is
    round(change / previous * 100, 2), 0 when the previous value is 0.
    The previous row is the previous row of the ordered partition, not
    necessarily the previous calendar period.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    prev = F.coalesce(F.lag(value, 1).over(w), F.lit(0.0))
    return with_change(df.withColumn(previous, prev), value, previous, change, pct)


def with_change(df: DataFrame, value: str, previous: str, change: str = "change", pct: str = "pct_change") -> DataFrame:
    """The change from the column `previous` to `value`, and the change in percent."""
    out = df.withColumn(change, F.coalesce(F.col(value) - F.col(previous), F.lit(0.0)))
    ratio = F.try_divide(F.col(change), F.nullif(F.col(previous), F.lit(0.0)))
    return out.withColumn(pct, F.coalesce(F.round(ratio * 100, 2), F.lit(0.0)))


def running_total(df: DataFrame, value: str, partition: Sequence[str | Column], order: Sequence[str | Column],
                  name: str = "running_total") -> DataFrame:
    """Sum of `value` from the first row of the partition up to the current row."""
    w = (Window.partitionBy(*partition).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(name, F.sum(value).over(w))
