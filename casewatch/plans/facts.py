"""Fact table at the (state, disease, year, week) grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.functions import date_id, surrogate_key, trim_ws
from casewatch.operators import bounded_broadcast
from casewatch.plans.dims import has_disease_row
from casewatch.schemas import FLAGS, MEASURES

FACT_COLUMNS = [
    "fact_id", "location_id", "disease_id", "date_id",
    *[name for _, name in MEASURES], *[name for _, name in FLAGS],
]


def _fact_key():
    return surrogate_key("state_name", "disease_name", "year", "week").alias("fact_id")


def _measures_and_flags():
    return [F.col(name) for _, name in MEASURES] + [F.col(name) for _, name in FLAGS]


def fact_disease_cases(stg: DataFrame, loc: DataFrame | None = None, dis: DataFrame | None = None,
                       date: DataFrame | None = None) -> DataFrame:
    """Fact rows, one per staging row.

    Without dimension frames the foreign keys are computed, not looked up:
    every dimension is derived from this same staging and keyed by a hash of
    its natural key, so the left join would find exactly
      location_id = key(state)       when the state is not null,
      disease_id  = key(disease)     when the name gets a disease row,
      date_id     = YYYYWW(year, week)
    and null otherwise. That makes the fact a map-only projection of staging
    (no join, no shuffle). Pass the dimensions to join against other ones
    (size-checked broadcast joins); the two paths agree on derived dims.
    """
    if loc is None and dis is None and date is None:
        return stg.select(
            _fact_key(),
            F.when(F.col("state_name").isNotNull(), surrogate_key("state_name")).alias("location_id"),
            F.when(has_disease_row(F.col("disease_name")), surrogate_key("disease_name")).alias("disease_id"),
            date_id("year", "week").alias("date_id"),
            *_measures_and_flags(),
        )
    if loc is None or dis is None or date is None:
        raise ValueError("pass all three dimensions or none")
    l = bounded_broadcast(loc.select(F.col("location_id"), F.col("state_name").alias("__l_state")),
                          known_rows=None)
    d = bounded_broadcast(dis.select(F.col("disease_id"), trim_ws("disease_name_long").alias("__d_name")))
    t = bounded_broadcast(date.select(F.col("date_id"), F.col("year").alias("__t_year"),
                                      F.col("week").alias("__t_week")))
    out = (
        stg.withColumn("__s_name", trim_ws("disease_name"))
        .join(l, F.col("state_name") == F.col("__l_state"), "left")
        .join(d, F.col("__s_name") == F.col("__d_name"), "left")
        .join(t, (F.col("year") == F.col("__t_year")) & (F.col("week") == F.col("__t_week")), "left")
    )
    return out.select(_fact_key(), "location_id", "disease_id", "date_id", *_measures_and_flags())


__all__ = ["FACT_COLUMNS", "fact_disease_cases"]
