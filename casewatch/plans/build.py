"""Build every model from raw rows, lazily or written to shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from casewatch.plans.dims import dim_date, dim_diseases, dim_location, dimension_bounds
from casewatch.plans.facts import fact_disease_cases
from casewatch.plans.marts import season_ranking, star, top_diseases, week_over_week
from casewatch.plans.staging import dedup_grain, reportable
from casewatch.reference_data import US_HOLIDAYS
from casewatch.session import scratch_path
from casewatch.sources.seeds import us_holidays
from casewatch.sources.tables import write_table


def build_models(raw: DataFrame, holidays: DataFrame | None = None, materialize: bool = False,
                 root: str | None = None) -> dict[str, DataFrame]:
    """staging -> dims -> fact -> star -> marts.

    Lazy by default: one plan per consumer, which Spark optimises whole.
    With materialize=True staging, dims and fact are written as Parquet below
    `root` (default: a new folder under the session's checkpoint dir) and read
    back, so the marts start from stored tables, staging is computed once
    for its four readers, and lineage is cut. Dimension row counts taken
    after writing are the size bounds for the broadcast joins.
    """
    spark = raw.sparkSession
    holiday_rows = len(US_HOLIDAYS) if holidays is None else None
    holidays = us_holidays(spark) if holidays is None else holidays
    m: dict[str, DataFrame] = {}

    def keep(name, df, kind="dims"):
        if materialize:
            base = root or scratch_path(spark, "models")
            df = write_table(df, f"{base.rstrip('/')}/{kind}/{name}")
        m[name] = df
        return df

    rows = reportable(raw)
    stg = keep("stg_nndss_weekly", dedup_grain(rows), "staging")
    # Written staging is cheap to re-read; lazily, the pre-dedup rows give the
    # same distinct grain values without the dedup's sort-based shuffle.
    grain = stg if materialize else rows
    loc = keep("dim_location", dim_location(grain))
    date = keep("dim_date", dim_date(grain, holidays, holiday_rows))
    dis = keep("dim_diseases", dim_diseases(grain))
    if materialize:
        bounds = {k: m[k].count() for k in ("dim_location", "dim_date", "dim_diseases")}
    else:
        bounds = dimension_bounds(rows)
    fact = keep("fact_disease_cases", fact_disease_cases(stg), "facts")
    s = star(fact, loc, dis, date, bounds)
    m["star"] = s
    m["agg_top5_diseases_per_state_year_quarter"] = top_diseases(s)
    m["agg_top_disease_per_season_year"] = season_ranking(s)
    m["agg_week_over_week_change_by_region_week_year"] = week_over_week(s)
    return m
