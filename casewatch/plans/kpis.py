"""

K6-K11 only add up cases, so they take the star's cells (`marts.star_cells`) as well as the star;
K1-K5 from cells are `overview_of_cells`.

Every measure is an aggregate first; windows only run over aggregated,
calendar-bounded series (years, quarters) per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewatch.operators import bounded_broadcast, period_change
from casewatch.plans.marts import is_outbreak
from casewatch.reference_data import STI_SHORT_NAMES

CASES = "current_week_cases"


def kpi_overview(s: DataFrame) -> DataFrame:
    """K1-K5 in one aggregation: totals, states reporting, STI share, diseases, outbreak rate."""
    cases = F.col(CASES)
    sti = F.col("disease_name_short").isin(STI_SHORT_NAMES)
    return s.agg(
        F.sum(cases).alias("total_cases"),
        F.count_distinct(F.when(cases > 0, F.col("state_name"))).alias("states_reporting"),
        F.try_divide(F.sum(F.when(sti, cases).otherwise(0.0)), F.sum(cases)).alias("sti_burden_rate"),
        F.count_distinct("disease_name_short").alias("unique_diseases_tracked"),
        F.avg(is_outbreak()).alias("outbreak_alert_rate"),
    )


def overview_of_cells(cells: DataFrame) -> DataFrame:
    """`kpi_overview` from the star's cells: a state reports if its largest count is positive, and the
    outbreak rate is outbreak rows over fact rows."""
    cases = F.col(CASES)
    sti = F.col("disease_name_short").isin(STI_SHORT_NAMES)
    return cells.agg(
        F.sum(cases).alias("total_cases"),
        F.count_distinct(F.when(F.col("largest_week_cases") > 0, F.col("state_name"))).alias("states_reporting"),
        F.try_divide(F.sum(F.when(sti, cases).otherwise(0.0)), F.sum(cases)).alias("sti_burden_rate"),
        F.count_distinct("disease_name_short").alias("unique_diseases_tracked"),
        F.try_divide(F.sum("outbreak_rows").cast("double"), F.sum("fact_rows").cast("double")).alias("outbreak_alert_rate"),
    )


def share_by(s: DataFrame, column: str) -> DataFrame:
    """Cases and share of all cases per value of `column` (K6, K7).

    The grand total is a lazy scalar subquery over the groups (their exchange
    is reused, so the star is read once); no window gathers all groups into one task.
    """
    per = s.groupBy(column).agg(F.sum(CASES).alias("total_cases"))
    total = per.agg(F.sum("total_cases").cast("double")).scalar()
    return per.select(column, "total_cases", F.try_divide(F.col("total_cases"), total).cast("double").alias("case_share"))


def year_over_year(s: DataFrame, by: str = "disease_name_short") -> DataFrame:
    """K8: cases per (disease, year) next to the previous calendar year's (null when absent).

    The previous year comes from LAG over the yearly totals plus a check that
    it is exactly year - 1, which equals a self-join on year - 1 without a
    second shuffle of the yearly totals.
    """
    yearly = s.groupBy(by, "year").agg(F.sum(CASES).alias("total_cases"))
    w = Window.partitionBy(by).orderBy(F.col("year").asc_nulls_first())
    prev_year, prev_cases = F.lag("year").over(w), F.lag("total_cases").over(w)
    out = yearly.withColumn("previous_year_cases",
                            F.when(prev_year == F.col("year") - 1, prev_cases))
    change = F.col("total_cases") - F.col("previous_year_cases")
    return out.select(
        by, "year", "total_cases", "previous_year_cases",
        change.alias("yoy_change"),
        F.round(F.try_divide(change, F.nullif(F.col("previous_year_cases"), F.lit(0.0))) * 100, 2)
        .alias("yoy_pct_change"),
    )


def volatility(s: DataFrame, column: str = "disease_category", digits: int = 6) -> DataFrame:
    """K9: mean, sample stddev and their ratio of weekly case totals per group."""
    weekly = s.groupBy(column, "year", "week").agg(F.sum(CASES).alias("weekly_cases"))
    per = weekly.groupBy(column).agg(
        F.count(F.lit(1)).alias("n_weeks"),
        F.avg("weekly_cases").alias("mean_weekly_cases"),
        F.stddev_samp("weekly_cases").alias("stddev_weekly_cases"),
    )
    return per.select(
        column, "n_weeks",
        F.round("mean_weekly_cases", digits).alias("mean_weekly_cases"),
        F.round("stddev_weekly_cases", digits).alias("stddev_weekly_cases"),
        F.round(F.try_divide(F.col("stddev_weekly_cases"), F.col("mean_weekly_cases")), digits)
        .alias("coefficient_of_variation"),
    )


def per_100k(s: DataFrame, population: DataFrame, by: str = "disease_name_short") -> DataFrame:
    """K10: cases per 100,000 people per (disease, year).

    The denominator is the population of all states in that year; both sides
    are aggregated before they meet, so the join is between small tables
    (the population side broadcast after a size check).
    """
    cases = s.groupBy(by, "year").agg(F.sum(CASES).alias("total_cases"))
    pop = population.groupBy(F.col("year").cast("long").alias("__p_year")).agg(
        F.sum("population").cast("long").alias("population"))
    joined = cases.join(bounded_broadcast(pop), F.col("year") == F.col("__p_year"), "left")
    return joined.select(
        by, "year", "total_cases", "population",
        F.try_divide(F.col("total_cases") * 100000, F.col("population").cast("double")).alias("cases_per_100k"),
    )


def period_over_period(s: DataFrame, partition: Sequence[str], period: Sequence[str],
                       value: str = CASES) -> DataFrame:
    """K11: totals per (partition, period) with the previous period's value, change and %.

    `period` columns order the periods inside each partition.
    """
    agg = s.groupBy(*partition, *period).agg(F.sum(value).alias("total_cases"))
    order: list[Column] = [F.col(c).asc_nulls_first() for c in period]
    return period_change(agg, "total_cases", list(partition), order,
                         previous="previous_total", change="change", pct="pct_change")
