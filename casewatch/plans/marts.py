"""Star join and the three marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewatch.operators import bounded_broadcast, period_change, running_total, with_change
from casewatch.reference_data import (
    NOT_COUNTED_FLAG, SEASON_FIRST_YEAR, SEASON_FLAGS, SEASON_LAST_YEAR, TOP_N,
)

STAR_LOCATION = ["state_name", "state_abbreviation", "region_name", "census_division"]
STAR_DATE = ["year", "week", "mmwr_period", "week_label", "season", "quarter", "is_holiday_week", "holiday_name"]
STAR_DISEASE = ["disease_name_short", "disease_status", "disease_group", "disease_category", "severity_or_stage"]
STAR_COLUMNS = ["fact_id", *STAR_LOCATION, *STAR_DATE, *STAR_DISEASE,
                "current_week_cases", "previous_52_weeks_max", "current_week_cases_flag"]


def star(fact: DataFrame, loc: DataFrame, dis: DataFrame, date: DataFrame,
         bounds: dict[str, int] | None = None) -> DataFrame:
    """Fact left-joined to the three dimensions; null measures become 0.

    Each dimension is broadcast only after its size is checked (or known from
    `bounds`, e.g. counts taken when the dimensions were written), so the
    large fact side is never shuffled for these joins.
    """
    bounds = bounds or {}
    l = bounded_broadcast(loc.select(F.col("location_id").alias("__l_id"), *STAR_LOCATION),
                          known_rows=bounds.get("dim_location"))
    t = bounded_broadcast(date.select(F.col("date_id").alias("__t_id"), *STAR_DATE),
                          known_rows=bounds.get("dim_date"))
    d = bounded_broadcast(dis.select(F.col("disease_id").alias("__d_id"), *STAR_DISEASE),
                          known_rows=bounds.get("dim_diseases"))
    joined = (
        fact.join(l, F.col("location_id") == F.col("__l_id"), "left")
        .join(t, F.col("date_id") == F.col("__t_id"), "left")
        .join(d, F.col("disease_id") == F.col("__d_id"), "left")
    )
    return joined.select(
        "fact_id", *STAR_LOCATION, *STAR_DATE, *STAR_DISEASE,
        F.coalesce(F.col("current_week_cases"), F.lit(0.0)).alias("current_week_cases"),
        F.coalesce(F.col("previous_52_weeks_max"), F.lit(0.0)).alias("previous_52_weeks_max"),
        "current_week_cases_flag",
    )


def _rounded_long(c: str) -> Column:
    return F.round(F.col(c), 0).cast("long").alias(c)


def counted_flag(flag: str = "current_week_cases_flag") -> Column:
    """Rows whose flag is set and is not '-' (a null flag is not counted)."""
    return F.count_if(F.col(flag) != NOT_COUNTED_FLAG)


# ---- cells: the finest grain that all marts and measures add up from ------------

CELL_KEYS = [*STAR_LOCATION, *STAR_DATE, *STAR_DISEASE]
CELL_MEASURES = ["current_week_cases", "previous_52_weeks_max", "largest_week_cases", "outbreak_rows",
                 "counted_flag_rows", "season_flag_rows", "fact_rows"]
CELL_COLUMNS = [*CELL_KEYS, *CELL_MEASURES]


def star_cells(s: DataFrame) -> DataFrame:
    """One row per distinct (location, week, disease attributes) of the star, with measures that merge.

    Sums, counts and one maximum only, so any coarser aggregate of the star is an aggregate of its
    cells; a cell belongs to one year, so cells are stored and replaced by year.
    """
    return s.groupBy(*CELL_KEYS).agg(
        F.sum("current_week_cases").alias("current_week_cases"),
        F.sum("previous_52_weeks_max").alias("previous_52_weeks_max"),
        F.max("current_week_cases").alias("largest_week_cases"),
        F.sum(is_outbreak()).alias("outbreak_rows"),
        counted_flag().alias("counted_flag_rows"),
        F.count_if(F.col("current_week_cases_flag").isin(SEASON_FLAGS)).alias("season_flag_rows"),
        F.count(F.lit(1)).alias("fact_rows"),
    )


def top5_of_cells(cells: DataFrame) -> DataFrame:
    """`top5_aggregate` of the star the cells were made of."""
    return cells.groupBy(*TOP5_KEYS).agg(
        F.sum("current_week_cases").alias("total_cases"),
        F.sum("counted_flag_rows").alias("flagged_week_count"),
        F.sum("fact_rows").alias("weeks_reported"),
    )


def season_of_cells(cells: DataFrame, first_year: int = SEASON_FIRST_YEAR, last_year: int = SEASON_LAST_YEAR) -> DataFrame:
    """`season_aggregate` of the star the cells were made of."""
    return cells.where(F.col("year").between(first_year, last_year)).groupBy(*SEASON_KEYS).agg(
        F.sum("current_week_cases").alias("total_cases"),
        F.sum("previous_52_weeks_max").alias("previous_52_weeks_max"),
        F.sum("outbreak_rows").alias("outbreak_week_count"),
        F.sum("fact_rows").alias("total_week_observations"),
        F.sum("season_flag_rows").alias("flagged_week_count"),
    )


def wow_of_cells(cells: DataFrame) -> DataFrame:
    """`wow_preagg` of the star the cells were made of."""
    return cells.groupBy(*WOW_KEYS).agg(
        F.sum("counted_flag_rows").alias("flagged_current_week_count"),
        F.sum("current_week_cases").alias("current_week_cases"),
    )


# ---- top diseases per state, year, quarter --------------------------------

TOP5_KEYS = ["state_name", "state_abbreviation", "region_name", "census_division", "year", "season",
             "quarter", "disease_name_short", "disease_group", "disease_category", "severity_or_stage"]
TOP5_COLUMNS = [*TOP5_KEYS, "total_cases", "flagged_week_count", "weeks_reported", "disease_rank_in_state"]


def top5_aggregate(s: DataFrame) -> DataFrame:
    return s.groupBy(*TOP5_KEYS).agg(
        F.sum("current_week_cases").alias("total_cases"),
        counted_flag().alias("flagged_week_count"),
        F.count(F.lit(1)).alias("weeks_reported"),
    )


def top_diseases(s: DataFrame, n: int = TOP_N) -> DataFrame:
    """Dense rank by cases within (state, year, quarter); ranks <= n (ties kept)."""
    return top5_ranked(top5_aggregate(s), n)


def top5_ranked(agg: DataFrame, n: int = TOP_N) -> DataFrame:
    """The top-5 mart from its aggregate. The rank filter lets Spark cut each group early (WindowGroupLimit)."""
    w = Window.partitionBy("state_name", "year", "quarter").orderBy(F.col("total_cases").desc())
    ranked = (agg.withColumn("disease_rank_in_state", F.dense_rank().over(w))
              .where(F.col("disease_rank_in_state") <= n))
    return ranked.select(*TOP5_KEYS, _rounded_long("total_cases"), "flagged_week_count", "weeks_reported",
                         F.col("disease_rank_in_state").cast("long").alias("disease_rank_in_state"))


# ---- season ranking -----------------------------------------------------------

SEASON_KEYS = ["year", "season", "week", "state_name", "state_abbreviation", "region_name", "census_division",
               "disease_name_short", "disease_group", "disease_category", "severity_or_stage"]
SEASON_COLUMNS = [*SEASON_KEYS, "total_cases", "previous_52_weeks_max", "outbreak_week_count",
                  "total_week_observations", "flagged_week_count", "disease_rank_in_state", "state_year_key"]


def is_outbreak(cases: str | Column = "current_week_cases", max52: str | Column = "previous_52_weeks_max") -> Column:
    """1 when this week's cases reach the 52-week maximum and that maximum is positive."""
    c = F.col(cases) if isinstance(cases, str) else cases
    m = F.col(max52) if isinstance(max52, str) else max52
    return F.when((c >= m) & (m > 0), 1).otherwise(0)


def season_aggregate(s: DataFrame, first_year: int = SEASON_FIRST_YEAR,
                     last_year: int = SEASON_LAST_YEAR) -> DataFrame:
    base = s.where(F.col("year").between(first_year, last_year)).withColumn("is_outbreak_week", is_outbreak())
    return base.groupBy(*SEASON_KEYS).agg(
        F.sum("current_week_cases").alias("total_cases"),
        F.sum("previous_52_weeks_max").alias("previous_52_weeks_max"),
        F.sum("is_outbreak_week").cast("long").alias("outbreak_week_count"),
        F.count(F.lit(1)).alias("total_week_observations"),
        F.count_if(F.col("current_week_cases_flag").isin(SEASON_FLAGS)).alias("flagged_week_count"),
    )


def season_ranking(s: DataFrame, first_year: int = SEASON_FIRST_YEAR,
                   last_year: int = SEASON_LAST_YEAR) -> DataFrame:
    """Every (state, year, week, disease...) row with its RANK by cases within (state, year)."""
    return season_ranked(season_aggregate(s, first_year, last_year))


def season_ranked(agg: DataFrame) -> DataFrame:
    """The season mart from its aggregate."""
    w = Window.partitionBy("state_name", "year").orderBy(F.col("total_cases").desc())
    ranked = agg.withColumn("disease_rank_in_state", F.rank().over(w))
    return ranked.select(
        *SEASON_KEYS, _rounded_long("total_cases"), _rounded_long("previous_52_weeks_max"),
        "outbreak_week_count", "total_week_observations", "flagged_week_count",
        F.col("disease_rank_in_state").cast("long").alias("disease_rank_in_state"),
        F.concat(F.col("state_name"), F.lit("-"), F.col("year").cast("string")).alias("state_year_key"),
    )


# ---- week over week by division ---------------------------------------------------

WOW_KEYS = ["region_name", "census_division", "year", "week", "mmwr_period", "week_label", "season", "quarter",
            "is_holiday_week", "holiday_name", "disease_group", "disease_name_short", "disease_status",
            "disease_category", "severity_or_stage"]
# Rows that share (division, short name, year, week) differ only in these;
# ordering by them as well makes LAG and the running sum deterministic.
WOW_TIE_BREAK = ["disease_status", "disease_category", "severity_or_stage", "disease_group"]
WOW_COLUMNS = ["census_division", "region_name", "year", "quarter", "season", "week", "week_label", "mmwr_period",
               "is_holiday_week", "holiday_name", "disease_name_short", "disease_status", "disease_group",
               "disease_category", "severity_or_stage", "current_week_cases", "actual_previous_week_cases",
               "wow_change", "wow_pct_change", "flagged_current_week_count", "running_cumulative_cases_year"]


def wow_preagg(s: DataFrame) -> DataFrame:
    return s.groupBy(*WOW_KEYS).agg(
        counted_flag().alias("flagged_current_week_count"),
        F.sum("current_week_cases").alias("current_week_cases"),
    )


def wow_partition(by: str = "reference") -> list[str]:
    if by == "reference":
        return ["region_name", "disease_name_short"]
    if by == "full":
        return ["region_name", "disease_name_short", *WOW_TIE_BREAK]
    raise ValueError(f"unknown partitioning {by!r}")


def _asc(cols) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in cols]


def wow_lag(pre: DataFrame, by: str = "reference") -> DataFrame:
    return period_change(pre, "current_week_cases", wow_partition(by), _asc(["year", "week", *WOW_TIE_BREAK]),
                         previous="actual_previous_week_cases", change="wow_change", pct="wow_pct_change")


def wow_running(df: DataFrame, by: str = "reference") -> DataFrame:
    """Running cases within (division, short name, year) by week.

    Its sort order equals the one of the LAG window, so Spark reuses the
    partitioning and the sort of that window (no extra exchange or sort).
    """
    return running_total(df, "current_week_cases", [*wow_partition(by), "year"], _asc(["week", *WOW_TIE_BREAK]),
                         name="running_cumulative_cases")


def week_over_week(s: DataFrame, by: str = "reference") -> DataFrame:
    return wow_finish(wow_preagg(s), by)


def wow_finish(pre: DataFrame, by: str = "reference") -> DataFrame:
    """The week-over-week mart from its pre-aggregate (LAG, change, running total)."""
    return _wow_columns(wow_running(wow_lag(pre, by), by))


def wow_year_rows(pre: DataFrame, by: str = "reference") -> DataFrame:
    """The mart's rows as far as one year tells: the first row of a series in a year (`first_of_year`) has no previous
    week yet. `exact_cases` are the cases that a change is computed from."""
    keys, order = [*wow_partition(by), "year"], _asc(["week", *WOW_TIE_BREAK])
    out = period_change(pre, "current_week_cases", keys, order, previous="actual_previous_week_cases", change="wow_change", pct="wow_pct_change")
    out = wow_running(out, by).withColumn("first_of_year", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1)
    return _wow_columns(out, "first_of_year", F.col("current_week_cases").alias("exact_cases"))


def wow_last_rows(pre: DataFrame, by: str = "reference") -> DataFrame:
    """The cases of each series' last row in each year: what the series' next row compares with."""
    last = F.max_by("current_week_cases", F.struct("week", *WOW_TIE_BREAK))  # in a struct, too, nulls come first
    return pre.groupBy(*wow_partition(by), "year").agg(last.alias("last_cases"))


def wow_over_year_ends(rows: DataFrame, last: DataFrame, by: str = "reference") -> DataFrame:
    """The mart from `wow_year_rows` and `wow_last_rows` of all years: the first row of a series in a year takes
    its previous value from the last row of the latest earlier year that has one. Only these rows are joined, one a
    series and year, so years can be written one by one."""
    series = wow_partition(by)
    before = last.select(*[F.col(c).alias(f"__{c}") for c in series], F.col("year").alias("__year"),
                         F.coalesce(F.lag("last_cases").over(Window.partitionBy(*series).orderBy("year")), F.lit(0.0)).alias("__before"))
    same = F.col("year") == F.col("__year")
    for c in series:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    firsts = rows.where("first_of_year").join(before, same).withColumn("actual_previous_week_cases", F.col("__before"))
    firsts = with_change(firsts, "exact_cases", "actual_previous_week_cases", "wow_change", "wow_pct_change")
    firsts = firsts.withColumn("actual_previous_week_cases", _rounded_long("actual_previous_week_cases"))
    return rows.where(~F.col("first_of_year")).select(*WOW_COLUMNS).union(firsts.select(*WOW_COLUMNS))


def _wow_columns(out: DataFrame, *more: Column | str) -> DataFrame:
    return out.select(
        "census_division", "region_name", "year", "quarter", "season", "week", "week_label", "mmwr_period",
        "is_holiday_week", "holiday_name", "disease_name_short", "disease_status", "disease_group",
        "disease_category", "severity_or_stage",
        _rounded_long("current_week_cases"), _rounded_long("actual_previous_week_cases"),
        "wow_change", "wow_pct_change", "flagged_current_week_count",
        F.round("running_cumulative_cases", 0).cast("long").alias("running_cumulative_cases_year"), *more,
    )


# ---- presentation order ------------------------------------------------------------
# A stored table has no order; apply these when reading a mart for display.
PRESENTATION_ORDER = {
    "agg_top5_diseases_per_state_year_quarter": ["state_name", "year", "quarter", "disease_rank_in_state"],
    "agg_week_over_week_change_by_region_week_year": ["region_name", "disease_name_short", "year", "week"],
    "dim_date": ["year", "week"],
}


def ordered(df: DataFrame, model: str) -> DataFrame:
    """The model's rows in its presentation order (ascending, nulls first)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in PRESENTATION_ORDER[model]])
