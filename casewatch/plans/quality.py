"""Data-quality checks: each returns the failing rows; `dq_report` counts them.

Generic tests follow the usual warehouse-test semantics: not_null returns
null rows, unique returns duplicated non-null values, accepted_values returns
each value outside the list (nulls pass), relationships returns non-null
child values without a parent. A test's failure count is its number of rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewatch import reference_data as R
from casewatch.functions import sunday_week_of, week_stamp
from casewatch.operators import bounded_broadcast
from casewatch.operators.joins import MAX_BROADCAST_ROWS
from casewatch.schemas import GRAIN

# ---- generic tests -----------------------------------------------------------


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return (df.groupBy(F.col(col).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
            .where(~F.col("value_field").isin(list(values))))


def parent_keys(parent: DataFrame, pcol: str, alias: str) -> DataFrame:
    """Distinct parent keys, marked for broadcast when their number is within the bound,
    so the large child side is filtered map-side instead of being shuffled."""
    return bounded_broadcast(parent.select(F.col(pcol).alias(alias)).distinct())


def relationships(child: DataFrame, col: str, parent: DataFrame, pcol: str) -> DataFrame:
    """Non-null child values with no parent row (one row per failing child row)."""
    keys = parent_keys(parent, pcol, "__to")
    kids = child.where(F.col(col).isNotNull()).select(F.col(col).alias("from_field"))
    return kids.join(keys, F.col("from_field") == F.col("__to"), "left_anti")


# ---- singular tests ----------------------------------------------------------


def case_spikes(stg: DataFrame) -> DataFrame:
    """Rows whose cases reach a positive 52-week maximum (a warning)."""
    c, m = F.col("current_week_cases"), F.col("previous_52_weeks_max")
    return stg.where(c.isNotNull() & m.isNotNull() & (m > 0) & (c >= m))


def future_weeks(stg: DataFrame, as_of: dt.date) -> DataFrame:
    """Rows stamped after the as-of week (weeks counted from Sundays, 0-53)."""
    d = F.lit(as_of).cast("date")
    today = F.year(d).cast("long") * 100 + sunday_week_of(d)
    return stg.where(week_stamp("year", "week") > today)


def null_cases_no_flag(raw: DataFrame) -> DataFrame:
    """Raw rows with no current-week count and no flag explaining why."""
    return raw.where(F.col("m1").isNull() & F.col("m1_flag").isNull())


def duplicate_rows(df: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    """Key groups that occur more than once, with their size."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


FK_SPECS = [("location_id", "dim_location"), ("disease_id", "dim_diseases"), ("date_id", "dim_date")]


def unmatched_fk(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows whose key is null or has no dimension row, tagged with the failing key.

    One pass of the fact: each dimension's distinct keys are left-joined (no
    row can multiply; Spark broadcasts them by their size or splits a skewed
    key), and only failing keys are exploded into rows.
    """
    df, failing = fact, []
    for i, (col, dim) in enumerate(FK_SPECS):
        key, hit = f"__k{i}", f"__h{i}"
        keys = dims[dim].select(F.col(col).alias(key)).distinct().withColumn(hit, F.lit(True))
        df = df.join(keys, F.col(col) == F.col(key), "left")
        failing.append(F.when(F.col(hit).isNull(), F.struct(F.lit(col).alias("fk_column"), F.col(col).cast("string").alias("fk_value"))))
    bad = F.filter(F.array(*failing), lambda x: x.isNotNull())
    return df.where(F.size(bad) > 0).select("fact_id", F.explode(bad).alias("__f")).select("fact_id", "__f.fk_column", "__f.fk_value")


QUARANTINE_CHECKS: list[tuple[str, str]] = [
    ("states", "missing_states"), ("year", "missing_year"), ("week", "missing_week"), ("label", "missing_label"),
]


#: Without a state or a label a row is loaded and dropped by staging; without its week it cannot be loaded.
LOAD_CHECKS = [c for c in QUARANTINE_CHECKS if c[0] in ("year", "week")]


def quarantine_reason(raw: DataFrame, missing: Sequence[tuple[str, str]] = tuple(QUARANTINE_CHECKS)) -> Column:
    """First reason a raw row cannot be staged safely, or null when it can."""
    out = None
    for col, reason in missing:
        cond = F.col(col).isNull()
        out = F.when(cond, reason) if out is None else out.when(cond, reason)
    for col in ("year", "week"):
        out = out.when(F.col(col).try_cast("long").isNull(), f"bad_{col}")
    for col in ("m1", "m2", "m3", "m4"):
        out = out.when(F.col(col).isNotNull() & F.col(col).try_cast("double").isNull(), f"bad_{col}")
    return out


def quarantine(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split raw rows into (good, bad); bad rows carry `quarantine_reason`."""
    tagged = raw.withColumn("quarantine_reason", quarantine_reason(raw))
    good = tagged.where(F.col("quarantine_reason").isNull()).drop("quarantine_reason")
    bad = tagged.where(F.col("quarantine_reason").isNotNull())
    return good, bad


# ---- the declared test suite and its report -----------------------------------


@dataclass(frozen=True)
class Check:
    kind: str                  # not_null | unique | accepted_values | relationships
    model: str
    column: str
    severity: str = "error"
    values: tuple = field(default=())
    parent: str | None = None
    parent_column: str | None = None

    @property
    def name(self) -> str:
        base = f"{self.kind}_{self.model}_{self.column}"
        return f"{base}__{self.parent}_{self.parent_column}" if self.kind == "relationships" else base


def _nn(model, *cols, severity="error"):
    return [Check("not_null", model, c, severity) for c in cols]


def _av(model, col, values, severity="error"):
    return Check("accepted_values", model, col, severity, tuple(values))


FLAG_COLUMNS = ["current_week_cases_flag", "previous_52_weeks_max_flag", "cumulative_ytd_cases_flag",
                "previous_year_cumulative_flag"]

DECLARED_CHECKS: list[Check] = [
    # staging
    *_nn("stg_nndss_weekly", "year", "week"),
    _av("stg_nndss_weekly", "week", R.ACCEPTED_WEEKS),
    *_nn("stg_nndss_weekly", "region_name"),
    _av("stg_nndss_weekly", "region_name", R.ACCEPTED_DIVISIONS),
    *_nn("stg_nndss_weekly", "disease_name"),
    Check("relationships", "stg_nndss_weekly", "disease_name", "warn", (), "disease_list", "disease_name"),
    *[_av("stg_nndss_weekly", c, R.ACCEPTED_FLAGS) for c in FLAG_COLUMNS],
    # dim_date
    *_nn("dim_date", "date_id"), Check("unique", "dim_date", "date_id"),
    *_nn("dim_date", "year", "week"), _av("dim_date", "week", R.ACCEPTED_WEEKS),
    *_nn("dim_date", "mmwr_period"), Check("unique", "dim_date", "mmwr_period"),
    *_nn("dim_date", "week_label"),
    _av("dim_date", "quarter", R.ACCEPTED_QUARTERS), _av("dim_date", "half_year", R.ACCEPTED_HALVES),
    *_nn("dim_date", "season"), _av("dim_date", "season", R.ACCEPTED_SEASONS),
    *_nn("dim_date", "is_holiday_week"), _av("dim_date", "is_holiday_week", R.ACCEPTED_BOOLEANS),
    *_nn("dim_date", "holiday_name"),
    # dim_diseases
    *_nn("dim_diseases", "disease_id"), Check("unique", "dim_diseases", "disease_id"),
    *_nn("dim_diseases", "disease_name_long"), Check("unique", "dim_diseases", "disease_name_long"),
    Check("relationships", "dim_diseases", "disease_name_long", "warn", (), "disease_list", "disease_name"),
    *_nn("dim_diseases", "disease_name_short"),
    _av("dim_diseases", "disease_status", R.ACCEPTED_STATUS),
    _av("dim_diseases", "target_demographic", R.ACCEPTED_DEMOGRAPHIC),
    _av("dim_diseases", "disease_category", R.ACCEPTED_CATEGORY),
    _av("dim_diseases", "severity_or_stage", R.ACCEPTED_SEVERITY),
    _av("dim_diseases", "pathogen_subtype", R.ACCEPTED_SUBTYPE),
    _av("dim_diseases", "detection_method", R.ACCEPTED_DETECTION),
    _av("dim_diseases", "disease_group", R.ACCEPTED_GROUP),
    # dim_location
    *_nn("dim_location", "location_id"), Check("unique", "dim_location", "location_id"),
    *_nn("dim_location", "state_name"), Check("unique", "dim_location", "state_name"),
    *_nn("dim_location", "state_abbreviation", severity="warn"),
    _av("dim_location", "state_abbreviation", R.ACCEPTED_ABBREVIATIONS, "warn"),
    *_nn("dim_location", "region_name"), _av("dim_location", "region_name", R.ACCEPTED_DIVISIONS),
    _av("dim_location", "census_division", R.ACCEPTED_CENSUS),
    # fact
    *_nn("fact_disease_cases", "fact_id"), Check("unique", "fact_disease_cases", "fact_id"),
    *[c for col, dim in FK_SPECS for c in (
        Check("not_null", "fact_disease_cases", col, "warn"),
        Check("relationships", "fact_disease_cases", col, "warn", (), dim, col),
    )],
    *[_av("fact_disease_cases", c, R.ACCEPTED_FLAGS, "warn") for c in FLAG_COLUMNS],
]


def _rows(pairs: list[tuple[Check, Column]]) -> list[Column]:
    return [F.struct(F.lit(c.name).alias("test"), F.lit(c.severity).alias("severity"),
                     n.cast("long").alias("failures")) for c, n in pairs]


def _model_pass(df: DataFrame, checks: list[Check], parents: dict[str, DataFrame]) -> DataFrame:
    """The not_null and relationship checks of one model in a single scan and aggregation.

    not_null counts null rows; a relationship check whose parent keys are
    small enough to broadcast left-joins those distinct keys (no row can
    multiply) and counts non-null child keys without a match.
    """
    pairs = []
    for i, c in enumerate(checks):
        col = F.col(c.column)
        if c.kind == "not_null":
            pairs.append((c, F.count_if(col.isNull())))
        else:
            key, hit = f"__rk{i}", f"__rh{i}"
            keys = F.broadcast(parents[c.name].select(F.col(c.parent_column).alias(key))
                               .withColumn(hit, F.lit(True)))
            df = df.join(keys, col == F.col(key), "left")
            pairs.append((c, F.count_if(col.isNotNull() & F.col(hit).isNull())))
    one = df.agg(*[n.alias(f"__n{i}") for i, (_, n) in enumerate(pairs)])
    rows = _rows([(c, F.col(f"__n{i}")) for i, (c, _) in enumerate(pairs)])
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _values_pass(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All accepted_values checks of one model: distinct failing values, one test row per value.

    Each row emits its failing (check, value) pairs only, so clean rows emit nothing.
    """
    failing = F.array(*[
        F.when(~F.col(c.column).isin(list(c.values)), F.struct(F.lit(i).alias("i"), F.col(c.column).cast("string").alias("v")))
        for i, c in enumerate(checks)])
    found = (df.select(F.explode(F.filter(failing, lambda x: x.isNotNull())).alias("x")).select("x.i", "x.v").distinct()
             .groupBy("i").agg(F.count(F.lit(1)).alias("n")))
    per_check = found.agg(F.map_from_entries(F.collect_list(F.struct("i", "n"))).alias("m"))  # one entry per check
    rows = _rows([(c, F.coalesce(F.col("m")[i], F.lit(0))) for i, c in enumerate(checks)])
    return per_check.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _count_of(check: Check, failing: DataFrame, column: str) -> DataFrame:
    return failing.agg(F.coalesce(F.sum(column), F.lit(0)).cast("long").alias("failures")).select(
        F.lit(check.name).alias("test"), F.lit(check.severity).alias("severity"), "failures")


def _small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def dq_report(models: dict[str, DataFrame], checks: Sequence[Check] = DECLARED_CHECKS,
              parent_rows: dict[str, int] | None = None) -> DataFrame:
    """One row per check: (test, severity, failures, status).

    Each model is scanned once for its not_null and small-parent relationship
    checks and once for its accepted_values checks; a unique check is a grouped
    count (partial aggregation first). A relationship to a parent too large to
    broadcast pre-aggregates the child keys, so a hot key becomes one row,
    before the anti-join. The report is one DataFrame, one row per check.
    `parent_rows` gives known row counts of parent models (e.g. counts taken
    when dimensions were written); a parent without one is counted.
    """
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    values: dict[str, list[Check]] = {}
    parents: dict[str, DataFrame] = {}
    for c in checks:
        if c.kind == "not_null":
            by_model.setdefault(c.model, []).append(c)
        elif c.kind == "accepted_values":
            values.setdefault(c.model, []).append(c)
        elif c.kind == "unique":
            parts.append(_count_of(c, unique(models[c.model], c.column).select(F.lit(1).alias("n")), "n"))
        elif c.kind == "relationships":
            parent = models[c.parent].select(c.parent_column).distinct()
            known = (parent_rows or {}).get(c.parent)
            if (known is not None and known <= MAX_BROADCAST_ROWS) or (known is None and _small(parent)):
                parents[c.name] = parent
                by_model.setdefault(c.model, []).append(c)
            else:
                child = (models[c.model].where(F.col(c.column).isNotNull())
                         .groupBy(F.col(c.column).alias("__v")).agg(F.count(F.lit(1)).alias("n")))
                missing = child.join(parent, F.col("__v") == F.col(c.parent_column), "left_anti")
                parts.append(_count_of(c, missing, "n"))
        else:
            raise ValueError(f"unknown check kind {c.kind!r}")
    for model, cs in by_model.items():
        parts.append(_model_pass(models[model], cs, parents))
    for model, cs in values.items():
        parts.append(_values_pass(models[model], cs))
    report = reduce(DataFrame.unionByName, parts)
    sev = F.col("severity")
    status = F.when(F.col("failures") == 0, "pass").when(sev == "warn", "warn").otherwise("fail")
    return report.withColumn("status", status)


# (test, severity): the singular tests that run beside the declared ones.
SINGULAR_CHECKS = {"case_count_spike": "warn", "future_week_rows": "error", "null_cases_no_flag": "warn",
                   "duplicate_staging_rows": "error"}


def singular_report(stg: DataFrame, raw: DataFrame, as_of: dt.date) -> DataFrame:
    """The singular tests as rows of the report (test, severity, failures, status).

    Row conditions are counted in one pass of their table; duplicates are grouped, partial counts first.
    """
    def one(test: str, failing: DataFrame) -> DataFrame:
        severity = SINGULAR_CHECKS[test]
        n = failing.agg(F.count(F.lit(1)).alias("failures"))
        status = F.when(F.col("failures") == 0, "pass").otherwise("warn" if severity == "warn" else "fail")
        return n.select(F.lit(test).alias("test"), F.lit(severity).alias("severity"), "failures", status.alias("status"))

    return reduce(DataFrame.unionByName, [
        one("case_count_spike", case_spikes(stg)), one("future_week_rows", future_weeks(stg, as_of)),
        one("null_cases_no_flag", null_cases_no_flag(raw)), one("duplicate_staging_rows", duplicate_rows(stg))])


def raise_on_errors(report: DataFrame) -> None:
    """Raise when any error-severity check failed (warnings are reported only)."""
    failed = [r["test"] for r in report.where(F.col("status") == "fail").select("test").collect()]
    if failed:
        raise AssertionError(f"data tests failed: {failed}")
