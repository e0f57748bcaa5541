"""DuckDB text of every oracle query: a re-statement in SQL that shares the library's fixed values.

The prefix `WITH ...` chain derives raw rows from `lineitem` the same way the
Spark adapter does, then staging, the dimensions, the fact and the star. Each
oracle query is that prefix plus a final SELECT. Notes on engine differences:
DuckDB sorts nulls last, so every window ORDER BY spells NULLS FIRST/LAST;
regexp_replace needs the 'g' flag; list indexes start at 1; `trim` takes the
explicit whitespace set.
"""

from __future__ import annotations

from casewatch.functions.patterns import modifier_regex
from casewatch.functions.text import ASCII_WS_CLASS, UNICODE_WS
from casewatch.plans.quality import DECLARED_CHECKS
from casewatch.reference_data import (
    ACCEPTED_FLAGS, DISEASE_LIST,
    DISEASE_CATEGORY_RULES, DISEASE_DEMOGRAPHIC_RULES, DISEASE_DETECTION_RULES,
    DISEASE_GROUP_PREFIX_RULES, DISEASE_SEVERITY_RULES, DISEASE_STATUS_RULES, DISEASE_SUBTYPE_RULES,
    DIVISION_REGION, SHORT_NAME_STRIP_RULES, STATE_ABBREVIATION, STATE_DIVISION, SURROGATE_NULL,
    US_HOLIDAYS,
)
from casewatch.sources.adapter import ADAPTER_LABELS, ADAPTER_STATES


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def chars(s: str) -> str:
    """A string of arbitrary characters as a concatenation of chr() calls."""
    return "(" + " || ".join(f"chr({ord(c)})" for c in s) + ")"


def values(rows) -> str:
    return ", ".join("(" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


WS = chars(UNICODE_WS)


def trim_ws(x: str) -> str:
    return f"trim({x}, {WS})"


def sk(*cols: str) -> str:
    parts = [f"COALESCE(CAST({c} AS VARCHAR), {q(SURROGATE_NULL)})" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


def case_map(x: str, table: dict) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items()) + " ELSE NULL END"


def first_match(x: str, rules, prefix: bool = False) -> str:
    def like(p):
        return q(p + "%") if prefix else q("%" + p + "%")
    return "CASE " + " ".join(f"WHEN {x} LIKE {like(p)} THEN {q(label)}" for p, label in rules) + " ELSE 'N/A' END"


def short_name(x: str) -> str:
    strip = "CASE " + " ".join(
        f"WHEN starts_with({x}, {q(p)}) THEN replace({x}, {q(t)}, '')" for p, t in SHORT_NAME_STRIP_RULES
    ) + f" ELSE {x} END"
    bare = f"regexp_replace({strip}, {q(modifier_regex())}, '', 'g')"
    return f"regexp_replace({trim_ws(bare)}, {q(ASCII_WS_CLASS + '+')}, ' ', 'g')"


def week_bands(w: str) -> dict[str, str]:
    return {
        "quarter": f"CASE WHEN {w} BETWEEN 1 AND 13 THEN 'Q1' WHEN {w} BETWEEN 14 AND 26 THEN 'Q2' "
                   f"WHEN {w} BETWEEN 27 AND 39 THEN 'Q3' WHEN {w} BETWEEN 40 AND 52 THEN 'Q4' ELSE NULL END",
        "half_year": f"CASE WHEN {w} BETWEEN 1 AND 26 THEN 'H1' WHEN {w} BETWEEN 27 AND 52 THEN 'H2' ELSE NULL END",
        "season": f"CASE WHEN {w} BETWEEN 14 AND 26 THEN 'SPRING' WHEN {w} BETWEEN 27 AND 39 THEN 'SUMMER' "
                  f"WHEN {w} BETWEEN 40 AND 48 THEN 'FALL' ELSE 'WINTER' END",
    }


def disease_attrs(n: str) -> str:
    return ",\n    ".join([
        f"{first_match(n, DISEASE_STATUS_RULES)} AS disease_status",
        f"{first_match(n, DISEASE_DEMOGRAPHIC_RULES)} AS target_demographic",
        f"{first_match(n, DISEASE_CATEGORY_RULES)} AS disease_category",
        f"{first_match(n, DISEASE_SEVERITY_RULES)} AS severity_or_stage",
        f"{first_match(n, DISEASE_SUBTYPE_RULES)} AS pathogen_subtype",
        f"{first_match(n, DISEASE_DETECTION_RULES)} AS detection_method",
        f"{first_match(n, DISEASE_GROUP_PREFIX_RULES, prefix=True)} AS disease_group",
        f"{short_name(n)} AS disease_name_short",
    ])


_WB = week_bands("week")

RAW_COLS = ("states, \"year\", week, label, m1, m2, m3, m4, m1_flag, m2_flag, m3_flag, m4_flag, "
            "sort_order, geocode_coordinates")

CTES = {
    "s": f"s(i, v) AS (VALUES {values(enumerate(ADAPTER_STATES))})",
    "d": f"d(i, v) AS (VALUES {values(enumerate(ADAPTER_LABELS))})",
    "hol": f"hol(\"year\", week, holiday_name) AS (VALUES {values(US_HOLIDAYS)})",
    "raw_x": """raw_x AS (
  SELECT s.v AS states,
    CAST(2022 + year(l.l_shipdate) % 5 AS VARCHAR) AS "year",
    CAST(CAST(1 + floor((dayofyear(l.l_shipdate) - 1) / 7) AS BIGINT) AS VARCHAR) AS week,
    d.v AS label,
    CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR) END AS m1,
    CAST(CAST(floor(l.l_extendedprice) AS BIGINT) % 60 AS VARCHAR) AS m2,
    CAST(CAST(floor(l.l_quantity) AS BIGINT) * l.l_linenumber AS VARCHAR) AS m3,
    CAST(CAST(floor(l.l_extendedprice) AS BIGINT) % 500 AS VARCHAR) AS m4,
    CASE WHEN l.l_returnflag = 'A' THEN '-' WHEN l.l_returnflag = 'R' THEN 'U' END AS m1_flag,
    CASE WHEN l.l_linestatus = 'F' THEN '--' END AS m2_flag,
    CASE WHEN l.l_linestatus = 'F' THEN '--' END AS m3_flag,
    CASE WHEN l.l_linestatus = 'F' THEN '--' END AS m4_flag,
    concat_ws('|', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR), CAST(l.l_partkey AS VARCHAR),
      CAST(l.l_suppkey AS VARCHAR), CAST(CAST(floor(l.l_extendedprice * 100) AS BIGINT) AS VARCHAR),
      CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR)) AS sort_order,
    CASE WHEN l.l_orderkey % 3 = 0 THEN NULL
      ELSE [CAST(-70.25 - l.l_orderkey % 50 AS DOUBLE), CAST(25.25 + l.l_orderkey % 24 AS DOUBLE)] END
      AS geocode_coordinates,
    l.l_shipdate
  FROM lineitem l JOIN s ON l.l_orderkey % 55 = s.i JOIN d ON l.l_partkey % 136 = d.i
)""",
    "raw": f"raw AS (SELECT {RAW_COLS} FROM raw_x)",
    "cleaned": f"""cleaned AS (
  SELECT md5(sort_order) AS sort_order_masked,
    md5(COALESCE(CAST(geocode_coordinates[1] AS VARCHAR), '')) AS longitude_masked,
    md5(COALESCE(CAST(geocode_coordinates[2] AS VARCHAR), '')) AS latitude_masked,
    upper({trim_ws('states')}) AS state_name,
    {case_map(f"upper({trim_ws('states')})", STATE_DIVISION)} AS region_name,
    CAST("year" AS BIGINT) AS "year",
    CAST(week AS BIGINT) AS week,
    replace(regexp_replace(upper({trim_ws('label')}), {q(ASCII_WS_CLASS + '+')}, ' ', 'g'),
      'SALMONELLAPARATYPHI', 'SALMONELLA PARATYPHI') AS disease_name,
    COALESCE(CAST(m1 AS DOUBLE), 0.0) AS current_week_cases,
    COALESCE(CAST(m2 AS DOUBLE), 0.0) AS previous_52_weeks_max,
    COALESCE(CAST(m3 AS DOUBLE), 0.0) AS cumulative_ytd_cases,
    COALESCE(CAST(m4 AS DOUBLE), 0.0) AS previous_year_cumulative,
    m1_flag AS current_week_cases_flag,
    m2_flag AS previous_52_weeks_max_flag,
    m3_flag AS cumulative_ytd_cases_flag,
    m4_flag AS previous_year_cumulative_flag
  FROM raw
)""",
    "reportable": """reportable AS (
  SELECT * FROM cleaned WHERE region_name IS NOT NULL AND disease_name NOT LIKE '%, TOTAL'
)""",
    "stg": """stg AS (
  SELECT * EXCLUDE (row_num) FROM (
    SELECT *, row_number() OVER (PARTITION BY state_name, "year", week, disease_name
      ORDER BY sort_order_masked ASC NULLS FIRST, longitude_masked ASC NULLS FIRST,
        latitude_masked ASC NULLS FIRST, current_week_cases ASC NULLS FIRST,
        previous_52_weeks_max ASC NULLS FIRST, cumulative_ytd_cases ASC NULLS FIRST,
        previous_year_cumulative ASC NULLS FIRST, current_week_cases_flag ASC NULLS FIRST,
        previous_52_weeks_max_flag ASC NULLS FIRST, cumulative_ytd_cases_flag ASC NULLS FIRST,
        previous_year_cumulative_flag ASC NULLS FIRST) AS row_num
    FROM reportable) t
  WHERE row_num = 1
)""",
    "dim_location": f"""dim_location AS (
  SELECT {sk('state_name')} AS location_id, state_name,
    {case_map('state_name', STATE_ABBREVIATION)} AS state_abbreviation,
    region_name,
    {case_map('region_name', DIVISION_REGION)} AS census_division
  FROM (SELECT DISTINCT state_name, region_name FROM stg WHERE state_name IS NOT NULL) b
)""",
    "dim_date": f"""dim_date AS (
  SELECT CAST(CAST(y."year" AS VARCHAR) || lpad(CAST(y.week AS VARCHAR), 2, '0') AS BIGINT) AS date_id,
    y."year", y.week,
    CAST(y."year" AS VARCHAR) || '-W' || lpad(CAST(y.week AS VARCHAR), 2, '0') AS mmwr_period,
    'Week ' || CAST(y.week AS VARCHAR) || ', ' || CAST(y."year" AS VARCHAR) AS week_label,
    {week_bands('y.week')['quarter']} AS quarter,
    {week_bands('y.week')['half_year']} AS half_year,
    {week_bands('y.week')['season']} AS season,
    h.holiday_name IS NOT NULL AS is_holiday_week,
    COALESCE(h.holiday_name, 'N/A') AS holiday_name
  FROM (SELECT DISTINCT "year", week FROM stg) y
  LEFT JOIN hol h ON y."year" = h."year" AND y.week = h.week
)""",
    "dim_diseases": f"""dim_diseases AS (
  SELECT {sk('disease_name')} AS disease_id, disease_name AS disease_name_long,
    {disease_attrs('disease_name')}
  FROM (SELECT DISTINCT disease_name FROM stg) u
  WHERE disease_name NOT LIKE '%ASSOCIATED%'
)""",
    "fact": f"""fact AS (
  SELECT {sk('stg.state_name', 'stg.disease_name', 'stg."year"', 'stg.week')} AS fact_id,
    l.location_id, d.disease_id, dt.date_id,
    stg.current_week_cases, stg.previous_52_weeks_max, stg.cumulative_ytd_cases, stg.previous_year_cumulative,
    stg.current_week_cases_flag, stg.previous_52_weeks_max_flag, stg.cumulative_ytd_cases_flag,
    stg.previous_year_cumulative_flag
  FROM stg
  LEFT JOIN dim_location l ON stg.state_name = l.state_name
  LEFT JOIN dim_diseases d ON {trim_ws('stg.disease_name')} = {trim_ws('d.disease_name_long')}
  LEFT JOIN dim_date dt ON stg."year" = dt."year" AND stg.week = dt.week
)""",
    "star": """star AS (
  SELECT f.fact_id, dl.state_name, dl.state_abbreviation, dl.region_name, dl.census_division,
    dd."year", dd.week, dd.mmwr_period, dd.week_label, dd.season, dd.quarter, dd.is_holiday_week, dd.holiday_name,
    di.disease_name_short, di.disease_status, di.disease_group, di.disease_category, di.severity_or_stage,
    COALESCE(f.current_week_cases, 0.0) AS current_week_cases,
    COALESCE(f.previous_52_weeks_max, 0.0) AS previous_52_weeks_max,
    f.current_week_cases_flag
  FROM fact f
  LEFT JOIN dim_location dl ON f.location_id = dl.location_id
  LEFT JOIN dim_date dd ON f.date_id = dd.date_id
  LEFT JOIN dim_diseases di ON f.disease_id = di.disease_id
)""",
}


def with_ctes(*extra: str) -> str:
    """The whole CTE chain plus extra CTE definitions, ready for a final SELECT."""
    return "WITH " + ",\n".join([*CTES.values(), *extra]) + "\n"


# ---------------------------------------------------------------------------
# Final SELECTs per query key.
# ---------------------------------------------------------------------------

_ATTR_SQL = {
    "disease_status": ("disease_status", lambda n: first_match(n, DISEASE_STATUS_RULES)),
    "disease_demographic": ("target_demographic", lambda n: first_match(n, DISEASE_DEMOGRAPHIC_RULES)),
    "disease_category": ("disease_category", lambda n: first_match(n, DISEASE_CATEGORY_RULES)),
    "disease_severity": ("severity_or_stage", lambda n: first_match(n, DISEASE_SEVERITY_RULES)),
    "disease_subtype": ("pathogen_subtype", lambda n: first_match(n, DISEASE_SUBTYPE_RULES)),
    "disease_detection": ("detection_method", lambda n: first_match(n, DISEASE_DETECTION_RULES)),
    "disease_group": ("disease_group", lambda n: first_match(n, DISEASE_GROUP_PREFIX_RULES, prefix=True)),
    "disease_name_short": ("disease_name_short", short_name),
}

TOP5_KEYS = ("state_name, state_abbreviation, region_name, census_division, \"year\", season, quarter, "
             "disease_name_short, disease_group, disease_category, severity_or_stage")
SEASON_KEYS = ("\"year\", season, week, state_name, state_abbreviation, region_name, census_division, "
               "disease_name_short, disease_group, disease_category, severity_or_stage")
WOW_KEYS = ("region_name, census_division, \"year\", week, mmwr_period, week_label, season, quarter, "
            "is_holiday_week, holiday_name, disease_group, disease_name_short, disease_status, "
            "disease_category, severity_or_stage")
WOW_TIE = ("disease_status ASC NULLS FIRST, disease_category ASC NULLS FIRST, "
           "severity_or_stage ASC NULLS FIRST, disease_group ASC NULLS FIRST")

CTE_TOP5_AGG = f"""top5_agg AS (
  SELECT {TOP5_KEYS}, SUM(current_week_cases) AS total_cases,
    COUNT(CASE WHEN current_week_cases_flag != '-' THEN 1 END) AS flagged_week_count, COUNT(*) AS weeks_reported
  FROM star GROUP BY {TOP5_KEYS}
)"""

CTE_SEASON_AGG = f"""season_agg AS (
  SELECT {SEASON_KEYS}, SUM(current_week_cases) AS total_cases,
    SUM(previous_52_weeks_max) AS previous_52_weeks_max,
    CAST(SUM(CASE WHEN current_week_cases >= previous_52_weeks_max AND previous_52_weeks_max > 0
      THEN 1 ELSE 0 END) AS BIGINT) AS outbreak_week_count,
    COUNT(*) AS total_week_observations,
    COUNT(CASE WHEN current_week_cases_flag IN ('U', 'N', 'NN', 'NP', 'NC') THEN 1 END) AS flagged_week_count
  FROM star WHERE "year" >= 2022 AND "year" <= 2026 GROUP BY {SEASON_KEYS}
)"""

CTE_WOW_PRE = f"""wow_pre AS (
  SELECT {WOW_KEYS}, COUNT(CASE WHEN current_week_cases_flag != '-' THEN 1 END) AS flagged_current_week_count,
    SUM(current_week_cases) AS current_week_cases
  FROM star GROUP BY {WOW_KEYS}
)"""

CTE_WOW_LAG = f"""wow_lag AS (
  SELECT *, current_week_cases - actual_previous_week_cases AS wow_change,
    COALESCE(round((current_week_cases - actual_previous_week_cases)
      / NULLIF(actual_previous_week_cases, 0) * 100, 2), 0.0) AS wow_pct_change
  FROM (SELECT *, COALESCE(lag(current_week_cases) OVER (PARTITION BY region_name, disease_name_short
      ORDER BY "year" ASC NULLS FIRST, week ASC NULLS FIRST, {WOW_TIE}), 0.0) AS actual_previous_week_cases
    FROM wow_pre) t
)"""

CTE_WOW_RUN = f"""wow_run AS (
  SELECT *, SUM(current_week_cases) OVER (PARTITION BY region_name, disease_name_short, "year"
      ORDER BY week ASC NULLS FIRST, {WOW_TIE} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    AS running_cumulative_cases
  FROM wow_lag
)"""

SELECTS: dict[str, tuple[tuple[str, ...], str]] = {
    # key: (extra CTEs, final select)
    "stg_masking": ((), "SELECT sort_order_masked, longitude_masked, latitude_masked FROM cleaned"),
    "stg_state_region": ((), f"""SELECT states, upper({trim_ws('states')}) AS state_name,
        {case_map(f"upper({trim_ws('states')})", STATE_DIVISION)} AS region_name, n_rows
      FROM (SELECT states, COUNT(*) AS n_rows FROM raw GROUP BY states) t"""),
    "stg_disease_name": ((), f"""SELECT label,
        replace(regexp_replace(upper({trim_ws('label')}), {q(ASCII_WS_CLASS + '+')}, ' ', 'g'),
          'SALMONELLAPARATYPHI', 'SALMONELLA PARATYPHI') AS disease_name, n_rows
      FROM (SELECT label, COUNT(*) AS n_rows FROM raw GROUP BY label) t"""),
    "stg_measures": ((), """SELECT current_week_cases, previous_52_weeks_max, cumulative_ytd_cases,
        previous_year_cumulative, current_week_cases_flag, previous_52_weeks_max_flag,
        cumulative_ytd_cases_flag, previous_year_cumulative_flag FROM cleaned"""),
    "stg_filters": ((), "SELECT * FROM reportable"),
    "stg_dedup": ((), 'SELECT state_name, "year", week, disease_name, sort_order_masked FROM stg'),
    "stg_nndss_weekly": ((), "SELECT * FROM stg"),
    "surrogate_key": ((), f"""SELECT {sk('state_name', 'disease_name', '"year"', 'week')} AS fact_id,
        {sk('state_name')} AS location_id, {sk('disease_name')} AS disease_id,
        state_name, disease_name, "year", week FROM stg"""),
    "dim_location": ((), "SELECT * FROM dim_location"),
    "dim_date_labels": ((), 'SELECT date_id, "year", week, mmwr_period, week_label FROM dim_date'),
    "dim_date_buckets": ((), 'SELECT "year", week, quarter, half_year, season FROM dim_date'),
    "dim_date_holidays": ((), 'SELECT "year", week, is_holiday_week, holiday_name FROM dim_date'),
    "dim_date": ((), "SELECT * FROM dim_date"),
    **{
        key: ((), f"SELECT disease_name, {fn('disease_name')} AS {col} FROM (SELECT DISTINCT disease_name FROM stg) u")
        for key, (col, fn) in _ATTR_SQL.items()
    },
    "dim_diseases": ((), "SELECT * FROM dim_diseases"),
    "fact_disease_cases": ((), "SELECT * FROM fact"),
    "mart_star": ((), "SELECT * FROM star"),
    "top5_aggregate": ((CTE_TOP5_AGG,), "SELECT * FROM top5_agg"),
    "mart_top5_state_quarter": ((CTE_TOP5_AGG,), f"""SELECT {TOP5_KEYS},
        CAST(round(total_cases, 0) AS BIGINT) AS total_cases, flagged_week_count, weeks_reported,
        disease_rank_in_state
      FROM (SELECT *, dense_rank() OVER (PARTITION BY state_name, "year", quarter
          ORDER BY total_cases DESC) AS disease_rank_in_state FROM top5_agg) t
      WHERE disease_rank_in_state <= 5"""),
    "outbreak_flag": ((), """SELECT fact_id, current_week_cases, previous_52_weeks_max,
        CASE WHEN current_week_cases >= previous_52_weeks_max AND previous_52_weeks_max > 0 THEN 1 ELSE 0 END
          AS is_outbreak_week FROM star"""),
    "season_aggregate": ((CTE_SEASON_AGG,), "SELECT * FROM season_agg"),
    "mart_top_disease_season": ((CTE_SEASON_AGG,), f"""SELECT {SEASON_KEYS},
        CAST(round(total_cases, 0) AS BIGINT) AS total_cases,
        CAST(round(previous_52_weeks_max, 0) AS BIGINT) AS previous_52_weeks_max,
        outbreak_week_count, total_week_observations, flagged_week_count,
        rank() OVER (PARTITION BY state_name, "year" ORDER BY total_cases DESC) AS disease_rank_in_state,
        state_name || '-' || CAST("year" AS VARCHAR) AS state_year_key
      FROM season_agg"""),
    "wow_preagg": ((CTE_WOW_PRE,), "SELECT * FROM wow_pre"),
    "wow_lag": ((CTE_WOW_PRE, CTE_WOW_LAG), "SELECT * FROM wow_lag"),
    "wow_running": ((CTE_WOW_PRE, CTE_WOW_LAG, CTE_WOW_RUN),
                    "SELECT * EXCLUDE (actual_previous_week_cases, wow_change, wow_pct_change) FROM wow_run"),
    "mart_wow_region": ((CTE_WOW_PRE, CTE_WOW_LAG, CTE_WOW_RUN), """SELECT census_division, region_name,
        "year", quarter, season, week, week_label, mmwr_period, is_holiday_week, holiday_name,
        disease_name_short, disease_status, disease_group, disease_category, severity_or_stage,
        CAST(round(current_week_cases, 0) AS BIGINT) AS current_week_cases,
        CAST(round(actual_previous_week_cases, 0) AS BIGINT) AS actual_previous_week_cases,
        COALESCE(wow_change, 0.0) AS wow_change, COALESCE(wow_pct_change, 0.0) AS wow_pct_change,
        flagged_current_week_count,
        CAST(round(running_cumulative_cases, 0) AS BIGINT) AS running_cumulative_cases_year
      FROM wow_run"""),
}


def oracle_sql() -> dict[str, str]:
    return {key: with_ctes(*extra) + final for key, (extra, final) in SELECTS.items()}


# ---------------------------------------------------------------------------
# Ingest, seeds, quality, measures.
# ---------------------------------------------------------------------------


STAMP = 'CAST("year" AS BIGINT) * 100 + CAST(week AS BIGINT)'
INGEST_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in [
    "sort_order", "m1", "m2", "m3", "m4", "m1_flag", "m2_flag", "m3_flag", "m4_flag", "geocode_coordinates"])
NULL_SAFE_KEY = ' AND '.join(f'e.{c} IS NOT DISTINCT FROM b.{c}' for c in ['states', '"year"', 'week', 'label'])


def dedup_sql(src: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY states, \"year\", week, label "
            f"ORDER BY {INGEST_ORDER}) AS rn FROM {src}) t WHERE rn = 1")


def anti_sql(batch: str, existing: str = "existing") -> str:
    return f"SELECT * FROM ({batch}) b WHERE NOT EXISTS (SELECT 1 FROM {existing} e WHERE {NULL_SAFE_KEY})"


def after_sql(src: str, y: str, w: str) -> str:
    yy, ww = 'CAST("year" AS BIGINT)', "CAST(week AS BIGINT)"
    return f"SELECT * FROM {src} WHERE {yy} >= {y} AND ({yy} > {y} OR ({yy} = {y} AND {ww} > {w}))"


INGEST_CTES = (
    f"existing AS (SELECT * FROM raw WHERE {STAMP} <= 202440)",
    f"incoming AS (SELECT * FROM raw WHERE {STAMP} >= 202430)",
    f"""wm_log AS (SELECT CAST("year" AS BIGINT) AS "year", CAST(week AS BIGINT) AS week,
      max(l_shipdate) AS loaded_at FROM raw_x WHERE {STAMP} <= 202440 GROUP BY 1, 2)""",
    """wm_top AS (SELECT "year", week, loaded_at FROM wm_log
      ORDER BY loaded_at DESC NULLS LAST, "year" * 100 + week DESC NULLS LAST, "year" DESC NULLS LAST,
        week DESC NULLS LAST LIMIT 1)""",
)

POP_CTE = """pop AS (SELECT upper(s.v) AS state_name, CAST(2022 + c.c_custkey % 5 AS BIGINT) AS "year",
    CAST(100000 + COUNT(*) * 1000 AS BIGINT) AS population
  FROM customer c JOIN s ON c.c_custkey % 55 = s.i GROUP BY 1, 2)"""

DL_CTE = f"disease_list(disease_name) AS (VALUES {values([(n,) for n in DISEASE_LIST])})"

SQL_MODEL = {"stg_nndss_weekly": "stg", "fact_disease_cases": "fact", "dim_location": "dim_location",
             "dim_date": "dim_date", "dim_diseases": "dim_diseases", "disease_list": "disease_list"}


def lit(v) -> str:
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    return q(v) if isinstance(v, str) else str(v)


def check_sql(c) -> str:
    head = f"SELECT {q(c.name)} AS test, {q(c.severity)} AS severity, COUNT(*) AS failures"
    m, col = SQL_MODEL[c.model], c.column
    if c.kind == "not_null":
        return f"{head} FROM {m} WHERE {col} IS NULL"
    if c.kind == "unique":
        return f"{head} FROM (SELECT {col} FROM {m} WHERE {col} IS NOT NULL GROUP BY {col} HAVING COUNT(*) > 1) t"
    if c.kind == "accepted_values":
        vals = ", ".join(lit(v) for v in c.values)
        return f"{head} FROM (SELECT {col} AS v FROM {m} GROUP BY {col}) t WHERE v NOT IN ({vals})"
    p = SQL_MODEL[c.parent]
    return (f"{head} FROM {m} c WHERE c.{col} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {p} p WHERE p.{c.parent_column} = c.{col})")


# The singular tests by their own conditions; future weeks as of 2024-06-15 (Sunday weeks).
SINGULAR_SQL = [
    """SELECT 'case_count_spike', 'warn', COUNT(*) FROM stg WHERE previous_52_weeks_max > 0
        AND current_week_cases >= previous_52_weeks_max""",
    """SELECT 'future_week_rows', 'error', COUNT(*) FROM stg WHERE "year" * 100 + week >
        2024 * 100 + CAST(strftime(DATE '2024-06-15', '%U') AS BIGINT)""",
    "SELECT 'null_cases_no_flag', 'warn', COUNT(*) FROM raw WHERE m1 IS NULL AND m1_flag IS NULL",
    """SELECT 'duplicate_staging_rows', 'error', COUNT(*) FROM (SELECT 1 FROM stg
        GROUP BY state_name, "year", week, disease_name HAVING COUNT(*) > 1) d""",
]

REPORT_SQL = ("SELECT test, severity, failures, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' "
              "THEN 'warn' ELSE 'fail' END AS status FROM (\n"
              + "\nUNION ALL\n".join([*(check_sql(c) for c in DECLARED_CHECKS), *SINGULAR_SQL]) + "\n) r")

STAR_WEEKLY_OUTBREAK = ("CASE WHEN current_week_cases >= previous_52_weeks_max AND previous_52_weeks_max > 0 "
                        "THEN 1 ELSE 0 END")

SELECTS.update({
    "ingest_incremental_filter": ((), after_sql("raw", "2024", "10")),
    "ingest_backfill": (INGEST_CTES, anti_sql(dedup_sql(
        "(SELECT * FROM raw WHERE CAST(\"year\" AS BIGINT) BETWEEN 2023 AND 2025)"))),
    "ingest_flatten": ((), """SELECT states, "year", week, label, m1, m2, m3, m4, m1_flag, m2_flag, m3_flag,
        m4_flag, sort_order, CASE WHEN geocode_coordinates IS NULL THEN NULL ELSE 'Point' END AS geocode_type,
        geocode_coordinates FROM raw"""),
    "ingest_landed_files": ((), """SELECT states, "year", week, label, m1, m2, m3, m4, m1_flag, m2_flag, m3_flag,
        m4_flag, sort_order, CASE WHEN geocode_coordinates IS NULL THEN NULL ELSE 'Point' END AS geocode_type,
        geocode_coordinates FROM raw"""),
    "ingest_batch_dedup": ((), dedup_sql("raw")),
    "ingest_new_rows": (INGEST_CTES, anti_sql(dedup_sql("incoming"))),
    "watermark_latest": (INGEST_CTES, "SELECT * FROM wm_top"),
    "watermark_fallback": (INGEST_CTES, f"""SELECT COALESCE(CAST(floor(max(st) / 100) AS BIGINT), 2022) AS "year",
        COALESCE(CAST(max(st) % 100 AS BIGINT), 0) AS week FROM (SELECT {STAMP} AS st FROM existing) t"""),
    "watermark_advance": (INGEST_CTES, f"""SELECT CAST(floor(max(st) / 100) AS BIGINT) AS "year",
        CAST(max(st) % 100 AS BIGINT) AS week, TIMESTAMP '2026-12-01 00:00:00' AS loaded_at
        FROM (SELECT {STAMP} AS st FROM incoming) t HAVING max(st) IS NOT NULL"""),
    "ingest_gate": (INGEST_CTES, f"""SELECT a.available_stamp, w.watermark_stamp,
        COALESCE(a.available_stamp > w.watermark_stamp, FALSE) AS has_newer
        FROM (SELECT max({STAMP}) AS available_stamp FROM incoming) a,
             (SELECT "year" * 100 + week AS watermark_stamp FROM wm_top) w"""),
    "ingest_batch": (INGEST_CTES, anti_sql(dedup_sql(
        "(" + after_sql("incoming", '(SELECT "year" FROM wm_top)', "(SELECT week FROM wm_top)") + ")"))),
    "seed_disease_list": ((DL_CTE,), """SELECT l.disease_name, COALESCE(n.n_staging_rows, 0) AS n_staging_rows
        FROM disease_list l LEFT JOIN (SELECT disease_name, COUNT(*) AS n_staging_rows FROM stg GROUP BY 1) n
        ON l.disease_name = n.disease_name"""),
    "seed_us_holidays": ((), """SELECT CAST(h."year" AS BIGINT) AS "year", CAST(h.week AS BIGINT) AS week,
        h.holiday_name, COALESCE(n.n_staging_rows, 0) AS n_staging_rows
        FROM hol h LEFT JOIN (SELECT "year", week, COUNT(*) AS n_staging_rows FROM stg GROUP BY 1, 2) n
        ON h."year" = n."year" AND h.week = n.week"""),
    # quality
    "dq_not_null": ((), "SELECT * FROM fact WHERE disease_id IS NULL"),
    "dq_unique": ((), """SELECT location_id AS unique_field, COUNT(*) AS n_records FROM fact
        WHERE location_id IS NOT NULL GROUP BY location_id HAVING COUNT(*) > 1"""),
    "dq_accepted_values": ((), f"""SELECT * FROM (SELECT current_week_cases_flag AS value_field,
        COUNT(*) AS n_records FROM stg GROUP BY 1) t
        WHERE value_field NOT IN ({', '.join(q(v) for v in ACCEPTED_FLAGS)})"""),
    "dq_relationships": ((DL_CTE,), """SELECT c.disease_name AS from_field FROM cleaned c
        WHERE c.disease_name IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM disease_list p WHERE p.disease_name = c.disease_name)"""),
    "dq_report": ((DL_CTE,), REPORT_SQL),
    "dq_case_spike": ((), """SELECT * FROM stg WHERE current_week_cases IS NOT NULL
        AND previous_52_weeks_max IS NOT NULL AND previous_52_weeks_max > 0
        AND current_week_cases >= previous_52_weeks_max"""),
    "dq_future_weeks": ((), """SELECT * FROM stg WHERE "year" * 100 + week >
        year(DATE '2024-06-15') * 100 + CAST(strftime(DATE '2024-06-15', '%U') AS BIGINT)"""),
    "dq_null_cases_no_flag": ((), "SELECT * FROM raw WHERE m1 IS NULL AND m1_flag IS NULL"),
    "dq_duplicate_rows": ((), """SELECT state_name, "year", week, disease_name, COUNT(*) AS n_records
        FROM reportable GROUP BY 1, 2, 3, 4 HAVING COUNT(*) > 1"""),
    "dq_unmatched_fk": ((), """
        SELECT fact_id, 'location_id' AS fk_column, CAST(location_id AS VARCHAR) AS fk_value FROM fact f
          WHERE NOT EXISTS (SELECT 1 FROM dim_location d WHERE d.location_id = f.location_id)
        UNION ALL
        SELECT fact_id, 'disease_id', CAST(disease_id AS VARCHAR) FROM fact f
          WHERE NOT EXISTS (SELECT 1 FROM dim_diseases d WHERE d.disease_id = f.disease_id)
        UNION ALL
        SELECT fact_id, 'date_id', CAST(date_id AS VARCHAR) FROM fact f
          WHERE NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_id = f.date_id)"""),
    "dq_quarantine": ((), """SELECT *, CASE
        WHEN states IS NULL THEN 'missing_states' WHEN "year" IS NULL THEN 'missing_year'
        WHEN week IS NULL THEN 'missing_week' WHEN label IS NULL THEN 'missing_label'
        WHEN TRY_CAST("year" AS BIGINT) IS NULL THEN 'bad_year'
        WHEN TRY_CAST(week AS BIGINT) IS NULL THEN 'bad_week'
        WHEN m1 IS NOT NULL AND TRY_CAST(m1 AS DOUBLE) IS NULL THEN 'bad_m1'
        WHEN m2 IS NOT NULL AND TRY_CAST(m2 AS DOUBLE) IS NULL THEN 'bad_m2'
        WHEN m3 IS NOT NULL AND TRY_CAST(m3 AS DOUBLE) IS NULL THEN 'bad_m3'
        WHEN m4 IS NOT NULL AND TRY_CAST(m4 AS DOUBLE) IS NULL THEN 'bad_m4' END AS quarantine_reason
        FROM raw"""),
    "quarantine_accepted": ((), """SELECT * FROM raw WHERE m2 IS DISTINCT FROM '7'
        AND m2 IS DISTINCT FROM '8' AND states IS NOT NULL AND label IS NOT NULL"""),
    # measures
    "kpi_overview": ((), f"""SELECT SUM(current_week_cases) AS total_cases,
        COUNT(DISTINCT CASE WHEN current_week_cases > 0 THEN state_name END) AS states_reporting,
        SUM(CASE WHEN disease_name_short IN ('CHANCROID', 'CHLAMYDIA TRACHOMATIS INFECTION', 'GONORRHEA',
          'SYPHILIS') THEN current_week_cases ELSE 0.0 END) / NULLIF(SUM(current_week_cases), 0)
          AS sti_burden_rate,
        COUNT(DISTINCT disease_name_short) AS unique_diseases_tracked,
        AVG({STAR_WEEKLY_OUTBREAK}) AS outbreak_alert_rate FROM star"""),
    "kpi_category": ((), """SELECT disease_category, total_cases,
        total_cases / NULLIF(SUM(total_cases) OVER (), 0) AS case_share
        FROM (SELECT disease_category, SUM(current_week_cases) AS total_cases FROM star GROUP BY 1) t"""),
    "kpi_region": ((), """SELECT region_name, total_cases,
        total_cases / NULLIF(SUM(total_cases) OVER (), 0) AS case_share
        FROM (SELECT region_name, SUM(current_week_cases) AS total_cases FROM star GROUP BY 1) t"""),
    "kpi_yoy": ((), """SELECT c.disease_name_short, c."year", c.total_cases, p.total_cases AS previous_year_cases,
        c.total_cases - p.total_cases AS yoy_change,
        round((c.total_cases - p.total_cases) / NULLIF(p.total_cases, 0) * 100, 2) AS yoy_pct_change
        FROM (SELECT disease_name_short, "year", SUM(current_week_cases) AS total_cases FROM star GROUP BY 1, 2) c
        LEFT JOIN (SELECT disease_name_short, "year", SUM(current_week_cases) AS total_cases FROM star
          GROUP BY 1, 2) p
        ON p.disease_name_short IS NOT DISTINCT FROM c.disease_name_short AND p."year" = c."year" - 1"""),
    "kpi_volatility": ((), """SELECT disease_category, COUNT(*) AS n_weeks,
        round(AVG(weekly_cases), 6) AS mean_weekly_cases,
        round(stddev_samp(weekly_cases), 6) AS stddev_weekly_cases,
        round(stddev_samp(weekly_cases) / NULLIF(AVG(weekly_cases), 0), 6) AS coefficient_of_variation
        FROM (SELECT disease_category, "year", week, SUM(current_week_cases) AS weekly_cases FROM star
          GROUP BY 1, 2, 3) t GROUP BY 1"""),
    "kpi_per_100k": ((POP_CTE,), """SELECT c.disease_name_short, c."year", c.total_cases, p.population,
        c.total_cases * 100000 / CAST(p.population AS DOUBLE) AS cases_per_100k
        FROM (SELECT disease_name_short, "year", SUM(current_week_cases) AS total_cases FROM star GROUP BY 1, 2) c
        LEFT JOIN (SELECT "year", CAST(SUM(population) AS BIGINT) AS population FROM pop GROUP BY 1) p
        ON c."year" = p."year" """),
    "kpi_pop": ((), """SELECT *, total_cases - previous_total AS change,
        COALESCE(round((total_cases - previous_total) / NULLIF(previous_total, 0) * 100, 2), 0.0) AS pct_change
        FROM (SELECT *, COALESCE(lag(total_cases) OVER (PARTITION BY region_name, disease_group
            ORDER BY "year" ASC NULLS FIRST, quarter ASC NULLS FIRST), 0.0) AS previous_total
          FROM (SELECT region_name, disease_group, "year", quarter, SUM(current_week_cases) AS total_cases
            FROM star GROUP BY 1, 2, 3, 4) a) t"""),
})

# The surveyed name of the whole ingest; a refreshed mart equals the mart of a full build.
SELECTS["ingest_pipeline"] = SELECTS["ingest_batch"]
SELECTS.update({
    "refresh_wow": SELECTS["mart_wow_region"],
    "refresh_top5": SELECTS["mart_top5_state_quarter"],
    "refresh_season": SELECTS["mart_top_disease_season"],
    "refresh_cells": ((), f"""SELECT state_name, state_abbreviation, region_name, census_division, "year", week, mmwr_period, week_label,
        season, quarter, is_holiday_week, holiday_name, disease_name_short, disease_status, disease_group, disease_category,
        severity_or_stage, SUM(current_week_cases) AS current_week_cases, SUM(previous_52_weeks_max) AS previous_52_weeks_max,
        MAX(current_week_cases) AS largest_week_cases, CAST(SUM({STAR_WEEKLY_OUTBREAK}) AS BIGINT) AS outbreak_rows,
        COUNT(*) FILTER (WHERE current_week_cases_flag <> '-') AS counted_flag_rows,
        COUNT(*) FILTER (WHERE current_week_cases_flag IN ('U', 'N', 'NN', 'NP', 'NC')) AS season_flag_rows, COUNT(*) AS fact_rows
      FROM star GROUP BY ALL"""),
    **{f"{k}_cells": SELECTS[k] for k in ("kpi_overview", "kpi_category", "kpi_yoy", "kpi_volatility")},
})
