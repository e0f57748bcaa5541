"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All of them start from the test tables (raw rows derived from `lineitem`),
"""

from __future__ import annotations

import datetime as _dt
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.functions import lookup, match_first, norm_disease, short_name, surrogate_key, week_stamp
from casewatch.operators import advance_watermark, has_newer, latest_watermark, watermark_from_raw
from casewatch.plans import dims, ingest, kpis, marts, quality, staging
from casewatch.plans.dims import dim_date, dim_diseases, dim_location
from casewatch.plans.facts import fact_disease_cases
from casewatch.plans.marts import star
from casewatch.plans.refresh import MART_SEASON, MART_TOP5, MART_WOW, open_models, read_manifest, refresh_models
from casewatch.reference_data import (
    ACCEPTED_FLAGS, DISEASE_CATEGORY_RULES, DISEASE_LIST, DISEASE_DEMOGRAPHIC_RULES, DISEASE_DETECTION_RULES,
    DISEASE_GROUP_PREFIX_RULES, DISEASE_SEVERITY_RULES, DISEASE_STATUS_RULES, DISEASE_SUBTYPE_RULES,
    STATE_DIVISION, US_HOLIDAYS,
)
from casewatch.session import checkpoint_root, scratch_path
from casewatch.sources.adapter import ADAPTER_STATES, input_key, pick, raw_from_lineitem
from casewatch.sources.files import exists
from casewatch.sources.landing import flatten, read_landed, unflatten
from casewatch.sources.seeds import disease_list, us_holidays

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ---- shared model chain -------------------------------------------------------

def raw(spark, sf):
    return raw_from_lineitem(spark, sf)


def stg(spark, sf):
    return staging.stage_weekly(raw(spark, sf))


def grain_rows(spark, sf):
    """Rows with the same distinct grain values as staging, without its dedup."""
    return staging.reportable(raw(spark, sf))


def dimensions(spark, sf):
    g = grain_rows(spark, sf)
    return stg(spark, sf), dim_location(g), dim_date(g, us_holidays(spark), len(US_HOLIDAYS)), dim_diseases(g)


_STORE_LOCK = threading.Lock()
_STORES: dict[str, dict] = {}


def stored_models(spark, sf):
    """The model store of `sf`, built once per input and application.

    Marts, measures and multi-model checks read stored models, as the marts
    of the source pipeline read its dimension and fact tables. The build is
    `refresh_models` (timed on its own in bench.py); the fact is a projection
    of the stored staging.
    """
    key = input_key(spark, sf)
    store = f"{checkpoint_root(spark).rstrip('/')}/casewatch/models-{key}"
    with _STORE_LOCK:
        if key not in _STORES:
            m = refresh_models(raw(spark, sf), store) if read_manifest(spark, store) is None else open_models(spark, store)
            _STORES[key] = {
                "models": m,
                "bounds": {k: m[k].count() for k in ("dim_location", "dim_date", "dim_diseases")},
            }
        return _STORES[key]


def star_of(spark, sf):
    st = stored_models(spark, sf)
    m = st["models"]
    return star(m["fact_disease_cases"], m["dim_location"], m["dim_diseases"], m["dim_date"], st["bounds"])


# ---- staging ----------------------------------------------------------------

@query("stg_masking")
def q_stg_masking(spark, sf):
    return staging.clean_weekly(raw(spark, sf)).select("sort_order_masked", "longitude_masked", "latitude_masked")


@query("stg_state_region")
def q_stg_state_region(spark, sf):
    per_state = raw(spark, sf).groupBy("states").agg(F.count(F.lit(1)).alias("n_rows"))
    return per_state.select("states", staging.state_name().alias("state_name"),
                            lookup(staging.state_name(), STATE_DIVISION).alias("region_name"), "n_rows")


@query("stg_disease_name")
def q_stg_disease_name(spark, sf):
    return (raw(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))
            .select("label", norm_disease("label").alias("disease_name"), "n_rows"))


@query("stg_measures")
def q_stg_measures(spark, sf):
    c = staging.clean_weekly(raw(spark, sf))
    return c.select("current_week_cases", "previous_52_weeks_max", "cumulative_ytd_cases",
                    "previous_year_cumulative", "current_week_cases_flag", "previous_52_weeks_max_flag",
                    "cumulative_ytd_cases_flag", "previous_year_cumulative_flag")


@query("stg_filters")
def q_stg_filters(spark, sf):
    return staging.keep_reportable(staging.clean_weekly(raw(spark, sf)))


@query("stg_dedup")
def q_stg_dedup(spark, sf):
    s = staging.dedup_grain(staging.keep_reportable(staging.clean_weekly(raw(spark, sf))))
    return s.select("state_name", "year", "week", "disease_name", "sort_order_masked")


@query("stg_nndss_weekly")
def q_stg(spark, sf):
    return stg(spark, sf)


# ---- dimensions -------------------------------------------------------------

@query("surrogate_key")
def q_surrogate_key(spark, sf):
    return stg(spark, sf).select(
        surrogate_key("state_name", "disease_name", "year", "week").alias("fact_id"),
        surrogate_key("state_name").alias("location_id"),
        surrogate_key("disease_name").alias("disease_id"),
        "state_name", "disease_name", "year", "week",
    )


@query("dim_location")
def q_dim_location(spark, sf):
    return dim_location(grain_rows(spark, sf))


def _spine(spark, sf):
    return grain_rows(spark, sf).select("year", "week").distinct()


@query("dim_date_labels")
def q_dim_date_labels(spark, sf):
    return _spine(spark, sf).select(*dims.date_attributes(F.col("year"), F.col("week"))[:5])


@query("dim_date_buckets")
def q_dim_date_buckets(spark, sf):
    a = dims.date_attributes(F.col("year"), F.col("week"))
    return _spine(spark, sf).select(a[1], a[2], *a[5:])


@query("dim_date_holidays")
def q_dim_date_holidays(spark, sf):
    return dims.with_holidays(_spine(spark, sf), us_holidays(spark), len(US_HOLIDAYS))


@query("dim_date")
def q_dim_date(spark, sf):
    return dim_date(grain_rows(spark, sf), us_holidays(spark), len(US_HOLIDAYS))


def _names(spark, sf):
    return grain_rows(spark, sf).select("disease_name").distinct()


def _attr_query(name, col_fn):
    def fn(spark, sf):
        return _names(spark, sf).select("disease_name", col_fn(F.col("disease_name")).alias(name))
    return fn



REGISTRY["disease_status"] = _attr_query("disease_status", lambda c: match_first(c, DISEASE_STATUS_RULES))
REGISTRY["disease_demographic"] = _attr_query("target_demographic", lambda c: match_first(c, DISEASE_DEMOGRAPHIC_RULES))
REGISTRY["disease_category"] = _attr_query("disease_category", lambda c: match_first(c, DISEASE_CATEGORY_RULES))
REGISTRY["disease_severity"] = _attr_query("severity_or_stage", lambda c: match_first(c, DISEASE_SEVERITY_RULES))
REGISTRY["disease_subtype"] = _attr_query("pathogen_subtype", lambda c: match_first(c, DISEASE_SUBTYPE_RULES))
REGISTRY["disease_detection"] = _attr_query("detection_method", lambda c: match_first(c, DISEASE_DETECTION_RULES))
REGISTRY["disease_group"] = _attr_query("disease_group",
                                        lambda c: match_first(c, DISEASE_GROUP_PREFIX_RULES, kind="prefix"))
REGISTRY["disease_name_short"] = _attr_query("disease_name_short", short_name)


@query("dim_diseases")
def q_dim_diseases(spark, sf):
    return dim_diseases(grain_rows(spark, sf))


# ---- fact and marts -----------------------------------------------------------

@query("fact_disease_cases")
def q_fact(spark, sf):
    return fact_disease_cases(stg(spark, sf))


@query("mart_star")
def q_star(spark, sf):
    return star_of(spark, sf)


@query("top5_aggregate")
def q_top5_aggregate(spark, sf):
    return marts.top5_aggregate(star_of(spark, sf))


@query("mart_top5_state_quarter")
def q_top5(spark, sf):
    return marts.top_diseases(star_of(spark, sf))


@query("outbreak_flag")
def q_outbreak_flag(spark, sf):
    return star_of(spark, sf).select("fact_id", "current_week_cases", "previous_52_weeks_max",
                                     marts.is_outbreak().alias("is_outbreak_week"))


@query("season_aggregate")
def q_season_aggregate(spark, sf):
    return marts.season_aggregate(star_of(spark, sf))


@query("mart_top_disease_season")
def q_season(spark, sf):
    return marts.season_ranking(star_of(spark, sf))


@query("wow_preagg")
def q_wow_preagg(spark, sf):
    return marts.wow_preagg(star_of(spark, sf))


@query("wow_lag")
def q_wow_lag(spark, sf):
    return marts.wow_lag(marts.wow_preagg(star_of(spark, sf)))


@query("wow_running")
def q_wow_running(spark, sf):
    return marts.wow_running(marts.wow_preagg(star_of(spark, sf)))


@query("mart_wow_region")
def q_wow(spark, sf):
    return marts.week_over_week(star_of(spark, sf))


# ---- ingest -------------------------------------------------------------------
# Incoming and existing batches are cut from the same raw rows by week stamp,
# with an overlap (FIXTURES.md): existing = stamp <= 202440, incoming = stamp >= 202430.


EXISTING_UNTIL, INCOMING_FROM = 202440, 202430
FILTER_AFTER = (2024, 10)
BACKFILL_RANGE = (2023, 2025)
ADVANCE_LOADED_AT = "2026-12-01 00:00:00"
FUTURE_AS_OF = _dt.date(2024, 6, 15)


def existing_rows(spark, sf):
    return raw(spark, sf).where(week_stamp("year", "week") <= EXISTING_UNTIL)


def incoming_rows(spark, sf):
    return raw(spark, sf).where(week_stamp("year", "week") >= INCOMING_FROM)


def watermark_log(spark, sf):
    """One watermark row per loaded week of the existing rows, stamped with the
    latest ship date of that week's rows (so load order differs from week order)."""
    r = raw_from_lineitem(spark, sf, keep_shipdate=True).where(week_stamp("year", "week") <= EXISTING_UNTIL)
    return r.groupBy(F.col("year").cast("long").alias("year"), F.col("week").cast("long").alias("week")) \
        .agg(F.max("l_shipdate").alias("loaded_at"))


@query("ingest_incremental_filter")
def q_ingest_filter(spark, sf):
    return ingest.rows_after(raw(spark, sf), *FILTER_AFTER)


@query("ingest_backfill")
def q_ingest_backfill(spark, sf):
    return ingest.backfill_rows(raw(spark, sf), existing_rows(spark, sf), *BACKFILL_RANGE)


def nested_raw(spark, sf):
    r = raw(spark, sf)
    geo = F.when(F.col("geocode_coordinates").isNull(), F.lit(None)).otherwise(
        F.struct(F.lit("Point").alias("type"), F.col("geocode_coordinates").alias("coordinates")))
    return r.select(*[c for c in r.columns if c != "geocode_coordinates"], geo.alias("geocode"))


@query("ingest_flatten")
def q_ingest_flatten(spark, sf):
    return flatten(nested_raw(spark, sf))


#: Records of one compressed landed file at most. Such a file is not cut into byte ranges, and a task reads as many of them as
#: their sizes, with openCostInBytes (4 MB) each, allow: at this bound about as many records as in a plain range of 128 MB.
LANDED_PAGE = 20_000


def landed_files(spark, sf):
    """The raw rows as a landing folder of three layouts: JSON lines, arrays, pretty-printed records.

    The text is by far the most that the query writes. Lines and pretty-printed records are landed compressed, in files
    of LANDED_PAGE records at most; the arrays, whose lines may be long, are plain text, read in byte ranges.
    """
    path = f"{checkpoint_root(spark).rstrip('/')}/casewatch/landed-{input_key(spark, sf)}"
    with _STORE_LOCK:
        if not exists(spark, f"{path}/_SUCCESS"):
            rows = unflatten(raw(spark, sf).withColumn("geocode_type", F.when(F.col("geocode_coordinates").isNotNull(), "Point")))
            record = F.struct(*rows.columns)
            part = F.pmod(F.xxhash64("sort_order"), F.lit(3))
            arrays = rows.where(part == 1).groupBy("year", "week", "states").agg(  # one array a line
                F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(record)), ", "), F.lit("]")).alias("value"))
            pages = {"compression": "gzip", "maxRecordsPerFile": LANDED_PAGE}
            rows.where(part == 0).select(F.to_json(record).alias("value")).write.mode("overwrite").options(**pages).text(path)
            arrays.select("value").write.mode("append").text(path)
            rows.where(part == 2).select(F.to_json(record, {"pretty": "true"}).alias("value")).write.mode("append").options(**pages).text(path)
    return path


@query("ingest_landed_files")
def q_ingest_landed_files(spark, sf):
    return flatten(read_landed(spark, landed_files(spark, sf)))


@query("ingest_batch_dedup")
def q_ingest_dedup(spark, sf):
    return ingest.dedup_batch(raw(spark, sf))


@query("ingest_new_rows")
def q_ingest_new_rows(spark, sf):
    return ingest.new_rows(incoming_rows(spark, sf), existing_rows(spark, sf))


@query("watermark_latest")
def q_watermark_latest(spark, sf):
    return latest_watermark(watermark_log(spark, sf))


@query("watermark_fallback")
def q_watermark_fallback(spark, sf):
    return watermark_from_raw(existing_rows(spark, sf))


@query("watermark_advance")
def q_watermark_advance(spark, sf):
    return advance_watermark(incoming_rows(spark, sf), F.lit(ADVANCE_LOADED_AT).cast("timestamp_ntz"))


@query("ingest_gate")
def q_ingest_gate(spark, sf):
    y, w = ingest.current_watermark(watermark_log(spark, sf), existing_rows(spark, sf))
    return has_newer(incoming_rows(spark, sf), y, w)


@query("ingest_batch")
def q_ingest_batch(spark, sf):
    return ingest.plan_batch(incoming_rows(spark, sf), existing_rows(spark, sf), watermark_log(spark, sf))[3]


# The surveyed name of the same result.
REGISTRY["ingest_pipeline"] = REGISTRY["ingest_batch"]


_REFRESHED: dict[str, dict] = {}


def late_refresh(spark, sf):
    """A store built without a third of the weeks of a middle year, then refreshed for that year."""
    key = input_key(spark, sf)
    with _STORE_LOCK:
        if key not in _REFRESHED:
            rows, store = raw(spark, sf), scratch_path(spark, "refresh-late")
            late = (F.col("year") == "2024") & (F.col("week").cast("long") % 3 == 0)
            refresh_models(rows.where(~late), store)
            _REFRESHED[key] = refresh_models(rows, store, years=[2024])
        return _REFRESHED[key]


@query("refresh_wow")
def q_refresh_wow(spark, sf):
    """The refreshed mart must equal a full build, with previous weeks of later years taken anew."""
    return late_refresh(spark, sf)[MART_WOW]


@query("refresh_top5")
def q_refresh_top5(spark, sf):
    """The top-5 mart added up from the stored cells of the touched year."""
    return late_refresh(spark, sf)[MART_TOP5]


@query("refresh_season")
def q_refresh_season(spark, sf):
    """The season mart added up from the stored cells of the touched year."""
    return late_refresh(spark, sf)[MART_SEASON]


@query("refresh_cells")
def q_refresh_cells(spark, sf):
    """The stored cells after a refresh of one year."""
    return late_refresh(spark, sf)["star_cells"]


@query("seed_disease_list")
def q_seed_disease_list(spark, sf):
    per = stg(spark, sf).groupBy(F.col("disease_name").alias("__n")).agg(F.count(F.lit(1)).alias("n_staging_rows"))
    seed = disease_list(spark)
    return seed.join(per, F.col("disease_name") == F.col("__n"), "left").select(
        "disease_name", F.coalesce("n_staging_rows", F.lit(0)).alias("n_staging_rows"))


@query("seed_us_holidays")
def q_seed_us_holidays(spark, sf):
    per = stg(spark, sf).groupBy(F.col("year").alias("__y"), F.col("week").alias("__w")) \
        .agg(F.count(F.lit(1)).alias("n_staging_rows"))
    h = us_holidays(spark)
    return h.join(per, (F.col("year") == F.col("__y")) & (F.col("week") == F.col("__w")), "left").select(
        "year", "week", "holiday_name", F.coalesce("n_staging_rows", F.lit(0)).alias("n_staging_rows"))


# ---- data quality -------------------------------------------------------------

def models_of(spark, sf):
    """Stored staging, dims and fact (see `stored_models`) plus the disease seed."""
    m = stored_models(spark, sf)["models"]
    keep = ("stg_nndss_weekly", "dim_location", "dim_date", "dim_diseases", "fact_disease_cases")
    return {**{k: m[k] for k in keep}, "disease_list": disease_list(spark)}


@query("dq_not_null")
def q_dq_not_null(spark, sf):
    return quality.not_null(fact_disease_cases(stg(spark, sf)), "disease_id")


@query("dq_unique")
def q_dq_unique(spark, sf):
    return quality.unique(fact_disease_cases(stg(spark, sf)), "location_id")


@query("dq_accepted_values")
def q_dq_accepted_values(spark, sf):
    return quality.accepted_values(stg(spark, sf), "current_week_cases_flag", ACCEPTED_FLAGS)


@query("dq_relationships")
def q_dq_relationships(spark, sf):
    cleaned = staging.clean_weekly(raw(spark, sf))
    return quality.relationships(cleaned, "disease_name", disease_list(spark), "disease_name")


@query("dq_report")
def q_dq_report(spark, sf):
    m = models_of(spark, sf)
    bounds = {**stored_models(spark, sf)["bounds"], "disease_list": len(DISEASE_LIST)}
    declared = quality.dq_report(m, parent_rows=bounds)
    return declared.unionByName(quality.singular_report(m["stg_nndss_weekly"], raw(spark, sf), FUTURE_AS_OF))


@query("dq_case_spike")
def q_dq_case_spike(spark, sf):
    return quality.case_spikes(stg(spark, sf))


@query("dq_future_weeks")
def q_dq_future_weeks(spark, sf):
    return quality.future_weeks(stg(spark, sf), FUTURE_AS_OF)


@query("dq_null_cases_no_flag")
def q_dq_null_cases(spark, sf):
    return quality.null_cases_no_flag(raw(spark, sf))


@query("dq_duplicate_rows")
def q_dq_duplicate_rows(spark, sf):
    return quality.duplicate_rows(staging.keep_reportable(staging.clean_weekly(raw(spark, sf))))


@query("dq_unmatched_fk")
def q_dq_unmatched_fk(spark, sf):
    m = models_of(spark, sf)
    return quality.unmatched_fk(m["fact_disease_cases"], m)


@query("dq_quarantine")
def q_dq_quarantine(spark, sf):
    r = raw(spark, sf)
    return r.withColumn("quarantine_reason", quality.quarantine_reason(r))


@query("quarantine_accepted")
def q_quarantine_accepted(spark, sf):
    """The rows that pass, of raw rows with some years and counts made unreadable."""
    r = raw(spark, sf)
    broken = r.withColumn("year", F.when(F.col("m2") == "7", F.concat("year", F.lit("x"))).otherwise(F.col("year"))) \
        .withColumn("m1", F.when(F.col("m2") == "8", F.lit("n/a")).otherwise(F.col("m1")))
    return quality.quarantine(broken)[0]


# ---- dashboard measures -------------------------------------------------------

def population_of(spark, sf):
    """A population table derived from `customer`: customers map onto the
    adapter's jurisdictions and years like lineitem rows do; each state-year
    gets 100,000 people plus 1,000 per mapped customer. Rows for the four
    non-state jurisdictions are kept; they never meet a case row."""
    c = spark.read.parquet(f"{sf}/customer.parquet")
    keyed = c.select(F.upper(pick(ADAPTER_STATES, F.col("c_custkey"))).alias("state_name"),
                     (F.lit(2022) + F.col("c_custkey") % 5).cast("long").alias("year"))
    return keyed.groupBy("state_name", "year").agg(
        (F.lit(100000) + F.count(F.lit(1)) * 1000).cast("long").alias("population"))


@query("kpi_overview")
def q_kpi_overview(spark, sf):
    return kpis.kpi_overview(star_of(spark, sf))


@query("kpi_category")
def q_kpi_category(spark, sf):
    return kpis.share_by(star_of(spark, sf), "disease_category")


@query("kpi_region")
def q_kpi_region(spark, sf):
    return kpis.share_by(star_of(spark, sf), "region_name")


@query("kpi_yoy")
def q_kpi_yoy(spark, sf):
    return kpis.year_over_year(star_of(spark, sf))


@query("kpi_volatility")
def q_kpi_volatility(spark, sf):
    return kpis.volatility(star_of(spark, sf))


@query("kpi_per_100k")
def q_kpi_per_100k(spark, sf):
    return kpis.per_100k(star_of(spark, sf), population_of(spark, sf))


@query("kpi_pop")
def q_kpi_pop(spark, sf):
    return kpis.period_over_period(star_of(spark, sf), ["region_name", "disease_group"], ["year", "quarter"])


# ---- the same measures from the stored cells, without the star -------------------

def cells_of(spark, sf):
    return stored_models(spark, sf)["models"]["star_cells"]


@query("kpi_overview_cells")
def q_kpi_overview_cells(spark, sf):
    return kpis.overview_of_cells(cells_of(spark, sf))


@query("kpi_category_cells")
def q_kpi_category_cells(spark, sf):
    return kpis.share_by(cells_of(spark, sf), "disease_category")


@query("kpi_yoy_cells")
def q_kpi_yoy_cells(spark, sf):
    return kpis.year_over_year(cells_of(spark, sf))


@query("kpi_volatility_cells")
def q_kpi_volatility_cells(spark, sf):
    return kpis.volatility(cells_of(spark, sf))
