"""Physical-plan shape: the properties the design relies on at scale."""

import re

from pyspark.sql import functions as F

from casewatch import queries as Q
from casewatch.plans import build, facts, marts, quality
from casewatch.session import scratch_path
from casewatch.sources.adapter import raw_from_lineitem


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_staging_dedup_limits_before_the_shuffle(spark, sf_small):
    p = plan(Q.stg(spark, sf_small))
    assert "WindowGroupLimit" in p and "Partial" in p  # map-side keep-first


def test_fact_is_a_projection_of_staging(spark, sf_small):
    p = plan(facts.fact_disease_cases(Q.stg(spark, sf_small)))
    assert "Join" not in p


def test_star_broadcasts_dimensions(spark, sf_small):
    p = plan(Q.star_of(spark, sf_small))
    assert len(re.findall("BroadcastHashJoin", p)) >= 3 and "SortMergeJoin" not in p


def test_top5_rank_filter_pushed_into_window(spark, sf_small):
    assert "WindowGroupLimit" in plan(marts.top_diseases(Q.star_of(spark, sf_small)))


def test_wow_running_total_reuses_lag_window_layout(spark, sf_small):
    p = plan(marts.week_over_week(Q.star_of(spark, sf_small)))
    window_part = p[p.index("Window"):]
    # one shuffle feeds both windows: no exchange between the two Window operators
    first, second = [m.start() for m in re.finditer(r"\bWindow \[", window_part)][:2]
    assert "Exchange" not in window_part[first:second]


def test_report_has_the_declared_and_the_singular_checks(spark, sf_small):
    rows = {r.test: r for r in Q.q_dq_report(spark, sf_small).collect()}
    assert len(quality.DECLARED_CHECKS) == 60 and len(rows) == 60 + len(quality.SINGULAR_CHECKS)
    assert rows["future_week_rows"].status == "fail" and rows["case_count_spike"].status == "warn"
    assert rows["accepted_values_stg_nndss_weekly_current_week_cases_flag"].status == "fail"  # '-' flag
    assert rows["not_null_fact_disease_cases_disease_id"].status == "warn"  # ASSOCIATED names
    assert rows["unique_fact_disease_cases_fact_id"].failures == 0


def test_materialised_build_equals_lazy_build(spark, sf_small):
    raw = raw_from_lineitem(spark, sf_small)
    lazy = build.build_models(raw)
    stored = build.build_models(raw, materialize=True, root=scratch_path(spark, "test-build"))
    for k in ("agg_top5_diseases_per_state_year_quarter", "agg_week_over_week_change_by_region_week_year"):
        assert lazy[k].exceptAll(stored[k]).count() == 0 and stored[k].exceptAll(lazy[k]).count() == 0


def _scan_lines(df):
    return [l for l in plan(df).split("\n") if "FileScan" in l]


def test_raw_table_pruning(spark, sf_small):
    import tempfile
    from casewatch import schemas
    from casewatch.plans import dims, ingest, staging
    from casewatch.sources.tables import append_raw
    d = tempfile.mkdtemp(prefix="casewatch-prune-")
    append_raw(raw_from_lineitem(spark, sf_small), f"{d}/raw")
    raw = spark.read.schema(schemas.RAW).parquet(f"{d}/raw")
    scan = _scan_lines(ingest.rows_after(raw, 2024, 10))[0]
    assert "PartitionFilters: [isnotnull(year" in scan and ">= 2024" in scan  # year partitions skipped
    batch = raw.where((F.col("year") == "2024") & (F.col("week").isin("41", "42")))
    kept = ingest.restrict_to_batch_weeks(raw, batch)
    assert "dynamicpruning#" in plan(kept)  # year and week of the batch, found at run time
    assert kept.select("year", "week").distinct().count() == 2
    full = dict(zip(("rows", "files"), (raw.count(), len(raw.inputFiles())), strict=True))
    assert full["files"] > 8 and kept.count() < full["rows"]
    scan = _scan_lines(dims.dim_location(staging.reportable(raw)))[0]
    assert "ReadSchema: struct<states:string,label:string>" in scan  # two columns read
    assert "IsNotNull(states)" in scan and "IsNotNull(label)" in scan  # pushed to the reader
