"""The weekly job and the backfill: load rows, rebuild what they touched, run the data tests.

The same three steps as the scheduled flow the library replaces (extract and
load, build models, test), as one Spark application that can be run again
after a failure at any point:

    spark-submit -m casewatch weekly   --landing L --raw R --watermark W --store S
    spark-submit -m casewatch backfill --landing L --raw R --watermark W --store S --years 2022 2026

A load records its years in the store before it appends, a stream in its log
beside the raw table; the build and the tests work on what is recorded there,
not on what this run loaded, and only a run whose tests passed clears it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from casewatch import schemas
from casewatch.plans import quality
from casewatch.plans.ingest import IngestResult, ingest_batch
from casewatch.plans.refresh import read_manifest, refresh_models
from casewatch.session import apply_scale_conf
from casewatch.sources import loads, pending
from casewatch.sources.seeds import load_seeds
from casewatch.sources.tables import table_exists


@dataclass
class WeeklyResult:
    ingest: IngestResult
    models: dict[str, DataFrame] | None
    report: DataFrame | None


def weekly_run(spark: SparkSession, landing: str, raw_path: str, wm_path: str, store: str,
               loaded_at: dt.datetime | None = None, land_base: str | None = None,
               raise_on_error: bool = True, multi_line: bool | None = None,
               disease_path: str | None = None, holidays_path: str | None = None,
               season_years: tuple[int, int] | None = None, as_of: dt.date | None = None,
               rejects_path: str | None = None, backfill: tuple[int, int] | None = None) -> WeeklyResult:
    """Load, refresh the pending years, then run the declared and the singular data tests.

    Nothing is rebuilt when no year is pending and the store is complete.
    Error-severity test failures raise (after the report is computed) unless
    raise_on_error is False; warnings are only reported. A failed test leaves its
    years pending, so the next run tests them again. `as_of` (default: today, UTC) is the day
    that future weeks are counted from; `backfill` loads that range of years instead of the newest weeks.
    """
    result = ingest_batch(spark, landing, raw_path, wm_path, loaded_at, land_base, multi_line, rejects_path,
                          on_years=lambda years: pending.record(spark, store, years), backfill=backfill)
    marks = pending.marks(spark, store)
    streamed = loads.unbuilt(spark, raw_path, store)
    complete = read_manifest(spark, store) is not None
    if complete and not marks and not streamed or not table_exists(spark, raw_path):
        return WeeklyResult(result, None, None)
    seeds = load_seeds(spark, disease_path, holidays_path)
    raw = spark.read.schema(schemas.RAW).parquet(raw_path)
    years = sorted({*pending.years(spark, marks), *loads.years(spark, raw_path, streamed)})
    models = refresh_models(raw, store, years=years if complete else None,
                            holidays=seeds["us_holidays"] if holidays_path else None, season_years=season_years)
    report = test_report(models, seeds["disease_list"], raw, as_of or dt.datetime.now(dt.timezone.utc).date())
    if raise_on_error:
        quality.raise_on_errors(report)
    pending.clear(spark, marks)
    loads.mark_built(spark, store, streamed)
    return WeeklyResult(result, models, report)


def test_report(models: dict[str, DataFrame], diseases: DataFrame, raw: DataFrame, as_of: dt.date) -> DataFrame:
    """The declared tests on the stored models, and the singular ones, as one report."""
    checked = {k: models[k] for k in ("stg_nndss_weekly", "dim_location", "dim_date", "dim_diseases", "fact_disease_cases")}
    # written dimensions are counted from Parquet metadata
    parent_rows = {k: models[k].count() for k in ("dim_location", "dim_date", "dim_diseases")}
    report = quality.dq_report({**checked, "disease_list": diseases}, parent_rows=parent_rows)
    return report.unionByName(quality.singular_report(models["stg_nndss_weekly"], raw, as_of))


test_report.__test__ = False  # a name for the job's step, not a pytest case


def main(argv: list[str] | None = None) -> int:
    import argparse
    p = argparse.ArgumentParser(prog="casewatch")
    sub = p.add_subparsers(dest="cmd", required=True)
    weekly = sub.add_parser("weekly", help="ingest landed files, refresh pending years, run data tests")
    back = sub.add_parser("backfill", help="the same, loading weeks 1-53 of a range of years")
    back.add_argument("--years", type=int, nargs=2, required=True, metavar=("FIRST", "LAST"))
    for w in (weekly, back):
        w.add_argument("--landing", required=True)
        w.add_argument("--raw", required=True)
        w.add_argument("--watermark", required=True)
        w.add_argument("--store", required=True)
        w.add_argument("--rejects", default=None, help="table of records that cannot be loaded (default: RAW-rejects)")
        w.add_argument("--land-copy", default=None, help="folder for the dated JSON copy of each load")
        w.add_argument("--json-lines", action="store_true", help="landed files hold JSON lines (default: decided for each file)")
        w.add_argument("--disease-list", default=None, help="CSV in place of the built-in disease names")
        w.add_argument("--holidays", default=None, help="CSV in place of the built-in holiday weeks")
        w.add_argument("--season-years", type=int, nargs=2, default=None, metavar=("FIRST", "LAST"))
        w.add_argument("--as-of", type=dt.date.fromisoformat, default=None, help="day that future weeks are counted from")
        w.add_argument("--warn-only", action="store_true", help="report failing error-severity tests, do not fail")
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"casewatch-{args.cmd}").getOrCreate()
    apply_scale_conf(spark)  # AQE, skew joins, partition sizes: only where the cluster left them unset
    out = weekly_run(spark, args.landing, args.raw, args.watermark, args.store,
                     land_base=args.land_copy, raise_on_error=not args.warn_only,
                     multi_line=False if args.json_lines else None, disease_path=args.disease_list,
                     holidays_path=args.holidays, season_years=tuple(args.season_years) if args.season_years else None,
                     as_of=args.as_of, rejects_path=args.rejects,
                     backfill=tuple(args.years) if args.cmd == "backfill" else None)
    print(f"ingest: {out.ingest}")
    if out.report is not None:
        for r in out.report.where("status != 'pass'").collect():
            print(f"{r.status}: {r.test} ({r.failures})")
    return 0
