"""The weekly job can be run again after a failure at any point."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from casewatch import jobs, schemas
from casewatch.plans import ingest, refresh
from casewatch.plans.build import build_models
from casewatch.plans.refresh import MART_TOP5, MART_WOW, read_manifest
from casewatch.sources import land_raw, pending, read_landed
from casewatch.sources.landing import flatten
from casewatch.sources.tables import append_raw
from casewatch.streaming import start_landing_stream

AS_OF = dt.date(2026, 6, 1)


class Died(Exception):
    pass


def rec(states, year, week, label="Mumps", m1="1", flag=None):
    return {"states": states, "year": year, "week": week, "label": label, "m1": m1, "m2": "9", "m3": "9", "m4": "1", "m1_flag": flag,
            "m2_flag": None, "m3_flag": None, "m4_flag": None, "sort_order": f"{year}-{week}-{states}", "geocode": {"type": "Point", "coordinates": [-90.5, 40.25]}}


class Flow:
    def __init__(self, spark):
        self.spark, self.root = spark, tempfile.mkdtemp(prefix="casewatch-job-")
        os.makedirs(f"{self.root}/landing")

    def land(self, name, text):
        with open(f"{self.root}/landing/{name}", "w") as fh:
            fh.write(text if isinstance(text, str) else json.dumps(text))

    def run(self, **options):
        r = self.root
        return jobs.weekly_run(self.spark, f"{r}/landing", f"{r}/raw", f"{r}/wm", f"{r}/store", as_of=AS_OF, **options)

    def raw(self):
        return self.spark.read.schema(schemas.RAW).parquet(f"{self.root}/raw")

    def assert_whole(self):
        got, want = refresh.open_models(self.spark, f"{self.root}/store"), build_models(self.raw(), materialize=True)
        for k in ("stg_nndss_weekly", MART_TOP5, MART_WOW):
            assert sorted(got[k].select(*want[k].columns).collect(), key=str) == sorted(want[k].collect(), key=str), k
        assert pending.marks(self.spark, f"{self.root}/store") == []


@pytest.fixture
def flow(spark):
    f = Flow(spark)
    f.land("a.json", [rec("Ohio", "2024", "1"), rec("Iowa", "2024", "2")])
    return f


@pytest.fixture
def quick(monkeypatch, spark):
    """Runs whose data tests pass, without the time the 64 tests take."""
    monkeypatch.setattr(jobs, "test_report", lambda *a: spark.createDataFrame([], "test string, severity string, failures long, status string"))


def die(*args, **kwargs):
    raise Died


@pytest.mark.parametrize("at", ["watermark", "refresh"])
def test_run_again_after_a_failed_later_run(flow, quick, monkeypatch, at):
    """(a) after the append, before the watermark; (b) after the watermark, before the refresh."""
    flow.run()
    flow.land("b.json", [rec("Ohio", "2025", "3", m1="5")])
    with monkeypatch.context() as m, pytest.raises(Died):
        m.setattr(*((ingest, "write_watermark") if at == "watermark" else (jobs, "refresh_models")), die)
        flow.run()
    out = flow.run()
    assert out.models is not None and out.ingest.appended_rows == 0 and flow.raw().count() == 3
    flow.assert_whole()
    assert flow.run().models is None  # nothing pending any more


def test_an_interrupted_first_build_is_not_complete(flow, quick, monkeypatch):
    """(c) after staging in the first build; the next run brings another year."""
    with monkeypatch.context() as m, pytest.raises(Died):
        m.setattr(refresh, "dim_location", die)
        flow.run()
    assert read_manifest(flow.spark, f"{flow.root}/store") is None
    flow.land("b.json", [rec("Ohio", "2025", "3")])
    flow.run()
    flow.assert_whole()


def test_a_failed_data_test_fails_again(flow):
    """(d) the '-' flag is not accepted: the run raises until it is let pass."""
    flow.land("a.json", [rec("Ohio", "2024", "1", flag="-")])
    for _ in range(2):
        with pytest.raises(AssertionError):
            flow.run()
    assert flow.run(raise_on_error=False).report.where("status = 'fail'").count() == 1
    assert flow.run().models is None  # accepted: nothing pending any more


def test_a_future_week_fails_the_run(flow):
    flow.land("a.json", [rec("Ohio", "2031", "40")])
    with pytest.raises(AssertionError, match="future_week_rows"):
        flow.run()


def test_no_landed_record_is_lost_in_silence(flow, quick):
    whole = json.dumps([rec("Ohio", "2024", "3"), rec("Utah", "2024", "4")])
    flow.land("b.json", whole[:-40])  # a truncated array
    flow.land("c.json", [rec("Ohio", "20x4", "1"), rec("Ohio", "2024", "5", m1="n/a"), rec("Utah", "2024", "6")])
    out = flow.run()
    rejects = flow.spark.read.parquet(f"{flow.root}/raw-rejects").collect()
    assert sorted(r.reason for r in rejects if r.landed_file.endswith("c.json")) == ["bad_m1", "bad_year"]
    assert {r.reason for r in rejects if r.landed_file.endswith("b.json")} == {"malformed_json"}
    assert out.ingest.rejected_rows == len(rejects) and flow.raw().where("week = '6'").count() == 1
    assert flow.run().ingest.rejected_rows == 0  # read again, stored once
    flow.assert_whole()


def open_reasons(flow):
    path = f"{flow.root}/raw-rejects"
    return sorted(r.reason for r in flow.spark.read.parquet(path).join(ingest.open_rejects(flow.spark, path), "reject_id", "left_semi")
                  .dropDuplicates(["reject_id"]).collect())


def test_a_repaired_record_is_loaded_behind_the_watermark(flow, quick, monkeypatch):
    rows = [rec("Ohio", "2024", "3"), rec("Utah", "2024", "4"), rec("Utah", "2024", "5", m1="n/a")]
    whole = json.dumps(rows[:2])
    flow.land("b.json", whole[:-40])
    flow.land("c.json", rows[2:])
    flow.land("d.json", [rec("Ohio", "2024", "9")])
    flow.run()
    n_bad = len(open_reasons(flow))
    assert {"bad_m1", "malformed_json"} == set(open_reasons(flow))
    flow.land("b.json", whole)  # its weeks are behind the watermark now

    def died(*_):
        raise Died
    with monkeypatch.context() as m:  # between the append and the closing
        m.setattr(ingest, "close_rejects", died)
        with pytest.raises(Died):
            flow.run()
    assert len(open_reasons(flow)) == n_bad
    out = flow.run()
    assert (out.ingest.appended_rows, out.ingest.repaired_rejects, out.ingest.rejected_rows) == (0, n_bad - 1, 0)
    assert open_reasons(flow) == ["bad_m1"] and flow.raw().where("week in ('3', '4')").count() == 2
    flow.assert_whole()
    flow.land("c.json", [rec("Utah", "2024", "5", m1="7")])
    out = flow.run().ingest
    assert (out.ran, out.fetched_rows, out.appended_rows, out.touched_years, out.repaired_rejects) == (True, 0, 1, [2024], 1)
    assert open_reasons(flow) == []
    assert sorted(r.week for r in flow.raw().collect()) == ["1", "2", "3", "4", "5", "9"]
    assert not flow.run().ingest.ran  # nothing is open: the files are not looked at again
    flow.land("c.json", rows[2:])  # broken again
    assert flow.run().ingest.rejected_rows == 1 and open_reasons(flow) == ["bad_m1"]
    flow.assert_whole()


def test_landing_round_trip(flow, spark):
    fetched = flatten(read_landed(spark, f"{flow.root}/landing"))
    path = land_raw(fetched, f"{flow.root}/copy", dt.date(2024, 5, 1))
    back = read_landed(spark, path)
    want = read_landed(spark, f"{flow.root}/landing")
    assert back.exceptAll(want).isEmpty() and want.exceptAll(back).isEmpty()
    assert {tuple(r.geocode.coordinates) for r in back.collect()} == {(-90.5, 40.25)}


def test_backfill_loads_old_weeks(flow, quick):
    flow.run()
    flow.land("b.json", [rec("Ohio", "2023", "7"), rec("Ohio", "2023", "99"), rec("Ohio", "2023", "0"), rec("Ohio", "2021", "7")])
    assert flow.run().ingest.appended_rows == 0  # before the watermark
    out = flow.run(backfill=(2022, 2026))
    assert out.ingest.appended_rows == 1 and out.ingest.touched_years == [2023] and out.ingest.watermark_after == (2024, 2)
    flow.assert_whole()


def test_the_weekly_run_builds_what_the_stream_loaded(flow, quick, spark):
    """A stream fills another year while no weekly run sees the rows as new."""
    flow.run()
    flow.land("b.json", [rec("Ohio", "2023", "7", m1="5")])  # before the watermark: only the stream loads it
    start_landing_stream(spark, f"{flow.root}/landing", f"{flow.root}/raw", checkpoint=f"{flow.root}/ckpt").awaitTermination(300)
    out = flow.run()
    assert out.ingest.appended_rows == 0 and out.models is not None and flow.raw().count() == 3
    flow.assert_whole()
    assert flow.run().models is None


def test_an_append_writes_few_files(spark):
    root = tempfile.mkdtemp(prefix="casewatch-append-")
    rows = spark.range(4000, numPartitions=16).select(
        *[F.lit("x").alias(c) if c not in ("states", "year", "week") else
          {"states": F.col("id").cast("string"), "year": F.lit("2024"), "week": (F.col("id") % 20 + 1).cast("string")}[c].alias(c)
          for c in schemas.RAW_COLUMNS[:-1]], F.lit(None).cast("array<double>").alias("geocode_coordinates"))
    append_raw(rows, f"{root}/raw")
    stored = spark.read.parquet(f"{root}/raw")
    assert stored.count() == 4000 and len(stored.inputFiles()) <= 20 * 4


def test_a_rewritten_input_is_read_anew(spark, sf_small):
    from casewatch.sources.adapter import raw_from_lineitem
    root = tempfile.mkdtemp(prefix="casewatch-input-")
    lineitem = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    lineitem.limit(500).write.parquet(f"{root}/lineitem.parquet")
    assert raw_from_lineitem(spark, root).count() == 500
    lineitem.limit(200).write.mode("overwrite").parquet(f"{root}/lineitem.parquet")
    assert raw_from_lineitem(spark, root).count() == 200
