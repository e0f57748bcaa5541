"""Incremental load: filters, watermark, idempotence, landing round trip, streaming."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from casewatch import schemas
from casewatch.operators import advance_watermark, anti_join_new, has_newer, latest_watermark, watermark_from_raw
from casewatch.plans import ingest
from casewatch.sources import flatten, land_raw, loads, read_landed
from casewatch.streaming import load_files, start_landing_stream


def fresh_dir(prefix):
    return tempfile.mkdtemp(prefix=f"casewatch-{prefix}-")


def rec(states, year, week, label, m1="1", sort_order="s", lon=-86.9, lat=32.3):
    return {"states": states, "year": year, "week": week, "label": label, "m1": m1, "m2": "2", "m3": "3",
            "m4": "4", "m1_flag": None, "m2_flag": None, "m3_flag": None, "m4_flag": None,
            "sort_order": sort_order, "geocode": {"type": "Point", "coordinates": [lon, lat]}}


def land(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        json.dump(records, fh)


def test_null_safe_anti_join(spark):
    inc = spark.createDataFrame([("A", None), ("B", 1)], "k string, v long")
    ex = spark.createDataFrame([("A", None)], "k string, v long")
    assert [tuple(r) for r in anti_join_new(inc, ex, ["k", "v"]).collect()] == [("B", 1)]


def test_rows_after_compares_integers(spark):
    df = spark.createDataFrame([("2024", "9"), ("2024", "10"), ("2024", "11"), ("2025", "1")], "year string, week string")
    got = sorted((r.year, r.week) for r in ingest.rows_after(df, 2024, 9).collect())
    assert got == [("2024", "10"), ("2024", "11"), ("2025", "1")]


def test_composite_watermark(spark):
    df = spark.createDataFrame([("2022", "52"), ("2023", "3")], "year string, week string")
    r = advance_watermark(df, dt.datetime(2024, 1, 1)).first()
    assert (r.year, r.week) == (2023, 3)
    assert tuple(watermark_from_raw(df).first()) == (2023, 3)
    assert tuple(watermark_from_raw(df.limit(0)).first()) == (2022, 0)


def test_latest_watermark_by_load_time(spark):
    wm = spark.createDataFrame([(2024, 10, dt.datetime(2024, 3, 1)), (2023, 50, dt.datetime(2024, 4, 1))],
                               schemas.WATERMARK)
    assert tuple(latest_watermark(wm).first())[:2] == (2023, 50)
    assert latest_watermark(wm.limit(0)).count() == 0


def test_gate_skips_when_not_newer(spark):
    df = spark.createDataFrame([("2024", "10")], "year string, week string")
    assert has_newer(df, 2024, 10).first()["has_newer"] is False
    assert has_newer(df, 2024, 9).first()["has_newer"] is True


def test_flatten_nested(spark):
    base = fresh_dir("flat")
    land(base, "a.json", [rec("Ohio", "2024", "1", "Mumps"), {**rec("Iowa", "2024", "1", "Mumps"), "geocode": None}])
    flat = flatten(read_landed(spark, base))
    assert "geocode_type" in flat.columns and "geocode_coordinates" in flat.columns
    rows = {r.states: (r.geocode_type, r.geocode_coordinates) for r in flat.collect()}
    assert rows == {"Ohio": ("Point", [-86.9, 32.3]), "Iowa": (None, None)}


def test_land_raw_same_day_overwrites(spark):
    base = fresh_dir("land")
    df = spark.createDataFrame([("x",)], "a string")
    p1 = land_raw(df, base, dt.date(2024, 5, 1))
    p2 = land_raw(df.union(df), base, dt.date(2024, 5, 1))
    assert p1 == p2 and p1.endswith("raw_20240501") and spark.read.json(p1).count() == 2


def test_ingest_is_idempotent(spark):
    root = fresh_dir("ingest")
    landing, raw_path, wm_path = f"{root}/landing", f"{root}/raw", f"{root}/wm"
    batch = [rec("Ohio", "2024", "1", "Mumps", sort_order="b"), rec("Ohio", "2024", "1", "Mumps", sort_order="a"),
             rec("Iowa", "2024", "2", "Mumps"), rec("Iowa", "2024", "10", None)]
    land(landing, "day1.json", batch)
    r1 = ingest.ingest_batch(spark, landing, raw_path, wm_path, dt.datetime(2024, 3, 1))
    assert r1.ran and r1.appended_rows == 3 and r1.watermark_after == (2024, 10)
    stored = spark.read.schema(schemas.RAW).parquet(raw_path)
    first = stored.where((F.col("states") == "Ohio")).first()
    assert first.sort_order == "b"  # first in landing order is kept
    r2 = ingest.ingest_batch(spark, landing, raw_path, wm_path, dt.datetime(2024, 3, 2))
    assert not r2.ran and stored.count() == 3
    # overlap: an older week (below the watermark) and a newer one
    land(landing, "day2.json", [rec("Ohio", "2024", "1", "Mumps"), rec("Utah", "2024", "11", "Mumps")])
    r3 = ingest.ingest_batch(spark, landing, raw_path, wm_path, dt.datetime(2024, 3, 3))
    assert r3.ran and r3.appended_rows == 1 and r3.watermark_after == (2024, 11) and r3.touched_years == [2024]
    assert spark.read.schema(schemas.RAW).parquet(raw_path).count() == 4


def test_streaming_ingest_replays_add_nothing(spark):
    root = fresh_dir("stream")
    landing, raw_path = f"{root}/landing", f"{root}/raw"
    land(landing, "a.json", [rec("Ohio", "2024", "1", "Mumps"), rec("Ohio", "2024", "1", "Mumps")])
    q = start_landing_stream(spark, landing, raw_path, checkpoint=f"{root}/ckpt")
    q.awaitTermination(120)
    assert spark.read.schema(schemas.RAW).parquet(raw_path).count() == 1
    land(landing, "b.json", [rec("Ohio", "2024", "1", "Mumps"), rec("Utah", "2024", "2", "Mumps")])
    q = start_landing_stream(spark, landing, raw_path, checkpoint=f"{root}/ckpt2")  # replays a.json too
    q.awaitTermination(120)
    assert spark.read.schema(schemas.RAW).parquet(raw_path).count() == 2


def test_stream_equals_batch_load(spark):
    """Lines, a truncated array, a bad year and a bad m1: the same rows and rejects, however they are loaded."""
    root = fresh_dir("stream-batch")
    os.makedirs(f"{root}/landing")
    good = [rec("Ohio", "2024", str(w), "Mumps") for w in range(1, 9)]
    texts = {
        "a.json": "".join(json.dumps(x) + "\n" for x in good[:3]),
        "b.json": json.dumps(good[3:6])[:-40],
        "c.json": json.dumps([rec("Ohio", "20x4", "1", "Mumps"), rec("Ohio", "2024", "7", "Mumps", m1="n/a"), good[7], good[0]]),
        "d [1].json": json.dumps(rec("Utah", "2023", "5", "Mumps"), indent=2),
    }
    for name, text in texts.items():
        with open(f"{root}/landing/{name}", "w") as fh:
            fh.write(text)
    start_landing_stream(spark, f"{root}/landing", f"{root}/streamed", checkpoint=f"{root}/ckpt", wm_path=f"{root}/stream-wm").awaitTermination(300)
    ingest.ingest_batch(spark, f"{root}/landing", f"{root}/raw", f"{root}/wm", dt.datetime(2024, 3, 1))
    streamed, batch = (spark.read.schema(schemas.RAW).parquet(f"{root}/{p}") for p in ("streamed", "raw"))
    assert sorted(streamed.collect(), key=str) == sorted(batch.collect(), key=str) and batch.count() == 7
    rejects = [spark.read.parquet(f"{root}/{p}-rejects").select("reason", "record").collect() for p in ("streamed", "raw")]
    assert sorted(rejects[0]) == sorted(rejects[1]) and sorted(r.reason for r in rejects[0]) == ["bad_m1", "bad_year", "malformed_json"]
    assert [tuple(r)[:2] for r in spark.read.parquet(f"{root}/stream-wm").collect()] == [(2024, 8)]
    result = loads.results(spark, f"{root}/streamed").first()
    assert (result.rows, result.rejects, result.years, len(result.files)) == (7, 3, [2023, 2024], 4)


def test_a_micro_batch_that_died_is_loaded_once(spark, monkeypatch):
    from casewatch.plans import ingest as module
    root = fresh_dir("stream-dies")
    land(f"{root}/landing", "a.json", [rec("Ohio", "2024", "1", "Mumps"), rec("Utah", "2025", "2", "Mumps")])
    path, raw_path = f"{root}/landing/a.json", f"{root}/raw"

    def die(*args):
        raise RuntimeError("died")
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(module, "append_raw", die)  # before the append
        load_files(spark, [path], raw_path, "s-0")
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(loads, "finish", die)  # after it
        load_files(spark, [path], raw_path, "s-0")
    assert loads.unbuilt(spark, raw_path, f"{root}/store") == ["s-0"] and loads.years(spark, raw_path, ["s-0"]) == [2024, 2025]
    assert load_files(spark, [path], raw_path, "s-0") and not load_files(spark, [path], raw_path, "s-0")
    assert spark.read.schema(schemas.RAW).parquet(raw_path).count() == 2
