"""An incremental refresh after a load equals a full rebuild."""

from pyspark.sql import functions as F

from casewatch.functions import week_stamp
from casewatch.plans.build import build_models
from casewatch.plans import refresh
from casewatch.plans.refresh import MART_SEASON, MART_TOP5, MART_WOW, read_manifest, refresh_models
from casewatch.session import scratch_path
from casewatch.sources import files
from casewatch.sources.adapter import raw_from_lineitem


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_refresh_of_touched_years_equals_full_build(spark, sf_small):
    raw = raw_from_lineitem(spark, sf_small)
    stamp = week_stamp("year", "week")
    before = raw.where(stamp <= 202440)           # stored earlier
    store = scratch_path(spark, "test-refresh")
    refresh_models(before, store)                 # full build
    # a load adds weeks after 2024-W40: only 2024 and later years change
    touched = [r[0] for r in raw.where(stamp > 202440).select(F.col("year").cast("long")).distinct().collect()]
    got = refresh_models(raw, store, years=touched)
    want = build_models(raw)
    for k in ("stg_nndss_weekly", "dim_location", "dim_date", "dim_diseases", "fact_disease_cases",
              MART_TOP5, MART_SEASON, MART_WOW):
        assert same(got[k].select(*want[k].columns), want[k]), k


def test_weekly_flow_ingest_then_refresh_touched_years(spark):
    import datetime as dt
    import json
    import os
    import tempfile

    from casewatch import schemas
    from casewatch.plans.ingest import ingest_batch

    root = tempfile.mkdtemp(prefix="casewatch-flow-")
    landing, raw_path, wm, store = f"{root}/landing", f"{root}/raw", f"{root}/wm", f"{root}/models"
    os.makedirs(landing)

    def rec(states, year, week, label, m1, sort_order):
        return {"states": states, "year": year, "week": week, "label": label, "m1": m1, "m2": "3", "m3": "9",
                "m4": "1", "m1_flag": None, "m2_flag": None, "m3_flag": None, "m4_flag": None,
                "sort_order": sort_order, "geocode": {"type": "Point", "coordinates": [-90.0, 40.0]}}

    day1 = [rec("Ohio", "2023", "52", "Mumps", "4", "a"), rec("Ohio", "2024", "1", "Mumps", "7", "b"),
            rec("Iowa", "2024", "2", "Rabies, human", "2", "c")]
    day2 = [rec("Ohio", "2024", "3", "Mumps", "9", "d"), rec("Iowa", "2024", "3", "Mumps", "1", "e")]
    for name, batch in (("day1.json", day1), ("day2.json", day2)):
        with open(f"{landing}/{name}", "w") as fh:
            json.dump(batch, fh)
        r = ingest_batch(spark, landing, raw_path, wm, dt.datetime(2024, 2, 1))
        raw = spark.read.schema(schemas.RAW).parquet(raw_path)
        got = refresh_models(raw, store, years=r.touched_years)
        want = build_models(raw)
        for k in ("stg_nndss_weekly", "dim_date", MART_TOP5, MART_SEASON, MART_WOW):
            assert same(got[k].select(*want[k].columns), want[k]), (name, k)
    assert r.touched_years == [2024]


def test_late_rows_of_a_middle_year(spark):
    """Later years take their first previous value from the late rows; the weeks have gaps."""
    from casewatch import schemas

    def rows(*found):
        return spark.createDataFrame(
            [("Ohio", str(y), str(w), "Mumps", str(n), "3", "9", "1", None, None, None, None, f"{y}-{w}", None) for y, w, n in found], schemas.RAW)

    first = [(2023, 50, 9), (2024, 10, 4), (2025, 5, 4), (2026, 1, 7)]
    late = [(2024, 30, 50), (2024, 12, 1)]
    store = scratch_path(spark, "test-late")
    refresh_models(rows(*first), store)
    got = refresh_models(rows(*first, *late), store, years=[2024])
    want = build_models(rows(*first, *late))
    for k in (MART_TOP5, MART_SEASON, MART_WOW):
        assert same(got[k].select(*want[k].columns), want[k]), k
    r = got[MART_WOW].where("year = 2025").first()
    assert (r.actual_previous_week_cases, r.wow_change) == (50, -46)


def test_season_years_are_an_argument(spark):
    from casewatch import schemas
    raw = spark.createDataFrame([("Ohio", "2031", "5", "Mumps", "4", "3", "9", "1", None, None, None, None, "a", None)], schemas.RAW)
    assert refresh_models(raw, scratch_path(spark, "test-season"))[MART_SEASON].count() == 0
    assert refresh_models(raw, scratch_path(spark, "test-season"), season_years=(2022, 2031))[MART_SEASON].count() == 1


def ohio(spark, *found):
    from casewatch import schemas
    return spark.createDataFrame(
        [(st, str(y), str(w), "Mumps", str(n), "3", "9", "1", None, None, None, None, f"{st}-{y}-{w}", None) for st, y, w, n in found], schemas.RAW)


def stored_versions(spark, store, table):
    return {part: v for (t, part), (v, _, _) in read_manifest(spark, store).items() if t == table}


def test_a_touched_year_is_the_only_one_written(spark):
    """Late rows of a middle year change what later years compare with, though their files stay."""
    rows = [("Ohio", 2023, 50, 9), ("Ohio", 2024, 10, 4), ("Iowa", 2022, 3, 8), ("Iowa", 2026, 4, 2), ("Ohio", 2026, 1, 7)]
    store = scratch_path(spark, "test-delta")
    refresh_models(ohio(spark, *rows), store)
    before = stored_versions(spark, store, refresh.WOW_ROWS)
    late = [*rows, ("Ohio", 2024, 30, 50), ("Iowa", 2024, 2, 5)]
    got = refresh_models(ohio(spark, *late), store, years=[2024])
    after = stored_versions(spark, store, refresh.WOW_ROWS)
    assert {p for p in after if after[p] != before.get(p)} == {"year=2024"}
    want = build_models(ohio(spark, *late))[MART_WOW]
    assert same(got[MART_WOW].select(*want.columns), want)


def test_a_changed_season_range_rebuilds_all_its_years(spark):
    rows = [("Ohio", y, 5, 4) for y in (2021, 2024, 2025)]
    store = scratch_path(spark, "test-ranges")
    refresh_models(ohio(spark, *rows), store)
    got = refresh_models(ohio(spark, *rows), store, years=[2025], season_years=(2020, 2030))
    assert sorted(r.year for r in got[MART_SEASON].collect()) == [2021, 2024, 2025]
    got = refresh_models(ohio(spark, *rows), store, years=[2025], season_years=(2024, 2024))
    assert sorted(r.year for r in got[MART_SEASON].collect()) == [2024]


def test_two_refreshes_at_a_time_both_land(spark, monkeypatch):
    """The second publishes while the first is at work: the first begins again, and nothing of either is lost."""
    rows = [("Ohio", 2023, 50, 9), ("Ohio", 2024, 10, 4), ("Ohio", 2025, 2, 7)]
    store = scratch_path(spark, "test-two")
    refresh_models(ohio(spark, *rows), store)
    first = [*rows, ("Iowa", 2023, 4, 1)]
    both = [*first, ("Utah", 2025, 6, 3)]
    publish, calls = refresh._publish, []

    def meanwhile(*args):
        calls.append(args[3])
        if len(calls) == 1:
            refresh_models(ohio(spark, *both), store, years=[2025])  # the other run, from the same manifest
        return publish(*args)
    monkeypatch.setattr(refresh, "_publish", meanwhile)
    got = refresh_models(ohio(spark, *first), store, years=[2023])
    assert calls == [1, 1, 2]  # the first one's try, the second one, the first one again
    want = build_models(ohio(spark, *both))
    for k in ("stg_nndss_weekly", "dim_location", MART_TOP5, MART_SEASON, MART_WOW):
        assert same(got[k].select(*want[k].columns), want[k]), k


def test_a_claim_of_a_run_that_died_does_not_stop_the_next(spark, monkeypatch):
    rows, store = [("Ohio", 2024, 10, 4)], scratch_path(spark, "test-claim")
    files.claim(spark, f"{store}/claims/00000001")
    assert not files.claim(spark, f"{store}/claims/00000001")
    monkeypatch.setattr(refresh, "CLAIM_SECONDS", 0.01)
    assert refresh_models(ohio(spark, *rows), store)[MART_TOP5].count() == 1
    assert refresh_models(ohio(spark, *rows), store, years=[2024])[MART_TOP5].count() == 1


def test_marts_add_up_from_cells(spark, sf_small):
    """The aggregates of all three marts and the measures are the same from cells as from the star."""
    from casewatch.plans import kpis, marts

    m = build_models(raw_from_lineitem(spark, sf_small))
    s = marts.star(m["fact_disease_cases"], m["dim_location"], m["dim_diseases"], m["dim_date"])
    cells = marts.star_cells(s)
    for of_cells, of_star in ((marts.top5_of_cells, marts.top5_aggregate), (marts.season_of_cells, marts.season_aggregate),
                              (marts.wow_of_cells, marts.wow_preagg), (kpis.overview_of_cells, kpis.kpi_overview),
                              (kpis.volatility, kpis.volatility), (kpis.year_over_year, kpis.year_over_year)):
        a, b = of_cells(cells), of_star(s)
        assert a.schema.simpleString() == b.schema.simpleString() and same(a, b), of_cells
    nothing = cells.limit(0)
    assert kpis.overview_of_cells(nothing).first() == kpis.kpi_overview(s.limit(0)).first()


def test_other_holidays_rebuild_all_years(spark, sf_small):
    """Cells and the week-over-week mart carry holidays, so years the load has not touched change too."""
    from casewatch.sources.seeds import us_holidays

    raw, store = raw_from_lineitem(spark, sf_small), scratch_path(spark, "test-holidays")
    refresh_models(raw, store)
    other = us_holidays(spark).withColumn("holiday_name", F.concat("holiday_name", F.lit(" (observed)")))
    got = refresh_models(raw, store, years=[2024], holidays=other)
    want = build_models(raw, other)
    assert same(got[MART_WOW].select(*want[MART_WOW].columns), want[MART_WOW])
    assert got["star_cells"].where("is_holiday_week AND NOT holiday_name LIKE '%observed)'").count() == 0
    versions = {v for (t, _), (v, _, _) in read_manifest(spark, store).items() if t == refresh.CELLS}
    assert len(versions) == 1
    refresh_models(raw, store, years=[2025], holidays=other)  # the same list: one year
    assert len({v for (t, _), (v, _, _) in read_manifest(spark, store).items() if t == refresh.CELLS}) == 2
