"""Golden rows for the data-quality operators."""

import datetime as dt

from casewatch import schemas
from casewatch.plans import quality


def raw_rows(spark, *rows):
    full = []
    for r in rows:
        base = {c: None for c in schemas.RAW_COLUMNS}
        base.update(states="Ohio", year="2024", week="3", label="Mumps", m1="1")
        base.update(r)
        full.append(tuple(base[c] for c in schemas.RAW_COLUMNS))
    return spark.createDataFrame(full, schemas.RAW)


def test_generic_tests_null_semantics(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "v string")
    assert quality.not_null(df, "v").count() == 2
    assert [tuple(r) for r in quality.unique(df, "v").collect()] == [("a", 2)]  # nulls are not duplicates
    assert [r.value_field for r in quality.accepted_values(df, "v", ["a"]).collect()] == ["b"]  # nulls pass
    parent = spark.createDataFrame([("a",)], "k string")
    assert [r.from_field for r in quality.relationships(df, "v", parent, "k").collect()] == ["b"]


def test_case_spikes(spark):
    stg = spark.createDataFrame([(5.0, 5.0), (4.0, 5.0), (0.0, 0.0), (3.0, None)],
                                "current_week_cases double, previous_52_weeks_max double")
    assert [r[0] for r in quality.case_spikes(stg).collect()] == [5.0]


def test_future_weeks_counts_weeks_from_sundays(spark):
    stg = spark.createDataFrame([(2022, 0), (2022, 1), (2021, 52)], "year long, week long")
    got = sorted((r.year, r.week) for r in quality.future_weeks(stg, dt.date(2022, 1, 1)).collect())
    assert got == [(2022, 1)]  # 2022-01-01 is a Saturday: week 0, stamp 202200


def test_null_cases_without_flag(spark):
    raw = raw_rows(spark, {"m1": None}, {"m1": None, "m1_flag": "U"}, {"m1": "3"})
    assert quality.null_cases_no_flag(raw).count() == 1


def test_duplicate_rows(spark):
    df = spark.createDataFrame([("OHIO", 2024, 1, "MUMPS")] * 3 + [("IOWA", 2024, 1, "MUMPS")],
                               "state_name string, year long, week long, disease_name string")
    assert [tuple(r) for r in quality.duplicate_rows(df).collect()] == [("OHIO", 2024, 1, "MUMPS", 3)]


def test_quarantine_reasons(spark):
    raw = raw_rows(spark, {}, {"states": None}, {"year": "20x4"}, {"week": None}, {"m2": "many"})
    good, bad = quality.quarantine(raw)
    assert good.count() == 1
    assert sorted(r.quarantine_reason for r in bad.collect()) == [
        "bad_m2", "bad_year", "missing_states", "missing_week"]


def test_unmatched_fk_tags_the_key(spark):
    fact = spark.createDataFrame([("f1", "L1", "D1", 202401), ("f2", "L9", None, 202401)],
                                 "fact_id string, location_id string, disease_id string, date_id long")
    dims = {
        "dim_location": spark.createDataFrame([("L1",)], "location_id string"),
        "dim_diseases": spark.createDataFrame([("D1",)], "disease_id string"),
        "dim_date": spark.createDataFrame([(202401,)], "date_id long"),
    }
    got = sorted(tuple(r) for r in quality.unmatched_fk(fact, dims).collect())
    assert got == [("f2", "disease_id", None), ("f2", "location_id", "L9")]


def test_report_status_by_severity(spark):
    df = spark.createDataFrame([(None, "x")], "a string, b string")
    checks = [quality.Check("not_null", "t", "a"), quality.Check("not_null", "t", "a", "warn"),
              quality.Check("not_null", "t", "b")]
    rows = {(r.test, r.severity): r.status for r in quality.dq_report({"t": df}, checks).collect()}
    assert rows == {("not_null_t_a", "error"): "fail", ("not_null_t_a", "warn"): "warn",
                    ("not_null_t_b", "error"): "pass"}
