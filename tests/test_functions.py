"""Golden rows for the column functions (traps T1-T13 and deviations V1-V5)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch import schemas
from casewatch.functions import (
    date_id, half_of, match_first, mmwr_period, norm_disease, quarter_of, season_of, short_name,
    sunday_week_of, surrogate_key, trim_ws, week_label,
)
from casewatch.plans import staging
from casewatch.reference_data import DISEASE_LIST, DISEASE_STATUS_RULES


def one(spark, col, value, dtype=T.StringType()):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("x", dtype, True)]))
    return df.select(col(F.col("x")).alias("y")).first()["y"]


def raw_row(**kw):
    base = {c: None for c in schemas.RAW_COLUMNS}
    base.update(states="Ohio", year="2024", week="3", label="Mumps", m1="1", sort_order="k")
    base.update(kw)
    return tuple(base[c] for c in schemas.RAW_COLUMNS)


def test_trim_strips_unicode_whitespace(spark):
    assert one(spark, trim_ws, "\t a \n") == "a"
    assert one(spark, trim_ws, "  x y　") == "x y"


def test_state_trim_upper_and_division(spark):
    raw = spark.createDataFrame([raw_row(states="\t ohio\n")], schemas.RAW)
    r = staging.clean_weekly(raw).first()
    assert (r["state_name"], r["region_name"]) == ("OHIO", "EAST NORTH CENTRAL")


def test_masks(spark):
    raw = spark.createDataFrame(
        [raw_row(geocode_coordinates=None, sort_order=None),
         raw_row(geocode_coordinates=[-86.9023, 32.3182], sort_order="a")], schemas.RAW)
    rows = staging.clean_weekly(raw).collect()
    assert rows[0]["longitude_masked"] == "d41d8cd98f00b204e9800998ecf8427e"
    assert rows[0]["sort_order_masked"] is None
    assert rows[1]["longitude_masked"] == "a5f5ddd2c406ad50e17936588a2b7d79"


def test_null_sort_order_sorts_first_and_null_label_dropped(spark):
    raw = spark.createDataFrame(
        [raw_row(sort_order="zzz", m1="5"), raw_row(sort_order=None, m1="9"), raw_row(label=None)], schemas.RAW)
    out = staging.stage_weekly(raw).collect()
    assert len(out) == 1 and out[0]["current_week_cases"] == 9.0


def test_disease_normalisation(spark):
    assert one(spark, norm_disease, "  SalmonellaParatyphi\t\tinfection ") == "SALMONELLA PARATYPHI INFECTION"
    assert one(spark, norm_disease, "  Mumps\t ") == "MUMPS"


def test_total_rows_dropped(spark):
    raw = spark.createDataFrame([raw_row(label="Hepatitis B, acute, Total"), raw_row()], schemas.RAW)
    assert [r["disease_name"] for r in staging.stage_weekly(raw).collect()] == ["MUMPS"]


def test_cast_accepts_padded_digits(spark):
    raw = spark.createDataFrame([raw_row(year=" 2024 ", week=" 5 ")], schemas.RAW)
    r = staging.clean_weekly(raw).first()
    assert (r["year"], r["week"]) == (2024, 5)


def test_measures_null_to_zero(spark):
    raw = spark.createDataFrame([raw_row(m1=None, m2="7")], schemas.RAW)
    r = staging.clean_weekly(raw).first()
    assert (r["current_week_cases"], r["previous_52_weeks_max"]) == (0.0, 7.0)


def test_week_53_buckets(spark):
    df = spark.createDataFrame([(2025, 53), (2024, 13), (2024, 40), (2024, 49)], "year long, week long")
    rows = df.select(date_id("year", "week").alias("id"), quarter_of("week").alias("q"), half_of("week").alias("h"),
                     season_of("week").alias("s"), mmwr_period("year", "week").alias("p"),
                     week_label("year", "week").alias("l")).collect()
    assert tuple(rows[0]) == (202553, None, None, "WINTER", "2025-W53", "Week 53, 2025")
    assert tuple(rows[1])[:4] == (202413, "Q1", "H1", "WINTER")
    assert rows[2]["s"] == "FALL" and rows[3]["s"] == "WINTER"


def test_sunday_week_number(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 1),), (dt.date(2022, 1, 2),), (dt.date(2024, 12, 31),)], "d date")
    got = [r[0] for r in df.select(sunday_week_of("d")).collect()]
    want = [int(d.strftime("%U")) for d in (dt.date(2022, 1, 1), dt.date(2022, 1, 2), dt.date(2024, 12, 31))]
    assert got == want == [0, 1, 52]


def test_surrogate_key_null_placeholder(spark):
    df = spark.createDataFrame([("OHIO", None)], "a string, b long")
    got = df.select(surrogate_key("a", "b")).first()[0]
    import hashlib
    assert got == hashlib.md5(b"OHIO-_dbt_utils_surrogate_key_null_").hexdigest()


SHORT_NAMES = [
    ("BOTULISM, OTHER (WOUND & UNSPECIFIED)", "BOTULISM"),
    ("CRONOBACTER INVASIVE INFECTION, INFANTS, CONFIRMED", "CRONOBACTER INVASIVE INFECTION"),
    ("HAEMOPHILUS INFLUENZAE, INVASIVE DISEASE, AGE <5 YEARS, NON-B SEROTYPE", "HAEMOPHILUS INFLUENZAE"),
    ("HEPATITIS B, PERINATAL INFECTION", "HEPATITIS B"),
    ("HEPATITIS, A, ACUTE", "HEPATITIS, A"),
    ("RUBELLA, CONGENITAL SYNDROME", "RUBELLA"),
    ("OROPOUCHE, NON-CONGENITAL", "OROPOUCHE"),
    ("ARBOVIRAL DISEASES, WEST NILE VIRUS DISEASE", "WEST NILE VIRUS DISEASE"),
    ("DENGUE VIRUS INFECTIONS, DENGUE-LIKE ILLNESS", "DENGUE-LIKE ILLNESS"),
    ("Q FEVER, CHRONIC", "Q FEVER"),
]


@pytest.mark.parametrize("name,short", SHORT_NAMES)
def test_short_names(spark, name, short):
    assert one(spark, short_name, name) == short


def test_short_names_of_seed(spark):
    df = spark.createDataFrame([(n,) for n in DISEASE_LIST], "n string")
    kept = df.where(~F.col("n").contains("ASSOCIATED")).select(short_name("n").alias("s"))
    assert kept.count() == 130 and kept.distinct().count() == 94


def test_match_first_order_and_default(spark):
    assert one(spark, lambda c: match_first(c, DISEASE_STATUS_RULES), "X, CONFIRMED, PROBABLE") == "Confirmed"
    assert one(spark, lambda c: match_first(c, DISEASE_STATUS_RULES), "X") == "N/A"
