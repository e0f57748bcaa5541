"""Golden rows for mart operators and invariants of the model chain."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from casewatch import queries as Q
from casewatch.operators import period_change, running_total
from casewatch.plans import dims, facts, marts, quality


def test_outbreak_flag(spark):
    df = spark.createDataFrame([(0.0, 0.0), (5.0, 5.0), (4.0, 5.0)], "c double, m double")
    assert [r[0] for r in df.select(marts.is_outbreak("c", "m")).collect()] == [0, 1, 0]


def test_first_lag_row(spark):
    df = spark.createDataFrame([("R", 1, 7.0), ("R", 2, 14.0), ("R", 3, 0.0), ("R", 4, 5.0)], "p string, o int, v double")
    out = period_change(df, "v", ["p"], ["o"]).orderBy("o").collect()
    assert [(r.previous_value, r.change, r.pct_change) for r in out] == [
        (0.0, 7.0, 0.0), (7.0, 7.0, 100.0), (14.0, -14.0, -100.0), (0.0, 5.0, 0.0)]


def test_rank_ties(spark):
    df = spark.createDataFrame([("S", 9.0), ("S", 9.0), ("S", 5.0)], "s string, t double")
    w = Window.partitionBy("s").orderBy(F.col("t").desc())
    got = sorted(tuple(r) for r in df.select("t", F.rank().over(w), F.dense_rank().over(w)).collect())
    assert got == [(5.0, 3, 2), (9.0, 1, 1), (9.0, 1, 1)]


def test_flag_count(spark):
    df = spark.createDataFrame([("-",), ("U",), (None,)], "current_week_cases_flag string")
    assert df.agg(marts.counted_flag()).first()[0] == 1


def test_running_total_restarts_each_partition(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 5.0)], "k string, o int, v double")
    got = {(r.k, r.o): r.running_total for r in running_total(df, "v", ["k"], ["o"]).collect()}
    assert got == {("a", 1): 1.0, ("a", 2): 3.0, ("b", 1): 5.0}


def test_model_invariants(spark, sf_small):
    s = Q.stg(spark, sf_small)
    f = facts.fact_disease_cases(s)
    assert f.count() == s.count() == 5524
    assert quality.unique(f, "fact_id").count() == 0
    _, loc, date, dis = Q.dimensions(spark, sf_small)
    for d, key in ((loc, "location_id"), (date, "date_id"), (dis, "disease_id")):
        assert quality.unique(d, key).count() == 0
    assert f.where(F.col("disease_id").isNull()).count() == 120  # ASSOCIATED names


def test_fact_projection_equals_join(spark, sf_small):
    s, loc, date, dis = Q.dimensions(spark, sf_small)
    by_rule = facts.fact_disease_cases(s)
    by_join = facts.fact_disease_cases(s, loc, dis, date)
    assert by_rule.exceptAll(by_join).count() == 0 and by_join.exceptAll(by_rule).count() == 0


def test_dims_from_pre_dedup_rows_equal_dims_from_staging(spark, sf_small):
    s, loc, date, dis = Q.dimensions(spark, sf_small)
    assert dims.dim_location(s).exceptAll(loc).count() == 0
    assert dims.dim_diseases(s).exceptAll(dis).count() == 0


def test_running_total_of_last_week_is_yearly_sum(spark, sf_small):
    wow = marts.week_over_week(Q.star_of(spark, sf_small), by="full")
    keys = ["region_name", "disease_name_short", "disease_status", "disease_category", "severity_or_stage",
            "disease_group", "year"]
    w = Window.partitionBy(*keys)
    # cases are never negative, so the last running total is the largest one
    both = wow.select(F.max("running_cumulative_cases_year").over(w).alias("last"),
                      F.sum("current_week_cases").over(w).alias("total"))
    bad = both.where(F.col("last") != F.col("total"))
    assert bad.count() == 0


def test_top5_keeps_ties_and_max_rank(spark, sf_small):
    top = marts.top_diseases(Q.star_of(spark, sf_small))
    assert top.agg(F.max("disease_rank_in_state")).first()[0] <= 5
    assert top.where(F.col("quarter").isNull()).count() > 0  # week 53 forms its own partition


def test_hot_key_with_a_third_of_rows_dedups_to_one(spark, sf_small):
    from pyspark.sql import functions as F
    from casewatch.plans import staging
    raw = Q.raw(spark, sf_small)
    n = raw.count()
    hot = raw.where((F.col("states") == "Ohio") & ~F.col("label").contains("Total")).first().asDict()
    copies = spark.range(n // 2).select(*[
        (F.concat(F.lit(hot["sort_order"]), F.lit("#"), F.col("id").cast("string")) if c == "sort_order"
         else F.lit(hot[c]).cast(raw.schema[c].dataType)).alias(c)
        for c in raw.columns])
    skewed = raw.unionByName(copies)  # one grain key now holds a third of all rows
    got = staging.stage_weekly(skewed)
    want = staging.stage_weekly(raw)
    assert got.count() == want.count()
    k = staging.clean_weekly(copies.limit(1)).first()
    key = (F.col("state_name") == k.state_name) & (F.col("disease_name") == k.disease_name) & \
          (F.col("year") == k.year) & (F.col("week") == k.week)
    assert got.where(key).count() == 1
    # the first row by masked sort order wins, whichever copy that is
    assert got.where(key).first().sort_order_masked == \
        staging.reportable(skewed).where(key).agg(F.min("sort_order_masked")).first()[0]


def test_presentation_orders(spark):
    from casewatch.plans import ingest
    raw = spark.createDataFrame([("2024", "10"), ("2024", "9"), ("2023", "52")], "year string, week string")
    assert [(r.year, r.week) for r in ingest.ordered_extract(raw).collect()] == [
        ("2023", "52"), ("2024", "9"), ("2024", "10")]  # integers, not text
    dd = spark.createDataFrame([(2024, 2), (2023, 53), (2024, 1)], "year long, week long")
    assert [(r.year, r.week) for r in marts.ordered(dd, "dim_date").collect()] == [(2023, 53), (2024, 1), (2024, 2)]


def test_scale_conf_only_fills_gaps(spark):
    from casewatch.session import SCALE_CONF, apply_scale_conf
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    applied = apply_scale_conf(spark, overrides={"spark.sql.shuffle.partitions": "8"})
    try:
        assert "spark.sql.adaptive.enabled" not in applied  # already set by the session
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
        assert set(applied) <= set(SCALE_CONF)
    finally:  # leave the shared test session as it was
        for k in applied:
            if k != "spark.sql.shuffle.partitions":
                spark.conf.unset(k)
