"""Shared steps keep a task's memory and the bytes written bounded as the tables grow."""

import re

from pyspark.sql import functions as F

from casewatch.operators import dedup_first
from casewatch.sources import adapter, tables
from casewatch.sources.json_records import json_records

from .test_plans import plan


def test_a_file_of_one_row_group_is_dealt(spark, tmp_path):
    """All rows lie in one of many byte ranges: the number of splits says nothing."""
    spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t")).coalesce(1).write.parquet(str(tmp_path / "t"))
    small = {"spark.sql.files.maxPartitionBytes": "100000", "spark.sql.files.openCostInBytes": "1"}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        scan = spark.read.parquet(str(tmp_path / "t"))
        cores = spark.sparkContext.defaultParallelism
        assert scan.rdd.getNumPartitions() >= cores
        dealt = adapter.spread(scan, "id").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in dealt) < 2 * 40_000 / cores and sum(r["count"] for r in dealt) == 40_000
    finally:
        for k in small:
            spark.conf.unset(k)
    even = spark.range(0, 1000, 1, cores)
    assert "Exchange" not in plan(adapter.spread(even, "id"))
    assert adapter.spread(spark.range(0), "id").count() == 0


def test_a_long_file_is_dealt_to_few_enough_partitions_to_write_them_straight(spark, tmp_path, monkeypatch):
    spark.range(3_000).coalesce(1).write.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(adapter, "ROWS_PER_TASK", 5)
    dealt = adapter.spread(spark.read.parquet(str(tmp_path / "t")), "id")
    assert dealt.rdd.getNumPartitions() == max(200, spark.sparkContext.defaultParallelism) and dealt.distinct().count() == 3_000


def test_open_writers_write_every_value_and_restore_the_setting(spark, tmp_path):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    rows = spark.range(0, 100, 1, 2).select("id", (F.col("id") % 5).cast("string").alias("year"))
    for most in (16, 2):  # more values than writers: the rest is sorted
        with tables.open_writers(spark, most):
            assert spark.conf.get(name) == str(most)
            rows.write.partitionBy("year").parquet(str(tmp_path / str(most)))
        assert spark.conf.get(name, None) == before
        back = spark.read.parquet(str(tmp_path / str(most)))
        assert sorted((r.id, str(r.year)) for r in back.collect()) == [(i, str(i % 5)) for i in range(100)]


def test_dedup_deals_the_rows_before_it_sorts_them(spark):
    rows = [(None if i % 3 else "a", i % 2, (i * 7919) % 1000) for i in range(600)] + [("b", None, 5), ("b", None, None), (None, None, 1)]
    df = spark.createDataFrame(rows, "k string, l long, v long")
    out = dedup_first(df, ["k", "l"], [F.col("v").asc_nulls_first()])
    p = plan(out)
    limits = [i for i, x in enumerate(p.split("\n")) if "WindowGroupLimit" in x]
    exchanges = [i for i, x in enumerate(p.split("\n")) if "Exchange hashpartitioning" in x]
    assert len(exchanges) == 2 and exchanges[0] < max(limits) < exchanges[1]  # from the top: final, shuffle, partial, deal
    want = {}
    for k, l, v in rows:
        want[k, l] = min(want.get((k, l), (2, 0)), (v is not None, v or 0))
    got = {(r.k, r.l): (r.v is not None, r.v or 0) for r in out.collect()}
    assert out.columns == ["k", "l", "v"] and got == want and out.count() == len(want)


def test_dedup_cuts_what_a_task_sorts_to_the_advisory_size(spark):
    """One key holding many copies of one row, which no salt can part, is sorted by several tasks."""
    same = spark.range(0, 40_000, 1, 8).select(F.lit("a").alias("k"), F.lit(7).alias("v"), F.lit("x").alias("t"))
    other = spark.range(0, 1_000, 1, 2).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), F.lit("y").alias("t"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size, None)
    spark.conf.set(size, "2000")
    try:
        out = dedup_first(same.union(other), ["k"], [F.col("v").asc_nulls_first(), F.col("t").asc_nulls_first()])
        rows = out.collect()
        p = plan(out)
    finally:
        spark.conf.set(size, before) if before is not None else spark.conf.unset(size)
    assert sorted((r.k, r.v, r.t) for r in rows) == sorted([("a", 7, "x")] + [(str(i), 1, "y") for i in range(1_000)])
    assert re.search(r"AQEShuffleRead.*skewed", p[:p.index("Initial Plan")])


def test_dedup_deals_to_few_enough_partitions_to_write_them_straight(spark):
    """However many shuffle partitions the session has: above 200 the tasks that read the scan gather its rows in memory."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "500")
    try:
        df = spark.range(0, 3_000, 1, 3).select((F.col("id") % 700).alias("k"), F.col("id").alias("v"), F.lit("x").alias("t"))
        out = dedup_first(df, ["k"], [F.col("v").desc()])
        last, deal = re.findall(r"Exchange hashpartitioning\(.*, (\d+)\), (\w+)", plan(out))
        rows = out.collect()
    finally:
        spark.conf.set(name, before)
    assert deal[1].startswith("REBALANCE") and int(deal[0]) <= 200 and last[0] == "500"
    assert sorted((r.k, r.v, r.t) for r in rows) == [(k, max(range(k, 3_000, 700)), "x") for k in range(700)]


def test_dedup_sends_few_rows_of_a_key_to_the_last_sort(spark):
    """However many distinct rows a key has: the last sort holds them per shuffle partition, and nothing cuts it."""
    df = spark.range(0, 6_000, 1, 4).select((F.col("id") % 60).alias("k"), F.col("id").alias("v"))
    name = "spark.sql.adaptive.coalescePartitions.enabled"  # on large tables there is nothing to join
    spark.conf.set(name, "false")
    try:
        out = dedup_first(df, ["k"], [F.col("v").desc()])
        rows = out.collect()
    finally:
        spark.conf.set(name, "true")
    assert sorted((r.k, r.v) for r in rows) == [(k, 5_940 + k) for k in range(60)]
    node, written = out._jdf.queryExecution().executedPlan().executedPlan(), []
    while node is not None:
        node = node.plan() if node.nodeName().endswith("QueryStage") else node
        if node.nodeName() == "Exchange":
            written.append(node.metrics().apply("shuffleRecordsWritten").value())
        node = node.children().apply(0) if node.children().size() else None
    last, deal = written  # from the top
    assert deal == 6_000 and 60 <= last <= 120


def test_dedup_deals_the_rows_without_adaptive_execution_too(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = dedup_first(spark.range(100).select((F.col("id") % 7).alias("k"), "id"), ["k"], [F.col("id")])
        assert plan(out).count("Exchange hashpartitioning") == 2
        assert sorted((r.k, r.id) for r in out.collect()) == [(i, i) for i in range(7)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_landed_pieces_are_neither_shuffled_nor_sorted(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": 2}]')
    (tmp_path / "b.json").write_text('{"a": 3}\n{"a": 4}\n')
    found = json_records(spark, str(tmp_path)).where(~F.col("junk")).select("record")
    p = plan(found)
    assert "SortMergeJoin" not in p and "Sort [seq" not in p and "BroadcastHashJoin" in p
    assert sorted(r.record for r in found.collect()) == [f'{{"a": {i}}}' for i in (1, 2, 3, 4)]
