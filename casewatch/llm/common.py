"""Helpers shared by the operators: row identity, written tables, distributed ranks, components."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewatch.session import scratch_path

KEY = ["kf", "kr"]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` under the shared checkpoint folder and read it back: cuts the lineage,
    and a lost executor costs no more than the tasks that were running."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of an intermediate table made by `written` that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if "/casewatch/llm-" in folder:
            path.getFileSystem(conf).delete(path, True)


def _place(docs: DataFrame) -> Column:
    """The files' own metadata, which a column named _metadata doesn't hide."""
    return docs.metadataColumn("_metadata")


def keyed(docs: DataFrame, *cols: Column) -> DataFrame:
    """The given columns of `docs` after a key (kf, kr) that names one row of its files.

    The key is the file and the row's index in it, so every later scan of the same
    files finds the same key however the files are split; repeated rows and null ids
    stay apart. A DataFrame that is not read from files is written first.
    """
    docs = file_backed(docs)
    place = _place(docs)
    return docs.select(F.xxhash64(place["file_path"]).alias("kf"), place["row_index"].alias("kr"), *cols)


def file_backed(docs: DataFrame) -> DataFrame:
    """`docs` itself if `keyed` can name its rows, else a written copy of it."""
    try:
        docs.select(_place(docs)["row_index"])
        return docs
    except AnalysisException:
        return written(docs, "rows")


def whole_rows(docs: DataFrame) -> DataFrame:
    """kf, kr, row: every row of `docs` as one struct, so no column name can clash."""
    names = ["`" + c.replace("`", "``") + "`" for c in docs.columns]
    return keyed(docs, F.struct(*map(F.col, names)).alias("row"))


def without_rows(docs: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """The rows of `docs`, with all its columns, whose key isn't in `keys`.

    Always a merge join on the row's key, few keys or many: the keys grow with the
    documents, keys are unique (no skew), and the plan is the same at every size.
    """
    return whole_rows(docs).join(written(keys.select(*KEY), name).hint("merge"), KEY, "left_anti").select("row.*")


def ranked(df: DataFrame, order: list[str], name: str, totals: dict[str, str] | None = None) -> DataFrame:
    """`df`, written in the order of `order`, with `rank` (from 0, over all rows) and, for each
    {prefix: column} of `totals`, `<prefix>_before`: the column's sum over all earlier rows.

    Rows are range-partitioned, so no task sees more than its share; one row per partition
    goes through the offsets table. `order` must be a total order (end it with the row key).
    """
    totals = totals or {}
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("mid", F.monotonically_increasing_id()), name,
    ).withColumn("part", F.shiftright("mid", 33)).withColumn("local", F.col("mid").bitwiseAND((1 << 33) - 1))
    sums = placed.groupBy("part").agg(F.count("*").alias("n"), *[F.sum(c).alias(f"s_{p}") for p, c in totals.items()])
    # As many rows as the table has partitions: bounded by the setting, not by the data.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"),
                          *[F.coalesce(F.sum(f"s_{p}").over(earlier), F.lit(0)).alias(f"s0_{p}") for p in totals])
    inside = Window.partitionBy("part").orderBy("local").rowsBetween(Window.unboundedPreceding, -1)
    out = placed.join(F.broadcast(offsets), "part").withColumn("rank", F.col("n0") + F.col("local"))
    for p, c in totals.items():
        out = out.withColumn(f"{p}_before", F.col(f"s0_{p}") + F.coalesce(F.sum(c).over(inside), F.lit(0)))
    return out.drop("part", "local", "mid", "n0", *[f"s0_{p}" for p in totals])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of `edges` (u, v longs): (node, root), root the smallest node.

    Alternating large-star and small-star rounds. Every round aggregates to each node's
    smallest neighbour first (partial aggregation, so a hub is one row per task) and is
    written; the join back reads two written tables, so a hub's partition can be split.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            e = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(e.groupBy("u").agg(F.min("v").alias("w")).withColumn("w", F.least("u", "w")), "low")
        joined = e.join(low, "u")
        if large:
            out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("w").alias("v"))
        else:
            out = joined.filter("v > w").select(F.col("v").alias("u"), F.col("w").alias("v")).union(
                low.select("u", F.col("w").alias("v")))
        out = written(out.filter("u != v").distinct(), "edges")
        drop_written(low)
        return out

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .filter("u != v").distinct(), "edges")
    was = state(e)
    while was[0]:
        nxt = star(star(e, large=True), large=False)
        now = state(nxt)
        drop_written(e)
        e = nxt
        if now == was:
            break
        was = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))

