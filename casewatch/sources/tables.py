"""Table writes: append-only raw table, model materialisation."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Namespace of each model kind; names are used verbatim inside it.
NAMESPACES = {
    "staging": None,          # a view, recomputed by its readers unless persisted
    "dims": "cdc_dims",
    "facts": "cdc_facts",
    "marts": "cdc_marts",
    "seeds": "cdc_staging",
}


def table_exists(spark: SparkSession, path: str, marker: bool = False) -> bool:
    """True when a readable Parquet table is at `path` (an empty table counts).

    With marker=True, `path` names a marker file (e.g. a finished job's
    _SUCCESS) and only its presence is tested, through the Hadoop file
    system Spark itself uses.
    """
    if marker:
        try:
            spark.read.text(path).schema  # noqa: B018 - lists the path without reading it
            return True
        except AnalysisException:
            return False
    try:
        spark.read.parquet(path).schema  # noqa: B018 - resolving the schema lists the folder
        return True
    except AnalysisException:
        return False


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> DataFrame:
    """Write Parquet and return a DataFrame reading it back (cuts the lineage)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def open_writers(spark: SparkSession, most: int = 16) -> Iterator[None]:
    """Partitioned writes inside keep a file open per partition value instead of sorting each task's rows by it.

    A task that meets more than `most` values sorts what is left of its rows, as without this. Meant for few
    values (years): every open file holds its own buffers.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def append_raw(df: DataFrame, path: str, files_per_week: int = 4) -> None:
    """Insert-only append to the raw table, partitioned by year and week.

    Year partitions serve the model refresh; (year, week) partitions let the
    anti-join of a weekly load read only the weeks present in the batch. Rows
    are dealt by week and a salt first, so a week gets at most `files_per_week`
    files however many tasks the batch has.
    """
    salt = F.pmod(F.xxhash64("states", "label"), F.lit(files_per_week))
    df.repartition("year", "week", salt).write.mode("append").partitionBy("year", "week").parquet(path)


def materialise(models: dict[str, tuple[str, DataFrame]], root: str | None = None,
                use_catalog: bool = False) -> dict[str, DataFrame]:
    """Materialise {name: (kind, df)}: staging as a temp view, the rest as tables.

    Tables go to `{root}/{namespace}/{name}` as Parquet, or, with
    use_catalog=True, to `{namespace}.{name}` in the session catalog (the
    namespace is created at `{root}/{namespace}` when a root is given).
    Returns DataFrames that read the materialised data.
    """
    out: dict[str, DataFrame] = {}
    for name, (kind, df) in models.items():
        ns = NAMESPACES[kind]
        if ns is None:
            df.createOrReplaceTempView(name)
            out[name] = df
        elif use_catalog:
            spark = df.sparkSession
            where = f" LOCATION '{root.rstrip('/')}/{ns}'" if root else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns}{where}")
            df.write.mode("overwrite").format("parquet").saveAsTable(f"{ns}.{name}")
            out[name] = spark.table(f"{ns}.{name}")
        else:
            if root is None:
                raise ValueError("root is required unless use_catalog=True")
            out[name] = write_table(df, f"{root.rstrip('/')}/{ns}/{name}")
    return out
