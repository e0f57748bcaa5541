"""Log of stream loads, kept beside the raw table: what each micro-batch was about to append, and what it did.

A micro-batch is named by its stream and its number. Its years are logged before it appends, so a
batch that dies at any later point is in the log, and the weekly job builds the years of every entry
that its store has not built yet. The result is logged last; a batch with a result is not loaded again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.sources import files

INTENT = "year long"
RESULT = "load string, rows long, rejects long, years array<long>, files array<string>"


def _folder(raw_path: str) -> str:
    return f"{raw_path.rstrip('/')}-loads"


def name_of(stream: str, batch_id: int) -> str:
    return f"{stream}-{batch_id:012d}"


def intend(spark: SparkSession, raw_path: str, name: str, years: Sequence[int]) -> None:
    """Called before the append, and only with rows to append: a batch tried again that finds its rows stored keeps its first entry."""
    if years:
        spark.createDataFrame([(int(y),) for y in years], INTENT).coalesce(1).write.mode("append").parquet(f"{_folder(raw_path)}/{name}/years")


def finish(spark: SparkSession, raw_path: str, name: str, rows: int, rejects: int, years: Sequence[int], paths: Sequence[str]) -> None:
    row = [(name, int(rows), int(rejects), [int(y) for y in years], list(paths))]
    spark.createDataFrame(row, RESULT).coalesce(1).write.mode("overwrite").parquet(f"{_folder(raw_path)}/{name}/result")


def finished(spark: SparkSession, raw_path: str, name: str) -> bool:
    return files.exists(spark, f"{_folder(raw_path)}/{name}/result/_SUCCESS")


def results(spark: SparkSession, raw_path: str) -> DataFrame:
    """One row per finished micro-batch."""
    done = [n for n in files.children(spark, _folder(raw_path)) if finished(spark, raw_path, n)]
    paths = [f"{_folder(raw_path)}/{n}/result" for n in done]
    return spark.read.schema(RESULT).parquet(*paths) if paths else spark.createDataFrame([], RESULT)


def unbuilt(spark: SparkSession, raw_path: str, store: str) -> list[str]:
    """Entries whose years `store` has not built since."""
    built = set(files.children(spark, f"{store.rstrip('/')}/_loads"))
    return [n for n in files.children(spark, _folder(raw_path))
            if n not in built and files.exists(spark, f"{_folder(raw_path)}/{n}/years/_SUCCESS")]


def years(spark: SparkSession, raw_path: str, names: Sequence[str]) -> list[int]:
    if not names:
        return []
    rows = spark.read.schema(INTENT).parquet(*[f"{_folder(raw_path)}/{n}/years" for n in names])
    return sorted(r["year"] for r in rows.select(F.col("year")).distinct().collect())


def mark_built(spark: SparkSession, store: str, names: Sequence[str]) -> None:
    for n in names:
        files.touch(spark, f"{store.rstrip('/')}/_loads/{n}")
