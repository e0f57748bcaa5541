"""Years whose models are behind the raw table, kept in the store until models and tests are done.

A load records its years here before it appends, so a run that dies at any later
point leaves a mark, and the next run refreshes and tests those years whatever it loads itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

from casewatch.sources import files

SCHEMA = "year long"


def _folder(store: str) -> str:
    return f"{store.rstrip('/')}/_pending"


def record(spark: SparkSession, store: str, years: Sequence[int]) -> None:
    if years:
        path = f"{_folder(store)}/{uuid.uuid4().hex}"
        spark.createDataFrame([(int(y),) for y in years], SCHEMA).coalesce(1).write.parquet(path)


def marks(spark: SparkSession, store: str) -> list[str]:
    """Finished marks only: an unfinished one means its load had not begun to append."""
    folder = _folder(store)
    return [f"{folder}/{n}" for n in files.children(spark, folder) if files.exists(spark, f"{folder}/{n}/_SUCCESS")]


def years(spark: SparkSession, found: Sequence[str]) -> list[int]:
    if not found:
        return []
    return sorted(r["year"] for r in spark.read.schema(SCHEMA).parquet(*found).distinct().collect())


def clear(spark: SparkSession, found: Sequence[str]) -> None:
    for path in found:
        files.delete(spark, path)
