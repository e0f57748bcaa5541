"""Seed lookups: the disease list and the holiday weeks.

Without a path they are built from the fixed values in `reference_data`
(a few dozen literal rows carried in the plan). With a path they are read
from CSV with a header and a declared schema, from shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casewatch import schemas
from casewatch.reference_data import DISEASE_LIST, US_HOLIDAYS


def _csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def disease_list(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path:
        return _csv(spark, path, schemas.DISEASE_LIST)
    return spark.createDataFrame([(n,) for n in DISEASE_LIST], schemas.DISEASE_LIST)


def us_holidays(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path:
        return _csv(spark, path, schemas.US_HOLIDAYS)
    return spark.createDataFrame(US_HOLIDAYS, schemas.US_HOLIDAYS)


def load_seeds(spark: SparkSession, disease_path: str | None = None,
               holidays_path: str | None = None) -> dict[str, DataFrame]:
    return {
        "disease_list": disease_list(spark, disease_path),
        "us_holidays": us_holidays(spark, holidays_path),
    }
