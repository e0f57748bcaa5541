"""From raw documents to packed training sequences, in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame around one operator of
casewatch.llm; its result is written as Parquet and read again as the next one's docs. All
but the last return the columns of their input, whatever they are; nulls, repeated rows and empty
tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.llm.common import KEY, file_backed, whole_rows, without_rows, written
from casewatch.llm.exact_dedup import exact_dedup
from casewatch.llm.mixing import mix
from casewatch.llm.packing import pack_documents
from casewatch.llm.quality_classifier import quality_posteriors
from casewatch.llm.simhash import simhash_groups


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    docs = file_backed(docs)
    rated = quality_posteriors(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return without_rows(docs, rated.filter(~F.col("kept")), "rejected")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    docs = file_backed(docs)
    return without_rows(docs, exact_dedup(docs).filter(~F.col("kept")), "copies")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates."""
    docs = file_backed(docs)
    return without_rows(docs, simhash_groups(docs).filter(~F.col("kept")), "near-copies")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix has it: not at all, once or more."""
    docs = file_backed(docs)
    copies = written(mix(docs).filter("copies > 0").select(*KEY, "copies"), "copies")
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return whole_rows(docs).join(copies.hint("merge"), KEY).select("row", times.alias("copy")).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all rows and their places in sequences."""
    return pack_documents(docs).drop(*KEY)


STAGES = [
    ("quality_classifier", classify),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack),
]

#: The classifier's model, the random rounding and the tokenizer have no SQL; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
