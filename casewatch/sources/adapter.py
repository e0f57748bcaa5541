"""Test tables -> raw weekly records.

The shared test data has no surveillance table, so raw records are derived
from `lineitem` by expressions that both Spark and the SQL oracle can run
(see FIXTURES.md section 2). Each lineitem row becomes one raw record, so the
work grows with the table. The two small lookups are literal arrays indexed
by a modulus: a projection, not a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import hashlib
import threading

from pyspark.sql import types as T

from casewatch.operators.dedup import DEALT
from casewatch.reference_data import DISEASE_LIST, STATE_DIVISION
from casewatch.schemas import RAW, RAW_COLUMNS
from casewatch.session import application_id, checkpoint_root, default_parallelism
from casewatch.sources.files import exists, fingerprint
from casewatch.sources.tables import open_writers

# 50 states + DC in alphabetical order, title case, then four jurisdictions
# that have no division and must be dropped by staging.
ADAPTER_STATES: list[str] = [s.title().replace(" Of ", " of ") for s in sorted(STATE_DIVISION)] + [
    "Total", "New England", "New York City", "Puerto Rico",
]
# The seed names, then a total row (dropped), a run-together spelling that
# staging repairs, and a padded spelling that trims to an existing name.
ADAPTER_LABELS: list[str] = DISEASE_LIST + [
    "Hepatitis B, acute, Total",
    "SALMONELLAPARATYPHI infection",
    "  Mumps\t ",
]


def pick(values: list[str], key: Column) -> Column:
    """The value at position key % len(values) of a literal list (a projection, no join)."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (key % len(values) + 1).cast("int"))


def _s(c: Column) -> Column:
    return c.cast("string")


def raw_records(li: DataFrame) -> DataFrame:
    """Map lineitem rows to the raw record shape (plus `l_shipdate` for load times)."""
    qty = F.floor("l_quantity").cast("long")
    price = F.floor("l_extendedprice").cast("long")
    coords = F.when(F.col("l_orderkey") % 3 == 0, F.lit(None)).otherwise(
        F.array(
            (F.lit(-70.25) - F.col("l_orderkey") % 50).cast("double"),
            (F.lit(25.25) + F.col("l_orderkey") % 24).cast("double"),
        )
    )
    return li.select(
        pick(ADAPTER_STATES, F.col("l_orderkey")).alias("states"),
        _s(F.lit(2022) + F.year("l_shipdate") % 5).alias("year"),
        _s((F.lit(1) + F.floor((F.dayofyear("l_shipdate") - 1) / 7)).cast("long")).alias("week"),
        pick(ADAPTER_LABELS, F.col("l_partkey")).alias("label"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string")).otherwise(_s(qty)).alias("m1"),
        _s(price % 60).alias("m2"),
        _s(qty * F.col("l_linenumber")).alias("m3"),
        _s(price % 500).alias("m4"),
        F.when(F.col("l_returnflag") == "A", "-").when(F.col("l_returnflag") == "R", "U").alias("m1_flag"),
        *[F.when(F.col("l_linestatus") == "F", "--").alias(f"m{i}_flag") for i in (2, 3, 4)],
        F.concat_ws(
            "|",
            _s(F.col("l_orderkey")), _s(F.col("l_linenumber")), _s(F.col("l_partkey")),
            _s(F.col("l_suppkey")), _s(F.floor(F.col("l_extendedprice") * 100).cast("long")), _s(qty),
        ).alias("sort_order"),
        coords.alias("geocode_coordinates"),
        F.col("l_shipdate"),
    )


#: Rows of one task of a dealt scan.
ROWS_PER_TASK = 1_000_000


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a scan whose rows lie in too few of its splits.

    The shared test tables are single-row-group files: however many splits
    their bytes make, all rows are read by one task. The rows of each split are
    counted (a count reads no column) and the scan is dealt to as many tasks as
    its rows need, one per core at least, when one split has more than twice a
    core's share. Beyond the cores they are DEALT at most: for more, the task
    that reads the one split would gather its rows in memory. Rows that lie
    evenly already are left alone (no shuffle).
    """
    cores = default_parallelism(df.sparkSession)
    split = df.groupBy(F.spark_partition_id().alias("split")).count()
    rows, largest = split.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    return df.repartition(max(cores, min(-(-rows // ROWS_PER_TASK), DEALT)), key) if largest * cores > 2 * rows else df


# Bump when the derivation changes, so stored copies are rebuilt.
ADAPTER_VERSION = "1"


_WRITE_LOCK = threading.Lock()


def input_key(spark: SparkSession, sf_dir: str) -> str:
    """Names what a stored copy was made from: this application, and the input's files with their
    sizes and times. Another application, or a rewritten input, gets another copy."""
    found = fingerprint(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    return hashlib.sha1(f"{found}|{ADAPTER_VERSION}|{application_id(spark)}".encode()).hexdigest()[:16]


def raw_table_path(spark: SparkSession, sf_dir: str) -> str:
    """One stored copy per input and application (no two drivers share a path)."""
    return f"{checkpoint_root(spark).rstrip('/')}/casewatch/raw-{input_key(spark, sf_dir)}"


def raw_from_lineitem(spark: SparkSession, sf_dir: str, keep_shipdate: bool = False) -> DataFrame:
    """Raw weekly records derived from the test tables, stored like a production raw table.

    The derivation is written once per input and application as Parquet
    partitioned by year under the shared checkpoint folder (a finished write
    leaves a _SUCCESS marker; anything else is rewritten) and read back with
    the declared schema. Readers then scan a multi-file, year-partitioned table:
    parallel splits, partition pruning and pushed filters, as in production.
    """
    path = raw_table_path(spark, sf_dir)
    with _WRITE_LOCK:
        if not exists(spark, f"{path}/_SUCCESS"):
            li = spread(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_orderkey")
            with open_writers(spark):
                raw_records(li).write.mode("overwrite").partitionBy("year").parquet(path)
    cols = RAW_COLUMNS + (["l_shipdate"] if keep_shipdate else [])
    schema = T.StructType(list(RAW.fields) + [T.StructField("l_shipdate", T.TimestampNTZType(), True)])
    return spark.read.schema(schema).parquet(path).select(*cols)
