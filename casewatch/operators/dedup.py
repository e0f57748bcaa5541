"""Keep-first deduplication and the null-safe anti-join used for idempotent loads."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN, _KEY, _SALT = "__rn", "__key_hash", "__salt"
#: Partitions that the rows of one key are dealt to before the last shuffle, which gets one row of each. More
#: would part a frequent key further, but send up to that many rows of every key to the last sort.
SALTS = 2
#: The same without adaptive execution, where nothing else parts a frequent key.
UNCUT_SALTS = 8
#: Partitions of the first deal, before adaptive execution cuts them. Up to this many (Spark's default
#: spark.shuffle.sort.bypassMergeThreshold) a task writes its rows straight to the partitions' files;
#: for more it gathers them in memory first, a whole scan split.
DEALT = 200


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by `order` (give a total order to be deterministic).

    Nulls in keys group together. The rows are dealt by key and a salt, so a
    task does not sort a whole scan split, and a key's rows meet there: the
    last sort gets one row per key, salt and cut. They are dealt as a rebalance:
    adaptive execution cuts a partition above its advisory size into several
    tasks, so what a task sorts is bounded by that size, however many rows
    there are for how few shuffle partitions, and however many copies of one
    row there are (the salt can't part these). It starts from DEALT partitions
    whatever the session's number, so the tasks that read the scan hold none of
    its rows. Spark plans row_number()==1 as a partial WindowGroupLimit
    there, before the shuffle by key: a key holding a third of all rows is
    sorted by several tasks and sends one row from each. Both sorts begin
    with a hash of the key, a number, and compare the key's texts only within
    one hash.
    """
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"  # else Spark drops the hint
    salts = SALTS if adaptive else UNCUT_SALTS
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if c not in keys]), F.lit(salts))
    w = Window.partitionBy(_KEY, *keys).orderBy(*order)
    hashed = df.withColumn(_KEY, F.hash(*keys)).withColumn(_SALT, salt)
    dealt = hashed.hint("rebalance", DEALT, _KEY, _SALT) if adaptive else hashed.repartition(_KEY, _SALT)
    return dealt.drop(_SALT).withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN, _KEY)


def distinct_keys(existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct natural keys of a table (map-side partial aggregation first)."""
    return existing.select(*keys).distinct()


def anti_join_new(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `incoming` whose key is absent from `existing`; null matches null.

    The existing side is reduced to its distinct keys first, so a key repeated
    many times in the table cannot skew the join task that owns it.
    """
    renamed = distinct_keys(existing, keys).select(*[F.col(k).alias(f"__e_{k}") for k in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__e_{k}")) for k in keys])
    return incoming.join(renamed, on=cond, how="left_anti")
