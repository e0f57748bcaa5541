"""Exact dedup by deterministic block naming.

A text (A-Z lower-cased, UTF-8) is cut into blocks of a fixed number of bytes. The
distinct blocks are sorted and numbered; then the names of adjacent blocks are paired,
the distinct pairs sorted and numbered, and so on until one name is left per document.
Two texts have the same (level, name) exactly when they are equal: no step trusts a hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import KEY, drop_written, keyed, written

BLOCK_BYTES = 4096


def _blocks(text: bytes, size: int) -> list[bytes]:
    return [text[i:i + size] for i in range(0, len(text), size)] or [b""]


def _hash(block: bytes, bits: int) -> int:
    """A signed 64-bit number made of the first `bits` bits of the block's hash."""
    return (xxhash.xxh64_intdigest(block) >> (64 - bits)) - (1 << (bits - 1))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    lowered = pc.ascii_lower(batch.column("text").fill_null(""))
    return lowered.cast(pa.binary()).to_pylist()


def _digests(size: int, bits: int):
    """Rows (key, doc_id, sha, block hashes), one per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = _texts(b)
            yield pa.RecordBatch.from_arrays(
                [b.column("kf"), b.column("kr"), b.column("doc_id"),
                 pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                 pa.array([[_hash(x, bits) for x in _blocks(t, size)] for t in texts], pa.list_(pa.int64()))],
                names=["kf", "kr", "doc_id", "sha", "hashes"])
    return run


def _contents(size: int, bits: int, places: bool):
    """Rows (hash, block), each block once per batch; with `places`, one row per key and position."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if places:
                rows = [(f, r, i, _hash(x, bits), x) for f, r, t in zip(
                    b.column("kf").to_pylist(), b.column("kr").to_pylist(), _texts(b), strict=True)
                    for i, x in enumerate(_blocks(t, size))]
                cols = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(),) * 2 + (pa.int32(), pa.int64(), pa.binary()), strict=True)],
                    names=["kf", "kr", "pos", "h", "block"])
            else:
                found = list({x for t in _texts(b) for x in _blocks(t, size)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_hash(x, bits) for x in found], pa.int64()), pa.array(found, pa.binary())],
                    names=["h", "block"])
    return run


def _named(distinct: DataFrame, order: list[str]) -> DataFrame:
    """Distinct rows, sorted within their partition and numbered."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def block_names(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """One row per row of `docs`: kf, kr, doc_id, sha, level, name.

    Whole blocks are shuffled once, to be sorted and named (the partial aggregation
    first reduces each task's equal blocks to one). The names travel back over the blocks'
    64-bit hashes; where distinct blocks share a hash, over the blocks themselves.
    """
    texts = keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = written(texts.mapInArrow(
        _digests(block_bytes, hash_bits), "kf long, kr long, doc_id long, sha string, hashes array<long>"), "digests")
    contents = texts.select("text").mapInArrow(_contents(block_bytes, hash_bits, False), "h long, block binary")
    names = written(_named(contents.distinct(), ["h", "block"]).select("h", "name"), "block-names")

    shared = names.groupBy("h").count().filter("count > 1").select("h")
    places = rows.select(*KEY, F.size("hashes").alias("n"), F.posexplode("hashes").alias("pos", "h"))
    if shared.isEmpty():
        level = places.join(names, "h").select(*KEY, "n", "pos", "name")
    else:
        shared = written(shared, "shared")
        apart = texts.select(*KEY, "text").mapInArrow(
            _contents(block_bytes, hash_bits, True), "kf long, kr long, pos int, h long, block binary"
        ).join(shared, "h", "left_semi")
        apart = written(apart, "apart")
        apart_names = written(_named(apart.select("h", "block").distinct(), ["h", "block"])
                              .withColumn("name", -1 - F.col("name")), "apart-names")
        level = places.join(shared, "h", "left_anti").join(names, "h").select(*KEY, "n", "pos", "name").union(
            places.select(*KEY, "n", "pos").join(
                apart.join(apart_names, ["h", "block"]).select(*KEY, "pos", "name"), [*KEY, "pos"])
            .select(*KEY, "n", "pos", "name"))

    most = rows.agg(F.max(F.size("hashes"))).first()[0] or 1
    level, depth, whole = written(level, "level"), 0, []
    while True:
        whole.append(level.filter("n = 1").select(*KEY, F.lit(depth).alias("level"), "name"))
        if most == 1:
            break
        most, depth = (most + 1) // 2, depth + 1
        left = F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a")
        # A last block without a partner is paired with the null name.
        right = F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("b")
        pairs = written(
            level.filter("n > 1")
            .groupBy(*KEY, F.expr("cast(pos div 2 as int)").alias("pos"))
            .agg(F.expr("cast(max((n + 1) div 2) as int)").alias("n"), left, right), "pairs")
        pair_names = written(_named(pairs.select("a", "b").distinct(), ["a", "b"]), "pair-names")
        joined = pairs.alias("p").join(
            pair_names.alias("q"), F.expr("p.a = q.a and p.b <=> q.b")).select(*KEY, "n", "pos", "name")
        level = written(joined, "level")
        drop_written(pairs)
        drop_written(pair_names)
    found = whole[0]
    for x in whole[1:]:
        found = found.union(x)
    return rows.select(*KEY, "doc_id", "sha").join(found, KEY)


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """Groups of equal texts: kf, kr, doc_id, keep_id, group_size, kept, text_sha256.

    Reads `doc_id` and `text` of `docs`; other columns are ignored, whatever their names.
    A null text counts as empty, and empty texts are equal to each other. The row with the
    largest doc_id stays; among rows that repeat that doc_id, one of them; null ids come
    last. An empty table gives an empty result.
    """
    named = written(block_names(docs, block_bytes, hash_bits), "named")
    best = F.max(F.struct("doc_id", "kf", "kr")).alias("best")
    groups = written(named.groupBy("level", "name").agg(F.count("*").alias("group_size"), best), "groups")
    # Both sides are written tables, so a group that holds a third of the rows is split at run time.
    return named.join(groups, ["level", "name"]).select(
        *KEY, "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        ((F.col("kf") == F.col("best.kf")) & (F.col("kr") == F.col("best.kr"))).alias("kept"),
        F.col("sha").alias("text_sha256"))
