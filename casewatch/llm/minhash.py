"""MinHash near-dedup with odd sketches.

A document is the set of its distinct word shingles. `BANDS` bands of `ROWS` minimum hashes bring
documents together that may be linked; an odd sketch, the parity bitmap of all the minimum hashes,
tells from the population count of an XOR which of them can't be as similar as wanted; what remains
is confirmed on the full sets.

At similarity 0.8 a pair shares no band with probability 1e-11 and is turned down by its sketches
with probability `TAIL`; nothing else is left to chance (shingles are compared by 64-bit hashes).
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import KEY, components, drop_written, keyed, written

WORDS = 4
SIMILAR = 80  # percent
BANDS = 48
ROWS = 4
#: Bits of an odd sketch.
BITS = 512
#: Chance that sketches turn down a pair of just the wanted similarity.
TAIL = 1e-11
#: Members of a band's group that are compared with each other in one task.
GROUP = 1024
#: A larger group is divided by each of the next so many bands, at most LEVELS times.
NEXT_BANDS = 8
LEVELS = 3
#: Sets, and bytes of them, that are compared with each other in one task when candidates are left after the forests.
BLOCK = 4096
BLOCK_BYTES = 32 << 20
#: Shingles that a larger share of a block's sets holds are counted by matrix products, the others pair by pair.
DENSE = 1 / 64
_CHUNK = 1 << 20


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; the whole of a shorter text is one."""
    tokens = text.lower().split()  # bytes: A-Z only, and the white space of the contract
    if not tokens:
        return np.zeros(0, np.uint64)
    k, joined = min(words, len(tokens)), b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[:len(tokens) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)
    digest, parts = xxhash.xxh64_digest, []
    while part := [digest(joined[a:b], 42) for a, b in itertools.islice(spans, _CHUNK)]:
        parts.append(np.unique(np.frombuffer(b"".join(part), ">u8").astype(np.uint64)))
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


@cache
def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(12).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def minimum_hashes(sets: list[np.ndarray], n: int) -> np.ndarray:
    """(sets, n) minimum hashes of non-empty sets: the least product with each of n odd multipliers."""
    values = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out, product = np.empty((len(sets), n), np.uint64), np.empty_like(values)
    for i, m in enumerate(_multipliers(n)):
        np.multiply(values, m, out=product)
        out[:, i] = np.minimum.reduceat(product, starts)
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit."""
    for shift, m in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53), (33, 1)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(m)
    return x


def odd_sketches(hashes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """(sets, bits / 64) words: bit b tells whether an odd number of (sample number, hash) pairs fall on b."""
    spots = (_mix(hashes ^ _mix(np.arange(1, hashes.shape[1] + 1, dtype=np.uint64))) % np.uint64(bits)).astype(np.int64)
    rows = np.arange(len(hashes))[:, None] * bits
    odd = np.bincount((rows + spots).ravel(), minlength=len(hashes) * bits).astype(np.uint8) & 1
    return np.packbits(odd.reshape(len(hashes), bits), axis=1, bitorder="little").view(np.uint64)


def bands(hashes: np.ndarray, rows: int) -> np.ndarray:
    """(sets, bands) names of the bands' values; a band's number is part of the name."""
    n = hashes.shape[1] // rows
    out = _mix(np.broadcast_to(np.arange(1, n + 1, dtype=np.uint64), (len(hashes), n)))
    for r in range(rows):
        out = _mix(out ^ hashes[:, r::rows][:, :n])
    return out


@cache
def most_odd_bits(samples: int, bits: int, similar: float, tail: float) -> int:
    """The largest XOR count worth confirming: sketches of sets of this similarity pass it with chance `tail`.

    A sample that differs puts two pairs on the bitmap; the number of odd bits after so many pairs is a
    random walk, whose distribution is computed step by step.
    """
    odd, total = np.zeros(bits + 1), np.zeros(bits + 1)
    odd[0], s = 1.0, np.arange(bits + 1)
    differ = similar ** samples  # chance of no difference, then of one, ...
    for d in range(samples + 1):
        total += differ * odd
        differ *= (samples - d) / (d + 1) * (1 - similar) / similar
        for _ in range(2):
            odd = np.append(0, (odd * (bits - s) / bits)[:-1]) + np.append((odd * s / bits)[1:], 0)
    above = np.cumsum(total[::-1])[::-1]
    return int(np.flatnonzero(above > tail)[-1])


def _groups_of(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, shingle sets) of runs of texts that are hashed together."""
    first, sets, total = 0, [], 0
    for i, text in enumerate(batch.column("text").fill_null("").cast(pa.binary())):
        sets.append(shingles(text.as_py(), words))
        total += len(sets[-1])
        if total > _CHUNK:
            yield first, sets
            first, sets, total = i + 1, [], 0
    if sets:
        yield first, sets


def _long_lists(a: np.ndarray, empty: np.ndarray) -> pa.Array:
    """Rows of a as lists of longs; empty lists where told."""
    lengths = np.where(empty, 0, a.shape[1])
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.array(a[~empty].ravel().view(np.int64)))


def _signatures(words: int, n_bands: int, rows: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, sets in _groups_of(b, words):
                n = np.array([len(s) for s in sets], np.int64)
                hashes = minimum_hashes([s if len(s) else np.zeros(1, np.uint64) for s in sets], n_bands * rows)
                digest = np.frombuffer(b"".join(blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64).reshape(-1, 2)
                part = b.slice(first, len(sets))
                yield pa.RecordBatch.from_arrays(
                    [part.column("kf"), part.column("kr"), part.column("doc_id"), pa.array(n), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()),
                     _long_lists(bands(hashes, rows), n == 0), _long_lists(odd_sketches(hashes, bits), n == 0)],
                    names=["kf", "kr", "doc_id", "n", "d1", "d2", "bands", "sketch"])
    return run


def _full_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, sets in _groups_of(b, words):
                yield pa.RecordBatch.from_arrays([b.column("e").slice(first, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], names=["e", "full"])
    return run


def _confirmed(similar: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column("full_u"), b.column("full_v"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= similar * (len(x) + len(y) - both))
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("u").filter(ok), b.column("v").filter(ok)], names=["u", "v"])
    return run


class _Forest:
    """Disjoint sets of numbers; the smallest names its set."""

    def __init__(self) -> None:
        self.root: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (up := self.root.get(x, x)) != x:
            self.root[x] = x = self.root.get(up, up)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.root[max(a, b)] = min(a, b)
        return a != b


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that come sorted by column g, cut so that no group goes on in the next batch."""
    rest = None
    for b in batches:
        if not len(b):
            continue
        whole = pa.Table.from_batches([b] if rest is None else [rest, b]).combine_chunks().to_batches()[0]
        g = whole.column("g").to_numpy(zero_copy_only=False)
        other = np.flatnonzero(g != g[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield whole.slice(0, cut)
        rest = whole.slice(cut)
    if rest is not None:
        yield rest


def _candidates(limit: int, similar: int, by_element: bool):
    """Pairs of different components in a group whose sizes and sketches allow a link, thinned to a spanning
    forest: of components, or of the elements themselves (which then names every element that has a candidate)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest()
        for b in _sorted_groups(batches):
            g, e, root, n = (b.column(c).to_numpy(zero_copy_only=False) for c in ("g", "e", "root", "n"))
            sketch = b.column("sketch").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(b), -1)
            starts = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
            last = np.repeat(np.append(starts[1:], len(g)), np.diff(np.append(starts, len(g))))
            ends, us, vs, i, step = e if by_element else root, [], [], np.arange(len(g)), 0
            while True:
                step += 1
                i = i[i + step < last[i]]
                if not len(i):
                    break
                j = i + step
                ok = (root[i] != root[j]) & (100 * np.minimum(n[i], n[j]) >= similar * np.maximum(n[i], n[j]))
                a, c = i[ok], j[ok]
                near = np.bitwise_count(sketch[a] ^ sketch[c]).sum(axis=1, dtype=np.int64) <= limit
                for x, y in zip(a[near].tolist(), c[near].tolist(), strict=True):
                    if forest.join(int(ends[x]), int(ends[y])):
                        us.append(max(e[x], e[y]))
                        vs.append(min(e[x], e[y]))
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])
    return run


def common_shingles(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, sets) how many shingles each two sets share."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, shingle, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(shingle, kind="stable")
    owner, times = owner[order], times[shingle[order]]
    out = np.zeros((m, m), np.float32)
    many = times > max(2, m * DENSE)
    column = np.cumsum(np.append(0, np.diff(shingle[order][many]) != 0)) if many.any() else np.zeros(0, np.int64)
    rows = owner[many]
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, m):  # as many columns as rows at once
        a, b = np.searchsorted(column, [first, first + m])
        block = np.zeros((m, m), np.float32)
        block[rows[a:b], column[a:b] - first] = 1
        out += block @ block.T
    few = ~many & (times > 1)
    owner, name, flat = owner[few], shingle[order][few], out.ravel()
    step = 0
    while True:
        step += 1
        same = np.flatnonzero(name[step:] == name[:-step]) if step < len(name) else np.zeros(0, np.int64)
        if not len(same):
            return out
        x, y = owner[same].astype(np.int64), owner[same + step].astype(np.int64)
        np.add.at(flat, x * m + y, 1)
        np.add.at(flat, y * m + x, 1)


def _links_in_blocks(similar: int):
    """One confirmed link for each two components that a block or two blocks of sets connect."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest()
        for b in _sorted_groups(batches):
            g = b.column("g").to_numpy(zero_copy_only=False)
            starts = [*np.flatnonzero(np.append(True, g[1:] != g[:-1])).tolist(), len(g)]
            us, vs = [], []
            for first, end in itertools.pairwise(starts):
                part = b.slice(first, end - first)
                e, root = (part.column(c).to_numpy(zero_copy_only=False) for c in ("e", "root"))
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in part.column("full")]
                n = np.array([len(s) for s in sets], np.float64)
                both = common_shingles(sets).astype(np.float64)
                x, y = np.nonzero((100 * both >= similar * (n[:, None] + n[None, :] - both)) & (root[:, None] < root[None, :]))
                _, once = np.unique(np.stack([root[x], root[y]], axis=1), axis=0, return_index=True)
                for i, j in zip(x[once].tolist(), y[once].tolist(), strict=True):
                    if forest.join(int(root[i]), int(root[j])):
                        us.append(max(e[i], e[j]))
                        vs.append(min(e[i], e[j]))
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])
    return run


class NearLinks:
    """Links between distinct sets, from bands to confirmed pairs.

    `sets` has e (long), n, bands, sketch; `full` has e and the full set of every e that shares a band.
    """

    def __init__(self, sets: DataFrame, members: DataFrame, full: DataFrame, similar: int, limit: int, group: int):
        self.sets, self.members, self.full = sets, members, full
        self.similar, self.limit, self.group = similar, limit, group

    def possible(self, pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) that sizes and sketches allow."""
        def info(side: str) -> DataFrame:
            return self.sets.select(F.col("e").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))
        odd = F.aggregate(F.zip_with("sketch_u", "sketch_v", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")), F.lit(0), lambda s, x: s + x)
        sizes = 100 * F.least("n_u", "n_v") >= self.similar * F.greatest("n_u", "n_v")
        return pairs.join(info("u"), "u").join(info("v"), "v").filter(sizes).filter(odd <= self.limit).select("u", "v")

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full sets are similar enough."""
        full_u, full_v = (self.full.select(F.col("e").alias(s), F.col("full").alias(f"full_{s}")) for s in "uv")
        return written(pairs.join(full_u, "u").join(full_v, "v").select("u", "v", "full_u", "full_v")
                       .mapInArrow(_confirmed(self.similar), "u long, v long"), "links")

    def stars(self) -> DataFrame:
        """Every member of a group with the group's least one."""
        return self.members.filter("e != low").select(F.col("e").alias("u"), F.col("low").alias("v")).distinct()

    def open_groups(self, roots: DataFrame) -> DataFrame:
        """g, e, root, n, sketch of groups of at most about `group` members (some of two blocks of them)
        that hold every pair of different components that shares a band.

        A group of one component is done. A larger one is divided by further bands, which a pair near
        enough shares too; one that these don't divide, or whose most frequent component leaves few
        others, is cut into blocks, and the others meet each block.
        """
        todo = self.members.select("g", "at", "e").join(roots, "e", "left").withColumn("root", F.coalesce("root", "e"))
        out, level = None, 0
        while True:
            todo = written(todo, "open")
            sizes = todo.groupBy("g", "root").count().groupBy("g").agg(
                F.sum("count").alias("size"), F.count("*").alias("roots"), F.max(F.struct("count", "root")).alias("most"))
            sizes = written(sizes.filter("roots > 1").select("g", "size", (F.col("size") - F.col("most.count")).alias("others"), F.col("most.root").alias("most")), "sizes")
            light = todo.join(sizes.filter(F.col("size") <= self.group), "g").select("g", "e", "root")
            out = light if out is None else out.union(light)
            heavy = todo.join(sizes.filter(F.col("size") > self.group), "g")
            cut = F.lit(level >= LEVELS) | (F.col("others") <= self.group)
            out = out.union(self._blocks(heavy.filter(cut)))
            divided = heavy.filter(~cut)
            if divided.isEmpty():
                return out.join(self.sets.select("e", "n", "sketch"), "e")
            step = F.explode(F.sequence(F.lit(1), F.lit(NEXT_BANDS)))
            todo = (divided.select("g", "at", "e", "root").join(self.sets.select("e", "bands"), "e").withColumn("step", step)
                    .withColumn("at", ((F.col("at") + F.col("step")) % F.size("bands")).cast("int"))
                    .select(F.xxhash64("g", "at", F.element_at("bands", F.col("at") + 1)).alias("g"), "at", "e", "root"))
            level += 1

    def _blocks(self, heavy: DataFrame) -> DataFrame:
        """Members in blocks; the members outside the most frequent component, in blocks too, meet every block."""
        def count(size: Column) -> Column:
            return F.ceil(size / F.lit(self.group)).cast("int")
        block, other = F.pmod(F.xxhash64("e"), count(F.col("size"))), F.pmod(F.xxhash64("e"), count(F.col("others")))
        here = heavy.withColumn("i", block).withColumn("j", F.explode(F.sequence(F.lit(0), count(F.col("others")) - 1)))
        there = heavy.filter("root != most").withColumn("j", other).withColumn("i", F.explode(F.sequence(F.lit(0), count(F.col("size")) - 1)))
        return here.select("g", "i", "j", "e", "root").union(there.select("g", "i", "j", "e", "root")).distinct().select(
            F.xxhash64("g", "i", "j").alias("g"), "e", "root")

    def open_pairs(self, roots: DataFrame, by_element: bool) -> DataFrame:
        groups = self.open_groups(roots).repartition("g").sortWithinPartitions("g", "e").select("g", "e", "root", "n", "sketch")
        return written(groups.mapInArrow(_candidates(self.limit, self.similar, by_element), "u long, v long").distinct(), "pairs")

    def links_left(self, pairs: DataFrame, roots: DataFrame) -> DataFrame:
        """Links between the sets that `pairs` (u, v) connect, all of them compared: each set meets those it is
        connected with in blocks, so it is sent to a task as often as there are blocks of them."""
        linked = components(pairs).withColumnRenamed("node", "e")
        near = linked.withColumnRenamed("root", "near").union(linked.select(F.col("root").alias("e"), F.col("root").alias("near")).distinct())
        near = written(near.join(self.full.select("e", F.length("full").cast("long").alias("bytes")), "e"), "near")
        blocks = near.groupBy("near").agg(F.ceil(F.greatest(F.count("*") / F.lit(BLOCK), F.sum("bytes") / F.lit(BLOCK_BYTES))).cast("int").alias("blocks"))
        own, other = F.pmod(F.xxhash64("e"), F.col("blocks")), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        placed = near.join(blocks, "near").withColumn("own", own.cast("int")).withColumn("other", other)
        # Each two blocks are one group; a single block, or one of two blocks with itself, is a group within that of two.
        placed = placed.filter((F.col("own") != F.col("other")) | (F.col("blocks") == 1)).select(
            F.xxhash64("near", F.least("own", "other"), F.greatest("own", "other")).alias("g"), "e")
        rows = placed.join(roots, "e", "left").withColumn("root", F.coalesce("root", "e")).join(self.full, "e")
        return written(rows.repartition("g").sortWithinPartitions("g", "e").select("g", "e", "root", "full")
                       .mapInArrow(_links_in_blocks(self.similar), "u long, v long"), "links")

    def find(self) -> DataFrame:
        """Links (u, v), all confirmed, that connect the sets as all links do."""
        links = self.confirm(written(self.possible(self.stars()), "tested"))
        roots = components(links).withColumnRenamed("node", "e")
        pairs = self.open_pairs(roots, by_element=False)
        found = self.confirm(pairs)
        links = links.union(found)
        if pairs.count() == found.count():  # a forest of confirmed links hides no other
            return links
        roots = components(links).withColumnRenamed("node", "e")
        return links.union(self.links_left(self.open_pairs(roots, by_element=True), roots))


def near_links(sets: DataFrame, full_sets: Callable[[DataFrame], DataFrame], limit: int, similar: int = SIMILAR, group: int = GROUP) -> DataFrame:
    """Links (u, v) between the distinct sets `sets` (e, n, bands, sketch); full_sets(elements) gives their full sets."""
    entries = sets.select("e", F.posexplode("bands").alias("at", "g"))
    groups = written(entries.groupBy("g").agg(F.count("*").alias("size"), F.min("e").alias("low")).filter("size > 1").select("g", "low"), "groups")
    members = written(entries.join(groups, "g").select("g", "at", "e", "low"), "members")
    full = written(full_sets(members.select("e").distinct()), "full-sets")
    return NearLinks(sets, members, full, similar, limit, group).find()


def minhash_groups(docs: DataFrame, words: int = WORDS, similar: int = SIMILAR, n_bands: int = BANDS, rows: int = ROWS,
                   bits: int = BITS, group: int = GROUP) -> DataFrame:
    """Near-duplicate groups: kf, kr, doc_id, n_shingles, component_id, kept.

    Reads `doc_id` and `text` of `docs`; other columns are ignored. Documents are linked when their
    sets of distinct shingles of `words` words have a Jaccard similarity of `similar` percent or more; a
    text with fewer words is one shingle, a text without words (null, empty, white space) is linked
    with nothing, its own group. component_id is the smallest doc_id that links lead to (null only if
    no row there has an id); `kept` marks one row of each group: the one with that id, the first by key
    if several rows repeat it. An empty table gives an empty result.
    """
    texts = keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    read = written(texts.mapInArrow(_signatures(words, n_bands, rows, bits), "kf long, kr long, doc_id long, n long, d1 long, d2 long, "
                                    "bands array<long>, sketch array<long>"), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "kf", "kr")).alias("first")
    sets = written(read.filter("n > 0").groupBy("d1", "d2").agg(first, F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
                   .withColumn("e", F.monotonically_increasing_id()), "sets")

    def full_sets(elements: DataFrame) -> DataFrame:
        at = elements.join(sets, "e").select("e", F.col("first.kf").alias("kf"), F.col("first.kr").alias("kr"))
        return texts.select(*KEY, "text").join(written(at, "elements").hint("merge"), KEY).select("e", "text").mapInArrow(_full_sets(words), "e long, full binary")

    limit = most_odd_bits(n_bands * rows, bits, similar / 100, TAIL)
    linked = components(near_links(sets, full_sets, limit, similar, group))
    roots = written(sets.join(linked, sets["e"] == linked["node"], "left").select("d1", "d2", "first", F.coalesce("root", "e").alias("root")), "roots")
    best = written(roots.groupBy("root").agg(F.min("first").alias("best")), "best")
    of = written(roots.join(best, "root").select("d1", "d2", "best"), "set-group")
    drop_written(best)
    # Two written tables: a text that a third of the rows share is split at run time.
    grouped = read.filter("n > 0").join(of, ["d1", "d2"]).select(
        *KEY, "doc_id", "n", F.col("best.doc_id").alias("component_id"), ((F.col("kf") == F.col("best.kf")) & (F.col("kr") == F.col("best.kr"))).alias("kept"))
    alone = read.filter("n = 0").select(*KEY, "doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return grouped.union(alone).withColumnRenamed("n", "n_shingles")
