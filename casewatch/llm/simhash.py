"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints at most `distance` bits apart are found with `m` bit partitions that have
unequal thresholds t_i (-1: not probed) with sum(t_i + 1) = distance + 1: two such
fingerprints differ in at most t_i bits of some partition i. Correlated bits share a
partition; the thresholds come from a dynamic program over candidate counts estimated
from all fingerprints.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import KEY, components, drop_written, keyed, written

WORDS = 3
DISTANCE = 3
#: Fingerprints of a probed group that are compared with each other in one task; a larger
#: group is divided further by its remaining bits.
GROUP = 1024
#: Cost of shuffling one signature, in verified candidates.
SIGNATURE_COST = 20.0
_CHUNK = 1 << 19


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The SimHash of a text's word shingles; 0 without words."""
    tokens = text.lower().split()  # bytes: A-Z only, and the white space of the contract
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(tokens))
    spans = zip(starts[:len(tokens) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)
    n, ones = len(tokens) - k + 1, np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    while part := [digest(joined[a:b], 42) for a, b in itertools.islice(spans, _CHUNK)]:
        raw = np.frombuffer(b"".join(part), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").fill_null("").cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("kf"), b.column("kr"), b.column("doc_id"), pa.array(fps)], names=["kf", "kr", "doc_id", "fp"])
    return run


def _bits(fps: np.ndarray) -> np.ndarray:
    """(n, 64) zeros and ones; column i is bit i."""
    return np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: how often bits i and j are both set."""
    total = np.zeros((64, 64), np.int64)
    for b in batches:
        x = _bits(b.column("fp").to_numpy(zero_copy_only=False)).astype(np.float32)
        total += (x.T @ x).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(4096, dtype=np.int32)), pa.array(total.ravel())], names=["cell", "n"])


def correlated_groups(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """64 bits in m groups of (nearly) equal size; each group grows by the bit most correlated with it."""
    p = np.diag(together) / n
    cov = together / n - np.outer(p, p)
    sd = np.sqrt(np.clip(p * (1 - p), 1e-12, None))
    phi = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(phi, 0)
    free, groups = set(range(64)), []
    for size in (64 // m + (i < 64 % m) for i in range(m)):
        group = [max(free, key=lambda b: (phi[b, sorted(free)].sum(), -b))]
        free.discard(group[0])
        while len(group) < size:
            best = max(free, key=lambda b: (phi[b, group].sum(), -b))
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def _distances(p: np.ndarray) -> np.ndarray:
    """Chance that two fingerprints differ in exactly j of these bits, taken as independent."""
    out = np.array([1.0])
    for x in 2 * p * (1 - p):
        out = np.convolve(out, [1 - x, x])
    return out


def _costs(p: np.ndarray, n: int, same: float, distance: int) -> list[float]:
    """Cost of threshold -1..distance on the bits with frequencies p: signatures, and
    candidate pairs estimated from the pairs known to agree on all of the bits (`same`)."""
    d = np.append(_distances(p), np.zeros(distance + 1))
    out = [0.0]
    for t in range(distance + 1):
        pairs = same * d[:t + 1].sum() / max(d[0], 1e-300)
        out.append(SIGNATURE_COST * n * math.comb(len(p), t) + min(pairs, float(n) * n))
    return out


def allocate(costs: list[list[float]], distance: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = distance + 1 and the least total cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for c in costs:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, ts) in best.items():
            for t in range(-1, distance - used + 1):
                now = (cost + c[t + 1], [*ts, t])
                if used + t + 1 not in nxt or now < nxt[used + t + 1]:
                    nxt[used + t + 1] = now
        best = nxt
    return best[distance + 1]


def plan(fps: DataFrame, n: int, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition, from counts over all distinct fingerprints."""
    cells = fps.mapInArrow(_together, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    together = np.zeros(4096, np.int64)
    for r in cells.collect():  # 4096 rows, whatever the input
        together[r["cell"]] = r["n"]
    together = together.reshape(64, 64)
    p = np.diag(together) / n
    groupings = {m: correlated_groups(together, n, m) for m in range(2, distance + 2)}
    rough = {m: allocate([_costs(p[g], n, float(n) * n * _distances(p[g])[0], distance) for g in gs], distance)[0]
             for m, gs in groupings.items()}
    groups = groupings[min(rough, key=lambda m: rough[m])]
    exact = []
    for g in groups:
        same = fps.groupBy(F.col("fp").bitwiseAND(_mask(g))).count().agg(F.sum(F.col("count").cast("double") ** 2))
        exact.append(_costs(p[g], n, same.first()[0], distance))
    return [(g, t) for g, t in zip(groups, allocate(exact, distance)[1], strict=True)]


def _mask(bits) -> int:
    """The bits as one signed long."""
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >> 63 else m


def _masks(partitions: list[tuple[list[int], int]]) -> list[int]:
    """What two fingerprints must agree on: a partition's bits but for any t of them."""
    return [_mask(set(bits) - set(out)) for bits, t in partitions if t >= 0 for out in itertools.combinations(bits, t)]


def _signatures(masks: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column("fp").to_numpy(zero_copy_only=False)
            for m in masks:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fps), m, np.int64)), pa.array(fps & np.int64(m)), pa.array(fps)], names=["mask", "part", "fp"])
    return run


def _divide(distance: int):
    """Split a group by the bits it doesn't agree on yet: any pair of it that is near
    enough also agrees on one of distance + 1 sets of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            masks = b.column("mask").to_numpy(zero_copy_only=False)
            fps = b.column("fp").to_numpy(zero_copy_only=False)
            for m in np.unique(masks):
                rest = [i for i in range(64) if not int(m) >> i & 1]
                own = fps[masks == m]
                for j in range(distance + 1):
                    more = np.int64(int(m) | _mask(rest[j::distance + 1]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), more, np.int64)), pa.array(own & more), pa.array(own)], names=["mask", "part", "fp"])
    return run


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i]; root[x] <= x is the smallest of x's set."""
    while True:
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            return
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root[:] = root[root]


def _verified(mask: np.ndarray, part: np.ndarray, fps: np.ndarray, distance: int) -> pa.RecordBatch:
    """Compare all fingerprints of each group; the links as stars, at most one row per fingerprint."""
    n = len(fps)
    new = np.flatnonzero(np.concatenate(([True], (mask[1:] != mask[:-1]) | (part[1:] != part[:-1]))))
    last = np.repeat(np.append(new[1:], n), np.diff(np.append(new, n)))
    root, i, step = np.arange(n), np.arange(n), 0
    while True:
        step += 1
        i = i[i + step < last[i]]
        if not len(i):
            break
        near = i[np.bitwise_count((fps[i] ^ fps[i + step]).view(np.uint64)) <= distance]
        _unite(root, near, near + step)
    to = np.flatnonzero(root != np.arange(n))
    return pa.RecordBatch.from_arrays([pa.array(fps[to]), pa.array(fps[root[to]])], names=["u", "v"])


def _links(distance: int):
    """Rows come sorted by group; a group that goes on in the next batch is carried over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.empty(0, np.int64)] * 3
        for b in batches:
            cols = [np.concatenate((r, b.column(c).to_numpy(zero_copy_only=False)))
                    for r, c in zip(rest, ("mask", "part", "fp"), strict=True)]
            if not len(cols[0]):
                continue
            other = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = other[-1] + 1 if len(other) else 0
            rest = [c[cut:] for c in cols]
            yield _verified(*(c[:cut] for c in cols), distance)
        yield _verified(*rest, distance)
    return run


def near_links(fps: DataFrame, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """Links (u, v) that connect the distinct fingerprints `fps` (column fp) as all pairs within
    `distance` bits do. No pair is missed: groups over `group` fingerprints are divided further
    by their remaining bits until each is small enough to be compared in one task."""
    n, schema = fps.count(), "mask long, part long, fp long"
    if n < 2:
        return written(fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0), "links")
    todo, links = fps.mapInArrow(_signatures(_masks(plan(fps, n, distance))), schema), None
    while True:
        sizes = written(todo.groupBy("mask", "part").count().filter(F.col("count") > group), "heavy")
        light = todo.join(sizes, ["mask", "part"], "left_anti").select("mask", "part", "fp")
        found = written(light.repartition("mask", "part").sortWithinPartitions("mask", "part", "fp")
                        .mapInArrow(_links(distance), "u long, v long"), "links")
        links = found if links is None else links.union(found)
        if sizes.isEmpty():
            return links
        heavy = todo.join(sizes, ["mask", "part"], "left_semi").select("mask", "part", "fp")
        # Two ways of dividing can lead to the same group: its rows are needed once.
        todo = written(heavy.mapInArrow(_divide(distance), schema).distinct(), "divided")


def simhash_groups(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """Near-duplicate groups: kf, kr, doc_id, fingerprint (16 hex digits), component_id, kept.

    Reads `doc_id` and `text` of `docs`; other columns are ignored. A text without words (null,
    empty, white space) has fingerprint zero and is linked like any other; a text of fewer than
    `words` words is one shingle. component_id is the smallest doc_id that links lead to (null
    only if no row there has an id); `kept` marks one row of each group: the one with that id,
    the first by key if several rows repeat it. An empty table gives an empty result.
    """
    rows = written(
        keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_fingerprints(words), "kf long, kr long, doc_id long, fp long"), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "kf", "kr")).alias("first")
    fps = written(rows.groupBy("fp").agg(first), "distinct-fp")
    links = near_links(fps.select("fp"), distance, group)
    linked = components(links)
    roots = written(fps.join(linked, fps["fp"] == linked["node"], "left")
                    .select("fp", "first", F.coalesce("root", "fp").alias("root")), "roots")
    best = written(roots.groupBy("root").agg(F.min("first").alias("best")), "best")
    of = written(roots.join(best, "root").select("fp", "best"), "fp-group")
    drop_written(best)
    # Two written tables: a fingerprint that a third of the rows share is split at run time.
    return rows.join(of, "fp").select(
        *KEY, "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best.doc_id").alias("component_id"),
        ((F.col("kf") == F.col("best.kf")) & (F.col("kr") == F.col("best.kr"))).alias("kept"))
