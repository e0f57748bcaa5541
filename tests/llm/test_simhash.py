import itertools
import random

import numpy as np
import pytest
import xxhash

from casewatch.llm.simhash import _masks, allocate, correlated_groups, fingerprint, near_links, plan, simhash_groups

from .helpers import ODD, docs, words


def slow_fingerprint(text):
    tokens = text.lower().split() if text.isascii() else text.encode().lower().decode().split()
    shingles = [" ".join(tokens[i:i + 3]) for i in range(len(tokens) - 2)] or ([" ".join(tokens)] if tokens else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for i in range(64):
            ones[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(shingles))


def classes(fps, distance):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= distance:
            root[max(find(a), find(b))] = min(find(a), find(b))
    out = {}
    for f in fps:
        out.setdefault(find(f), set()).add(f)
    return {frozenset(x) for x in out.values()}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def clustered(n, seed=3):
    """Fingerprints with dense and loose clusters, and skewed bits."""
    rng = random.Random(seed)
    out = {0, (1 << 64) - 1}
    while len(out) < n:
        center = rng.getrandbits(64) & rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 1, 60])):
            f = center
            for _ in range(rng.randrange(0, 7)):
                f ^= 1 << rng.randrange(64)
            out.add(f)
    return sorted(out)


@pytest.mark.parametrize("text", ["", " \n", "One", "two words", "Three Words here", "a b c d e f " * 50, "éÉ ß x 你好 B c"])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == slow_fingerprint(text)


@pytest.mark.parametrize(("group", "distance"), [(1024, 3), (16, 3), (1024, 2)])
def test_links_connect_what_all_pairs_connect(spark, group, distance):
    """With a small group size, groups are divided again and again."""
    fps = clustered(700)
    links = near_links(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), distance, group).collect()
    root = {f: {f} for f in fps}
    for r in links:
        u, v = r.u % (1 << 64), r.v % (1 << 64)
        if root[u] is not root[v]:
            root[u] |= root[v]
            for x in root[v]:
                root[x] = root[u]
    assert {frozenset(x) for x in root.values()} == classes(fps, distance)


def test_thresholds_cover_every_pair(spark):
    fps = clustered(300)
    parts = plan(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), len(fps), 3)
    assert sorted(b for bits, _ in parts for b in bits) == list(range(64))
    assert sum(t + 1 for _, t in parts) == 4
    masks = [m % (1 << 64) for m in _masks(parts)]
    rng = random.Random(5)
    for _ in range(300):
        diff = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not diff & m for m in masks)


def test_allocation_is_optimal():
    rng = random.Random(2)
    for _ in range(50):
        costs = [[0.0, *sorted(rng.random() for _ in range(4))] for _ in range(3)]
        best = min(sum(c[t] for c, t in zip(costs, ts, strict=True)) for ts in itertools.product(range(5), repeat=3) if sum(ts) == 4)
        assert abs(allocate(costs, 3)[0] - best) < 1e-12


def test_correlated_bits_share_a_group():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (2000, 64))
    x[:, 16:32] = x[:, [16]] ^ (rng.random((2000, 16)) < 0.05)
    groups = correlated_groups(x.T @ x, len(x), 4)
    assert any(set(range(16, 32)) == set(g) for g in groups)


def test_components_as_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        base = words(rng, 120)
        rows.append((10 * i, base, "en", "s", 0))
        for j in range(1, rng.randrange(1, 6)):
            w = base.split()
            w[rng.randrange(len(w))] = "changed"
            rows.append((10 * i + j, " ".join(w), "en", "s", 0))
    got = {r.doc_id: r for r in simhash_groups(docs(spark, rows)).collect()}
    fps = {r[0]: slow_fingerprint(r[1]) for r in rows}
    assert all(got[d].fingerprint == f"{f:016x}" for d, f in fps.items())
    for c in classes(sorted(set(fps.values())), 3):
        ids = [d for d, f in fps.items() if f in c]
        assert {got[d].component_id for d in ids} == {min(ids)}
        assert [d for d in ids if got[d].kept] == [min(ids)]


def test_odd_rows(spark):
    got = simhash_groups(docs(spark, ODD, clashing=True)).collect()
    assert len(got) == len(ODD)
    blank = [r for r in got if r.doc_id in (1, 2, 3)]
    assert {(r.fingerprint, r.component_id) for r in blank} == {("0" * 16, 1)} and sum(r.kept for r in blank) == 1
    null = [r for r in got if r.doc_id is None]
    assert {r.component_id for r in null} == {None} and sum(r.kept for r in null) == 1
    assert sum(r.kept for r in got if r.fingerprint == f"{slow_fingerprint('same text over here'):016x}") == 1


def test_empty_table(spark):
    assert simhash_groups(docs(spark, [])).collect() == []
