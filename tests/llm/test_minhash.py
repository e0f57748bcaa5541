import itertools
import random
import re

import numpy as np
import pytest

from casewatch.llm import minhash
from casewatch.llm.minhash import minhash_groups, minimum_hashes, most_odd_bits, odd_sketches, shingles

from .helpers import ODD, docs, words

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_set(text):
    w = re.findall("[^ \t-\r]+", (text or "").translate(AZ))
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set())


def slow_groups(rows):
    sets = [slow_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    return {i: min((rows[k][0] for k in g if rows[k][0] is not None), default=None) for g in groups.values() for i in g}, sets


def families(seed, n=50, far=60):
    """Documents with copies at every distance around the limit, and chains of them."""
    rng, rows, at = random.Random(seed), [], 0
    for _ in range(n):
        base = words(rng, rng.choice([3, 8, 30, 120]), 3000).split()
        for _ in range(rng.choice([1, 3, 8])):
            rows.append((at, " ".join(base), "en", "s", 0))
            at += 1
            base = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // far * rng.choice([0, 1, 3]) + 1)):
                base[rng.randrange(len(base))] = rng.choice(["Changed", "changed", "x", "été"])
    rng.shuffle(rows)
    return rows


def check(got, rows):
    want, sets = slow_groups(rows)
    by_id = {r[0]: i for i, r in enumerate(rows)}
    assert len(got) == len(rows)
    for r in got:
        i = by_id[r.doc_id]
        assert (r.component_id, r.n_shingles, r.kept) == (want[i], len(sets[i]), want[i] == r.doc_id)


@pytest.mark.parametrize("seed", range(2))
def test_groups_as_brute_force(spark, seed):
    rows = families(seed)
    check(minhash_groups(docs(spark, rows)).collect(), rows)


def test_large_groups_as_brute_force(spark, monkeypatch):
    """With tiny groups, they are divided by further bands and cut into blocks; what is left is compared block by block."""
    monkeypatch.setattr(minhash, "LEVELS", 1)
    monkeypatch.setattr(minhash, "BLOCK", 9)
    rng = random.Random(9)
    base = words(rng, 80, 3000).split()
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(80)] = f"y{rng.randrange(1000)}"
        rows.append((i, " ".join(w), "en", "s", 0))
    check(minhash_groups(docs(spark, rows), group=4).collect(), rows)


@pytest.mark.parametrize("n", [1, 5, 300])
def test_common_shingles(n):
    """Shingles of many sets (by products) and of few (pair by pair)."""
    rng = random.Random(n)
    sets = [{rng.randrange(40) for _ in range(20)} | {rng.randrange(100, 3000) for _ in range(30)} for _ in range(n)]
    got = minhash.common_shingles([np.array(sorted(s), np.uint64) for s in sets])
    assert all(got[i, j] == len(sets[i] & sets[j]) for i in range(n) for j in range(n) if i != j)


def test_sketches_tell_similarity():
    rng = np.random.default_rng(2)
    limit = most_odd_bits(192, 512, 0.8, 1e-11)
    for overlap, passes in ((1900, True), (1778, True), (900, False), (400, False)):  # 1778 of 2222: 0.8
        for _ in range(20):
            x = rng.integers(0, 1 << 63, 4000 - overlap, np.uint64)
            a, b = np.sort(x[:2000]), np.sort(x[2000 - overlap:])
            s = odd_sketches(minimum_hashes([a, b], 192))
            odd = int(np.bitwise_count(s[0] ^ s[1]).sum())
            assert (odd <= limit) == passes
            estimate = 1 + 512 / (4 * 192) * np.log(1 - 2 * odd / 512) if odd < 256 else 0
            assert overlap < 1700 or abs(estimate - overlap / (4000 - overlap)) < 0.2


def test_minimum_hashes_agree_as_often_as_sets():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 1 << 63, 3000, np.uint64)
    m = minimum_hashes([np.sort(x[:2000]), np.sort(x[1000:])], 2000)
    assert abs((m[0] == m[1]).mean() - 1 / 3) < 0.05


@pytest.mark.parametrize("text", ["", "\n ", "One", "a B c", "a b c D a b c d", "É é ß x 你好 B c\x0bd", "the " * 100])
def test_shingles(text):
    assert len(shingles(text.encode(), 4)) == len(slow_set(text))


def test_odd_rows(spark):
    got = minhash_groups(docs(spark, ODD, clashing=True)).collect()
    assert len(got) == len(ODD)
    assert {(r.doc_id, r.component_id, r.n_shingles, r.kept) for r in got if r.doc_id in (1, 2, 3)} == {(i, i, 0, True) for i in (1, 2, 3)}
    assert sorted((r.component_id, r.kept) for r in got if r.doc_id in (4, 5)) == [(4, False), (4, False), (4, True)]
    assert sorted(r.kept for r in got if r.doc_id is None) == [False, True]
    assert [r.n_shingles for r in got if r.doc_id == 7] == [1]


def test_empty_table(spark):
    assert minhash_groups(docs(spark, [])).collect() == []
