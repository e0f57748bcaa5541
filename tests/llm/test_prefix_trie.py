import hashlib
import random
import zlib

import pytest

from casewatch.llm import prefix_trie
from casewatch.llm.prefix_trie import WIDTH, RadixTree, conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def slow(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for t in own.values():
        t.sort(key=lambda x: (x[0], x[1], x[2], hashlib.sha256(f"{len(x[2])}:{x[2]}{x[3]}".encode()).hexdigest()))
    seq = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])
        seq[c] = tuple(x[2:] for x in base[:h] + t[h:])
    nodes = {}
    for c, s in seq.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        parents = {q[:-1] for q in nodes if q}
        ends = ",".join(str(c) for c in sorted(members) if seq[c] == p)
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), sum(q[:-1] == p for q in nodes if q),
                    sum(q not in parents for q in below), sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in below if q),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def talk(seed, n=45, longest=9):
    rng, rows = random.Random(seed), []
    texts = ["hi", "hello", "", None, "é🙂", "how are you"]
    for c in [*range(n), *range(95, 105), -3, -100, 1000, 1003]:
        for t in range(rng.randrange(0, longest)):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "user", "bot", None]), rng.choice(texts[:3 + c % 4])))
    rng.shuffle(rows)
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize(("seed", "longest", "keys"), [(1, 9, 50_000), (2, 50, 3)])
def test_as_brute_force(spark, monkeypatch, seed, longest, keys):
    """Short conversations in one tree, and long ones of several chunks in many small trees."""
    monkeypatch.setattr(prefix_trie, "TREE_KEYS", keys)
    monkeypatch.setattr(prefix_trie, "ENDS", 2 if keys == 3 else 4096)
    rows = talk(seed, longest=longest)
    if keys == 3:
        rows += [(c, t, "user", f"same {t}") for c in range(200, 320) for t in range(40 - (c % 7 == 0) * 20)]
    got = conversation_trie(table(spark, rows)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(slow(rows), key=key)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (7, None, None, None), (7, None, None, None), (7, 3, "user", "x" * 200_000), (8, 0, "", ""), (8, 0, "", "")]
    from pyspark.sql import functions as F
    df = table(spark, rows)
    for c in ("kf", "kr", "rank", "conv", "id", "key", "chunk", "low", "depth"):
        df = df.withColumn(c, F.lit("clash"))
    assert sorted(map(tuple, conversation_trie(df).collect()), key=key) == sorted(slow(rows), key=key)


def test_empty_tables(spark):
    assert conversation_trie(table(spark, [])).collect() == []
    assert conversation_trie(table(spark, [(None, 1, "a", "b")])).collect() == []


def test_turnless_conversations(spark):
    turnless = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(turnless, 0, "user", "dropped")]
    got = conversation_trie(table(spark, rows)).collect()
    assert [tuple(r) for r in got] == slow(rows) and len(got) == 1


def test_layouts_grow():
    """One byte after another: from 4 to 16, 48 and 256 children, keys that are prefixes of others included."""
    rng = random.Random(3)
    keys = {rng.randbytes(1) + bytes(6) + rng.randbytes(1) + rng.randbytes(WIDTH * rng.randrange(0, 3)) for _ in range(3000)}
    tree, sizes = RadixTree(2), set()
    for i, k in enumerate(sorted(keys, key=lambda _: rng.random())):
        tree.insert(k, [1, len(k)], i)
        sizes.add(tree.top.layout)
    assert sizes == {4, 16, 48, 256}
    got = {p: s for p, s, _ in tree.turns()}
    want = {}
    for k in keys:
        for end in range(WIDTH, len(k) + 1, WIDTH):
            a, b = want.get(k[:end], (0, 0))
            want[k[:end]] = (a + 1, b + len(k))
    assert {p: tuple(s) for p, s in got.items()} == want
