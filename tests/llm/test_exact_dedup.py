import hashlib
import random
import string

import pytest

from casewatch.llm.exact_dedup import block_names, exact_dedup

from .helpers import ODD, docs, words

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r[1] or "").translate(LOWER), []).append(r[0])
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=str)


def made():
    rng = random.Random(1)
    rows = [(i, words(rng, rng.randrange(0, 30), 4), "en", "s", 0) for i in range(300)]
    return rows + [(1000 + i, rows[i % 40][1].upper(), "en", "s", 0) for i in range(200)]


@pytest.mark.parametrize(("block", "bits"), [(4096, 64), (4, 3)])
def test_groups_as_brute_force(spark, block, bits):
    """Also with tiny blocks (many levels) and a 3-bit hash (every block shares one)."""
    rows = made()
    got = exact_dedup(docs(spark, rows), block, bits).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_names_are_free_of_collisions(spark):
    rows = made()
    named = block_names(docs(spark, rows), 4, 64).collect()
    texts = {r[0]: r[1].translate(LOWER) for r in rows}
    by_name = {}
    for r in named:
        by_name.setdefault((r.level, r.name), set()).add(texts[r.doc_id])
    assert all(len(x) == 1 for x in by_name.values()) and len(by_name) == len(set(texts.values()))


def test_odd_rows(spark):
    got = exact_dedup(docs(spark, ODD, clashing=True), 64).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(ODD)
    kept = [r.text_sha256 for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len({r.text_sha256 for r in got})  # one row a group, of repeated rows too


def test_empty_table(spark):
    assert exact_dedup(docs(spark, [])).collect() == []
