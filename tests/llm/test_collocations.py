import random
import re
from collections import Counter

import numpy as np
import pytest

from casewatch.llm.collocations import collocations, multikey_quicksort

from .helpers import ODD, docs

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow(rows, least, top, max_words=5):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(AZ)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in range(1, max_words + 1) for i in range(len(w) - k + 1))
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = []
    for p, a in found.items():
        lang, w = p[0], p[1:]
        best = min((1000 * a * n[lang] // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        k = best[1]
        held = any(q[0] == lang and len(q) > len(p) and 100 * b >= 100 * a and any(q[i:i + len(w)] == w for i in range(1, len(q)))
                   for q, b in found.items())
        if not held:
            out.append((lang, -best[0], -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])], n[lang]))
    rank, result = Counter(), []
    for lang, s, a, phrase, le, r, total in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            result.append((lang, rank[lang], phrase.decode(), -a, le, r, total, -s))
    return result


def corpus(seed, n=80):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "The", "New", "york", "été", "ß", "語", "x\x00y", "a b", "city"] + [f"w{i}" for i in range(6)]
    marks = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", " ;", "!?", "\x0b"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(vocabulary) + rng.choice(marks) for _ in range(rng.randrange(60)))
        rows.append((i, text + "New York City hall" * (i % 3), rng.choice(["en", "en", "fr", None, "und"]), "s", 0))
    return rows


@pytest.mark.parametrize(("options", "top"), [({}, 2000), ({"vocabulary": 3}, 2000), ({"partition": 40}, 7)])
def test_as_brute_force(spark, options, top):
    """With ids and with hashes for words, in few and in many partitions."""
    rows = corpus(1) + ODD
    got = collocations(docs(spark, rows, clashing=True), least=5, top=top, **options).collect()
    assert sorted(map(tuple, got)) == sorted(slow(rows, 5, top))


def test_hot_word_is_cut_between_partitions(spark):
    rows = [(i, "the the the the the the cat sat. the cat sat " * 30, "en", "s", 0) for i in range(20)]
    got = collocations(docs(spark, rows).repartition(5), least=100, partition=200).collect()
    assert sorted(map(tuple, got)) == sorted(slow(rows, 100, 2000))


def test_quicksort_counts_and_abandons():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 4, (3000, 4)).astype("u4")
    words[np.cumsum(words == 0, axis=1) > 0] = 0
    weight = rng.integers(1, 4, 3000)
    want = Counter()
    for row, n in zip(words.tolist(), weight.tolist(), strict=True):
        for d in range(1, 5):
            if row[d - 1]:
                want[tuple(row[:d])] += n
    ends = [max(map(tuple, words.tolist())), min(map(tuple, words.tolist()))]
    got = dict(multikey_quicksort(words, weight, 60))
    assert all(want[p] == n for p, n in got.items())
    assert {p for p in want if len(p) > 1 and want[p] >= 60} <= set(got)
    assert all(want[p] >= 60 or any(e[:len(p)] == p for e in ends) for p in got)


def test_exact_products(spark):
    """1000 * a * n passes 64 bits only on huge corpora; the division is one of decimals."""
    row = spark.sql("SELECT CAST(99999999999999 AS DECIMAL(17,0)) * CAST(99999999999999 AS DECIMAL(17,0)) * CAST(1000 AS DECIMAL(4,0))"
                    " DIV (CAST(99999999999998 AS DECIMAL(17,0)) * CAST(99999999 AS DECIMAL(17,0))) AS q").first()
    assert row.q == 99999999999999 * 99999999999999 * 1000 // (99999999999998 * 99999999)


def test_empty_and_odd_tables(spark):
    assert collocations(docs(spark, [])).collect() == []
    assert collocations(docs(spark, [(1, None, None, None, None), (2, " .. ", "en", "a", 1)]), least=1).collect() == []
    assert sorted(map(tuple, collocations(docs(spark, ODD, clashing=True)).collect())) == sorted(slow(ODD, 100, 2000))
