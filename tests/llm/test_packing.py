import bisect
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from casewatch.llm import packing
from casewatch.llm.packing import configurations, pack, pack_documents
from casewatch.llm.tokens import at_limit, length_at, token_histogram

from .helpers import ODD, docs, words


def sequences(histogram, size, **options):
    """What each sequence holds, after checking that the runs place every document once and without gaps."""
    runs, n = pack(histogram, size, **options)
    held, seen = {}, set()
    for length, rank, count, first, each, offset in runs:
        for i in range(count):
            assert (length, rank + i) not in seen
            seen.add((length, rank + i))
            held.setdefault(first + i // each, []).append((offset + i % each * length, length))
    assert seen == {(x, i) for x, c in histogram.items() for i in range(c)} and set(held) == set(range(n))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return n


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=20), st.integers(1, 12))
def test_pack_is_whole(histogram, groups):
    sequences(histogram, 40, groups=(groups,))


def best_fit_decreasing(histogram, size):
    used = 0
    rooms = []
    for x in sorted(histogram, reverse=True):
        for _ in range(histogram[x]):
            i = bisect.bisect_left(rooms, x)
            if i < len(rooms):
                room = rooms.pop(i)
            else:
                room, used = size, used + 1
            if room > x:
                bisect.insort(rooms, room - x)
    return used


def lengths_of(kind, seed, n):
    rng = np.random.default_rng(seed)
    return {"lognormal": np.clip(rng.lognormal(6.5, 1, n).astype(int), 1, 4096), "uniform": rng.integers(1, 4097, n),
            "middle": rng.integers(1100, 3001, n), "thirds": rng.integers(1300, 1500, n)}[kind]


@pytest.mark.parametrize("kind", ["lognormal", "uniform", "middle", "thirds"])
def test_never_more_sequences_than_best_fit_decreasing(kind):
    h = dict(zip(*(x.tolist() for x in np.unique(lengths_of(kind, 1, 20_000), return_counts=True)), strict=True))
    assert sequences(h, 4096) <= best_fit_decreasing(h, 4096)


def test_configurations_waste_less_than_best_fit():
    """Lengths a little over a third and a little under: best fit alone pairs them badly, configurations don't."""
    h = {1500: 600, 1400: 600, 1196: 600, 2700: 60, 1396: 60}
    assert sequences(h, 4096, groups=(48,)) == 660 and sequences(h, 4096) == 660


@pytest.mark.parametrize("kind", ["lognormal", "uniform", "middle", "thirds"])
def test_linear_grouping_takes_part_in_every_plan(kind, monkeypatch):
    """Best fit alone never takes its place: sequences of the mix are in the plan that is taken."""
    placed = []
    substitute = packing._substitute

    def counted(plan, *rest):
        if not placed or placed[-1][0] is not plan:
            placed.append([plan, 0])
        before = plan.bins
        substitute(plan, *rest)
        placed[-1][1] += plan.bins - before

    monkeypatch.setattr(packing, "_substitute", counted)
    h = dict(zip(*(x.tolist() for x in np.unique(lengths_of(kind, 1, 20_000), return_counts=True)), strict=True))
    runs, n = pack(h, 4096)
    assert any(plan.runs is runs and count > 0 for plan, count in placed)


def test_configurations_are_optimal():
    # 3 + 3 + 4 fills ten; six threes and three fours need three.
    assert abs(sum(x for _, x in configurations([4, 3], [3, 6], 10)) - 3) < 0.01


def encoded(text):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return t.encode(text or "", add_special_tokens=False).ids


def texts():
    rng = random.Random(5)
    odd = ["<|endoftext|> it's", "a\u0085b c  d", "É é ΣΑΣ ß ﬁ", "日本語 🙂🙂", "don't WE'LL 123 4.5!!", "x" * 5000, "\x1c\x1d a\x00b"]
    return [(i, x, "en", "s", 0) for i, x in enumerate(odd + [words(rng, rng.randrange(1, 3000)) for _ in range(60)])] + ODD[:6]


def test_pieces_and_places(spark):
    rows = texts()
    got = pack_documents(docs(spark, rows, clashing=True), size=1024).collect()
    want = []
    for r in rows:
        ids = np.array([*encoded(r[1]), 1], "<u4")
        want += [(r[0], k, a, len(ids[a:a + 1024]), zlib.crc32(ids[a:a + 1024].tobytes())) for k, a in enumerate(range(0, len(ids), 1024))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(held) <= 1.1 * sum(w[3] for w in want) / 1024 + 1


def test_histogram(spark):
    rows = texts()
    lengths = sorted(len(encoded(r[1])) for r in rows)
    h = token_histogram(docs(spark, rows, clashing=True))
    got = sorted(h.collect())
    assert [r.length for r in got] == sorted(set(lengths))
    for r in got:
        assert r.n_docs == lengths.count(r.length) and r.docs_upto == sum(x <= r.length for x in lengths) and r.docs_over == len(lengths) - r.docs_upto
        assert r.tokens_upto == sum(x for x in lengths if x <= r.length) and r.truncated_total == sum(min(x, r.length) for x in lengths)
        assert abs(r.quantile - r.docs_upto / len(lengths)) < 1e-12
    for limit in (0, 1, 17, 1000, 10**6):
        assert tuple(at_limit(h, limit).first()) == (sum(x <= limit for x in lengths), sum(x for x in lengths if x <= limit),
                                                     sum(x > limit for x in lengths), sum(min(x, limit) for x in lengths))
    assert length_at(h, 0.5).first()[0] == lengths[-(-len(lengths) // 2) - 1]


def test_empty_tables(spark):
    none = docs(spark, [])
    assert pack_documents(none).collect() == [] and token_histogram(none).collect() == []
    assert tuple(at_limit(token_histogram(none), 10).first()) == (0, 0, 0, 0)
