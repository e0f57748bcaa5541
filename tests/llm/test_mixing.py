import random

import pytest

from casewatch.llm.mixing import mix, spread

from .helpers import ODD, docs, words


def levels(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by the rule itself: cap, reshare the excess among the others, again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = sum(weight[s] for s in sizes if s not in capped)
        level = (total - sum(most * sizes[s] for s in capped)) / free if free else 0
        over = {s for s in sizes if s not in capped and weight[s] * level > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else weight[s] * level for s in sizes}
        capped |= over


def made(n=900):
    rng = random.Random(7)
    return [(i, words(rng, rng.choice([0, 3, 20, 20, 40, 300])), "en", rng.choice(["b", "B", "a", "é", None, "hot", "hot", "hot"]), 0) for i in range(n)]


@pytest.fixture(scope="module")
def mixed(spark):
    return mix(docs(spark, made()), group=8)


def test_targets_and_takes(mixed):
    rows, texts = mixed.collect(), {r[0]: r for r in made()}
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        n = len(texts[r.doc_id][1].split())
        assert r.size == n and r.taken == r.copies * n and 0 <= r.taken <= 2 * n
        sizes[r.source] = sizes.get(r.source, 0) + n
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), n)
    want = levels(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * (1 + want[r.source])
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    assert len(rows) == len(texts)


def test_reruns_agree_on_another_layout(spark, mixed):
    again = mix(docs(spark, made()).repartition(5), group=8)
    assert sorted(mixed.select("doc_id", "taken").collect()) == sorted(again.select("doc_id", "taken").collect())


def test_rounding_is_unbiased(spark):
    """A document's chance of the extra copy is its fraction, whatever its size."""
    rng = random.Random(3)
    rows = [(i, words(rng, 1 + i % 4), "en", "a", 0) for i in range(4000)]
    got = mix(docs(spark, rows), share=0.3).collect()
    for size in range(1, 5):
        own = [r.copies for r in got if r.size == size]
        assert abs(sum(own) / len(own) - 0.3) < 0.06


def test_rows_of_one_id_are_spread(spark):
    """One id, or none, on most rows, equal texts among them: no two units share a place, and reruns agree."""
    rng = random.Random(5)
    rows = [(rng.choice([7, 7, None, i]), words(rng, rng.choice([1, 2, 30]), 3), "en", rng.choice(["a", "b"]), 0) for i in range(1500)]
    got, again = (mix(docs(spark, rows).repartition(n), group=8) for n in (1, 5))
    named = lambda df: sorted(map(str, df.select("doc_id", "source", "size", "taken").collect()))
    assert named(got) == named(again)
    sums = {r.source: r for r in got.groupBy("source").agg({"taken": "sum", "target": "max"}).collect()}
    assert all(abs(r["sum(taken)"] - r["max(target)"]) <= 30 for r in sums.values())
    unit = "named_struct('kf', 0L, 'kr', id, 'doc_id', if(id % 3 = 0, 7L, if(id % 3 = 1, null, id)), 'size', 5L, 'x', 0.5D)"
    h = spread(spark.range(3000).selectExpr("'s' source", f"{unit} unit", "id % 2 text_hash"))
    assert h.select("h").distinct().count() == h.count() == 3000


def test_no_python_on_the_main_path(mixed):
    plan = mixed._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_odd_rows(spark):
    got = mix(docs(spark, ODD, clashing=True), group=2).collect()
    assert len(got) == len(ODD) and all(r.copies <= 2 for r in got)
    assert all(r.size == 0 and r.taken == 0 for r in got if r.doc_id in (1, 2, 3))
    assert {r.size for r in got if r.doc_id == 7} == {60_000}


def test_empty_tables(spark):
    assert mix(docs(spark, [])).collect() == []
    assert [r.taken for r in mix(docs(spark, [(1, None, "en", "a", 0)])).collect()] == [0]
