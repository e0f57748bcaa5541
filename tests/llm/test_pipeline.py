import random
import string

import pytest

import corpus_pipeline as cp
from casewatch.llm.common import written

from .helpers import ODD, docs, words
from .test_packing import encoded
from .test_simhash import classes, slow_fingerprint

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
STAGES = dict(cp.STAGES)


def made():
    rng = random.Random(11)
    rows = [(i, words(rng, rng.randrange(5, 200)), rng.choice(["en", "de"]), rng.choice(["a", "b", None]), i) for i in range(120)]
    rows += [(200 + i, rows[i][1].upper(), "en", "a", i) for i in range(30)]
    rows += [(300 + i, rows[i + 40][1] + " end", "en", "b", i) for i in range(30)]
    return rows + ODD


@pytest.fixture(scope="module")
def sf_dir(spark):
    """A folder whose labels name good and bad rows."""
    from casewatch.session import scratch_path
    path = scratch_path(spark, "test-sf")
    spark.createDataFrame([(i, int(i % 10 != 0), 0) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    docs(spark, made(), clashing=True).write.parquet(f"{path}/documents.parquet")
    docs(spark, []).write.parquet(f"{path}-none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}-none/labels.parquet")
    return path


def test_the_stages():
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "mixing", "best_fit_packing"]


def test_exact_copies_go(spark, sf_dir):
    before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    after = STAGES["exact_dedup"](spark, before, sf_dir)
    assert after.columns == before.columns
    best = {}
    for r in made():
        t = (r[1] or "").translate(LOWER)
        best[t] = max(best.get(t, -1), -1 if r[0] is None else r[0])
    got = after.collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, (r.text or "").translate(LOWER)) for r in got) == sorted((i, t) for t, i in best.items())


def test_near_copies_go(spark, sf_dir):
    before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = STAGES["simhash_near_dedup"](spark, before, sf_dir)
    assert got.columns == before.columns
    groups = classes(sorted({slow_fingerprint(r[1] or "") for r in made()}), 3)
    left = [slow_fingerprint(r.text or "") for r in got.collect()]
    assert len(left) == len(groups) and all(sum(f in c for f in left) == 1 for c in groups)


def test_mix_repeats_rows(spark, sf_dir):
    before = written(docs(spark, made(), clashing=True), "before")
    got = STAGES["mixing"](spark, before, sf_dir)
    assert got.columns == before.columns
    total = sum(len((r[1] or "").encode().split()) for r in made())
    taken = sum(len((r.text or "").encode().split()) for r in got.collect())
    assert abs(taken - 1.5 * total) <= 3 * 60_000


def test_rejected_rows_go_and_the_rest_is_whole(spark, sf_dir):
    before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = STAGES["quality_classifier"](spark, before, sf_dir)
    assert got.columns == before.columns and got.exceptAll(before).isEmpty() and got.count() <= before.count()


def test_run_is_the_stages_in_a_row(spark, sf_dir, monkeypatch):
    """Every stage's result is written; the last one packs all rows of the one before."""
    seen = []
    monkeypatch.setattr(cp, "written", lambda df, name: seen.append((name, written(df, name))) or seen[-1][1])
    got = cp.run(spark, sf_dir).collect()
    stages = [df for name, df in seen if name.startswith("stage-")]
    assert len(stages) == 4 and all(df.columns == stages[0].columns for df in stages)
    assert sum(r.length for r in got) == sum(len(encoded(r.text)) + 1 for r in stages[-1].collect())
    length = {}
    for r in got:
        length[r.sequence_id] = length.get(r.sequence_id, 0) + r.length
    assert max(length.values()) <= 4096


def test_empty_tables(spark, sf_dir):
    assert cp.run(spark, f"{sf_dir}-none").collect() == []
