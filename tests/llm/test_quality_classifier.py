import math
import random
from collections import defaultdict
from fractions import Fraction

import pytest

from casewatch.llm import quality_classifier
from casewatch.llm.quality_classifier import fit, quality_posteriors, shape, terms

from .helpers import ODD, docs, words

LABELS = "doc_id long, quality int, toxic int"


def made(n=600, seed=1):
    """Prose, symbol-ridden junk, and prose with insults; two kinds of hosts."""
    rng = random.Random(seed)
    rows, kinds = [], {}
    for i in range(n):
        kind = rng.choices(["good", "junk", "toxic"], [6, 2, 2])[0]
        w = words(rng, rng.randrange(20, 80)).split()
        if kind == "junk":
            w = [x + rng.choice(["###", "$$$"]) for x in w]
        if kind == "toxic":
            w[rng.randrange(len(w))] = rng.choice(["moron", "scum", "loser"])
        kinds[i] = kind
        rows.append((i, " ".join(w), rng.choice(["en", "fr"]), f"h{i % 5}", 0))
    return rows, kinds


def labels(spark, kinds):
    return spark.createDataFrame([(i, int(k != "junk"), int(k == "toxic")) for i, k in kinds.items()], LABELS)


def test_held_out_accuracy(spark):
    rows, kinds = made()
    known = {i: k for i, k in kinds.items() if i % 2}
    got = {r.doc_id: r for r in quality_posteriors(docs(spark, rows), labels(spark, known)).collect()}
    held = [i for i in kinds if i not in known]
    wrong = [i for i in held if got[i].kept != (kinds[i] == "good")]
    assert len(wrong) <= 0.02 * len(held)
    assert all(got[i].kept for i in held if kinds[i] == "good")


def test_sample_is_bounded_in_rows(spark, monkeypatch):
    rows, kinds = made(200)
    sizes = []
    real = quality_classifier._fit
    monkeypatch.setattr(quality_classifier, "_fit", lambda good, *rest: sizes.append(len(good)) or real(good, *rest))
    foreign = {1_000_000 + i: "good" for i in range(3000)}
    assert fit(docs(spark, rows + [(0, f"{rows[0][1]} {i}", "en", "h0", 0) for i in range(300)]), labels(spark, kinds | foreign), max_labelled=200)
    assert fit(docs(spark, rows), labels(spark, kinds | foreign), max_labelled=100) and sizes == [200, 100]


def test_on_the_test_tables(spark):
    """Held-out labels of the driver's documents: at most 300 of about 400 are fitted to."""
    sf = "/root/testdata/sf0.01"
    d, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    r = quality_posteriors(d, lab.filter("doc_id % 4 > 0")).join(lab.filter("doc_id % 4 = 0"), "doc_id").collect()
    junk, clean = [x for x in r if not x.quality], [x for x in r if x.quality and not x.toxic]
    assert sum(not x.kept for x in junk) >= 0.9 * len(junk) and sum(x.kept for x in clean) >= 0.98 * len(clean)


def test_sparse_sites_are_shrunk_and_dense_ones_are_not(spark):
    rng = random.Random(9)
    rows, kinds = [], {}
    for i in range(900):
        host = "bad" if i < 300 else "fine" if i < 890 else f"one{i}"
        junk = rng.random() < {"bad": 0.95, "fine": 0.02}.get(host, 1.0)
        kinds[i] = "junk" if junk else "good"
        rows.append((i, " ".join(x + "###" * junk for x in words(rng, 30).split()), "en", host, 0))
    # Rows without words: only their site speaks.
    rows += [(2000, None, "en", "bad", 0), (2001, None, "en", "fine", 0), (2002, None, "en", "one890", 0)]
    got = {r.doc_id: r for r in quality_posteriors(docs(spark, rows), labels(spark, kinds)).collect()}
    assert got[2000].host_rate < 0.2 < 0.8 < got[2001].host_rate
    assert got[2000].host_rate < got[2002].host_rate < got[2001].host_rate  # one other document: in between
    assert got[2000].posterior < got[2001].posterior


def strength(sites, parent, spread):
    """Moments of a beta-binomial, site by site: (documents, sum of chances), and the parent's rate of each."""
    n, k = sum(d for d, _ in sites), len(sites)
    if k < 2:
        return 1e6
    between = sum(d * (float(s) / d - p) ** 2 for (d, s), p in zip(sites, parent, strict=True))
    room = spread * (n - sum(d * d for d, _ in sites) / n - (k - 1))
    rho = (between - spread * (k - 1)) / room if room > 0 else 0
    return min(max(1 / rho - 1, 1), 1e6) if rho > 1e-6 else 1e6


@pytest.mark.parametrize("seed", [3, 4])
def test_posteriors_by_brute_force(spark, seed):
    """Every rate and posterior from loops over all rows, sums as fractions; sites without a name, repeated rows and ids."""
    rng = random.Random(seed)
    rows, kinds = made(400, seed)
    rows = [(i, t, lang if rng.random() < 0.9 else None, rng.choices([h, "hot", None, f"one{i}"], [4, 4, 1, 1])[0], n) for i, t, lang, h, n in rows]
    rows += rows[:20] + [(7, None, None, None, 0)]
    lab = labels(spark, {i: k for i, k in kinds.items() if i % 3})
    model = fit(docs(spark, rows), lab)
    z = [model.log_odds(t or "") for _, t, *_ in rows]
    u = [Fraction(int(1e6 / (1 + math.exp(-x)) + 0.5), 10**6) for x in z]
    host, path = defaultdict(list), defaultdict(list)
    for (_, _, lang, src, _), x in zip(rows, u, strict=True):
        host[src].append(x)
        path[src, lang].append(x)
    mean = float(sum(u) / len(u))
    spread = mean * (1 - mean)
    size = {h: (len(x), sum(x)) for h, x in host.items()}
    a = strength(list(size.values()), [mean] * len(size), spread)
    theta = {h: (float(s) + a * mean) / (n + a) for h, (n, s) in size.items()}
    b = strength([(len(x), sum(x)) for x in path.values()], [theta[h] for h, _ in path], spread)
    want = []
    for (i, _, lang, src, _), x, own in zip(rows, z, u, strict=True):
        n, s = size[src]
        of_host = (float(s - own) + a * mean) / (n - 1 + a)
        p = path[src, lang]
        of_path = (float(sum(p) - own) + b * of_host) / (len(p) - 1 + b)
        odds = x - math.log(model.prior / (1 - model.prior)) + math.log(of_path / (1 - of_path))
        want.append((i, round(of_host, 6), round(of_path, 6), 1 / (1 + math.exp(-odds))))
    got = sorted((r.doc_id, round(r.host_rate, 6), round(r.path_rate, 6), r.posterior, r.kept) for r in
                 quality_posteriors(docs(spark, rows), lab).collect())
    for g, w in zip(got, sorted(want), strict=True):
        assert g[0] == w[0] and g[1:4] == pytest.approx(w[1:], abs=2e-5) and g[4] == (g[3] >= 0.5)


def test_without_labels_everything_stays(spark):
    none = spark.createDataFrame([], LABELS)
    got = quality_posteriors(docs(spark, ODD, clashing=True), none).collect()
    assert len(got) == len(ODD) and all(r.kept for r in got)
    one_class = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (5, None, 1)], LABELS)
    assert all(r.kept for r in quality_posteriors(docs(spark, ODD), one_class).collect())
    assert quality_posteriors(docs(spark, []), one_class).collect() == []


def test_odd_rows_with_a_model(spark):
    rows, kinds = made(200)
    got = quality_posteriors(docs(spark, rows + [(10_000 + i, *r[1:]) for i, r in enumerate(ODD)], clashing=True), labels(spark, kinds)).collect()
    assert len(got) == len(rows) + len(ODD) and all(0 <= r.posterior <= 1 for r in got)


@pytest.mark.parametrize("text", ["", " ", "De.", "x" * 100_000, "###"])
def test_features_of_odd_texts(text):
    assert all(abs(x) < 100_000 for x in shape(text)) and isinstance(terms(text), set)
