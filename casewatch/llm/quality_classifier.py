"""Quality classifier: hierarchical empirical Bayes over documents, hosts and paths.

A logistic model, fitted to a bounded sample of labelled rows, gives each document's own
evidence. Grouped sums of that evidence give every host and path a rate of good documents;
rates of sparse sites are shrunk: a path's towards its host's, a host's towards the global
one, by strengths estimated from how much the sites differ. A document's posterior is
its evidence at the prior odds of its site.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import KEY, keyed, written

#: Labelled rows the model is fitted to, at most (the first by a hash of their id).
MAX_LABELLED = 20_000
#: Words and word beginnings that the model weighs, at most, each in this many sampled documents at least.
MAX_TERMS, MIN_TERM_DOCS = 4096, 5
_L2, _STEPS = 1.0, 200

_WORD = re.compile(r"[^\W\d_]+")


def terms(text: str) -> set[str]:
    """Distinct lower-case words, and (marked by ^) the first four letters of the longer ones."""
    words = set(_WORD.findall(text.lower()))
    return words | {f"^{w[:4]}" for w in words if len(w) > 4}


def shape(text: str) -> list[float]:
    """What a text looks like, whatever it says."""
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    lines = [x for x in text.split("\n") if x.strip()]
    letters = max(1, chars - sum(map(text.count, " \n0123456789.,")))
    symbols = sum(map(text.count, "#*$%&<>{}=_~^\\"))
    upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        math.log(n), min(symbols / n, 2.0), min(text.count("!") / n, 2.0), min(text.count("|") / n, 1.0),
        upper / letters, sum(map(text.count, "0123456789")) / chars, len(set(words)) / n, repeats / n,
        math.log(n / max(1, len(set(words)))), 1 - len(set(lines)) / max(1, len(lines)), min(chars / n, 40.0) / 10,
    ]


@dataclass
class Model:
    """Log-odds of good: intercept + shape . scaled weights + the weights of the terms present."""

    intercept: float = 0.0
    prior: float = 0.5  # share of good rows in the sample
    center: np.ndarray = field(default_factory=lambda: np.zeros(11))
    dense: np.ndarray = field(default_factory=lambda: np.zeros(11))
    weights: dict[str, float] = field(default_factory=dict)

    def log_odds(self, text: str) -> float:
        z = self.intercept + float(self.dense @ (np.array(shape(text)) - self.center))
        if self.weights:
            z += sum(map(self.weights.get, self.weights.keys() & terms(text)))
        return z


def _fit(good: np.ndarray, dense: np.ndarray, rows: np.ndarray, cols: np.ndarray, vocabulary: list[str]) -> Model:
    """L2-regularised logistic regression; the same rows in the same order give the same model."""
    n, prior = len(good), float(good.mean())
    center, scale = dense.mean(axis=0), np.maximum(dense.std(axis=0), 1e-3)
    x = np.column_stack((np.ones(n), (dense - center) / scale))
    w, v = np.zeros(x.shape[1]), np.zeros(len(vocabulary))
    w[0] = math.log(prior / (1 - prior))
    mw, mv, sw, sv = np.zeros_like(w), np.zeros_like(v), np.zeros_like(w), np.zeros_like(v)
    for step in range(1, _STEPS + 1):  # Adam on the whole sample
        z = x @ w + np.bincount(rows, v[cols], n)
        r = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - good
        gw, gv = x.T @ r / n, np.bincount(cols, r[rows], len(v)) / n + _L2 * v / n
        gw[1:] += _L2 * w[1:] / n
        for p, g, m, s in ((w, gw, mw, sw), (v, gv, mv, sv)):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return Model(float(w[0]), prior, center, w[1:] / scale, {t: float(a) for t, a in zip(vocabulary, v, strict=True) if a})


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_terms: int = MAX_TERMS) -> Model | None:
    """The model of at most `max_labelled` labelled rows; None if they don't hold both classes.

    A row is good if its quality is 1 and it isn't toxic (a null label counts as 0); rows with a null id or
    quality are left out; of repeated labels of an id the worst counts, and of rows that share an id the first by text. Labels of ids
    that `docs` doesn't have are left out before the limit.
    """
    toxic = F.coalesce(labels["toxic"].cast("int"), F.lit(0)) if "toxic" in labels.columns else F.lit(0)
    known = labels.filter(labels["quality"].isNotNull()).select(labels["doc_id"].cast("long").alias("doc_id"),
                          ((labels["quality"].cast("int") == 1) & (toxic == 0)).cast("int").alias("good"))
    known = known.dropna().groupBy("doc_id").agg(F.min("good").alias("good"))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = known.join(text.select("doc_id").distinct(), "doc_id", "left_semi")
    sample = written(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled), "labelled")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("good"), pa.array([shape(t) for t in texts], pa.list_(pa.float64())),
                 pa.array([sorted(terms(t)) for t in texts], pa.list_(pa.string()))], names=["doc_id", "good", "shape", "terms"])

    # At most `max_labelled` rows of 12 bytes: proven small. One row of each id, the first by its text.
    one = text.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text")).alias("t"), F.min("good").alias("good"))
    rows = written(one.select("doc_id", "t.text", "good").mapInArrow(
        describe, "doc_id long, good int, shape array<double>, terms array<string>"), "described")
    n, n_good = rows.agg(F.count("*"), F.coalesce(F.sum("good"), F.lit(0))).first()
    if not 0 < n_good < n:
        return None
    by_term = rows.select("good", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("n"), F.sum("good").alias("g")).filter(F.col("n") >= MIN_TERM_DOCS)
    odds = (F.col("g") + 0.5) / (F.col("n") - F.col("g") + 0.5) * ((n - n_good) / n_good)
    best = by_term.orderBy(F.abs(F.log(odds)) * F.sqrt("n"), "term", ascending=False).limit(max_terms)
    vocabulary = sorted(r["term"] for r in best.select("term").collect())  # at most `max_terms`
    number = {t: i for i, t in enumerate(vocabulary)}

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[number[t] for t in ts if t in number] for ts in b.column("terms").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("good"), b.column("shape"), pa.array(found, pa.list_(pa.int32()))],
                                             names=["doc_id", "good", "shape", "found"])

    # The sample as numbers, at most max_labelled rows of 11 + max_terms: bounded by the parameters.
    data = rows.mapInArrow(indexed, "doc_id long, good int, shape array<double>, found array<int>").toArrow().sort_by(
        [("doc_id", "ascending"), ("good", "ascending")])
    found, dense = data["found"].combine_chunks(), data["shape"].combine_chunks()
    lengths = found.value_lengths().to_numpy()
    return _fit(data["good"].to_numpy().astype(float), dense.flatten().to_numpy().reshape(len(dense), -1),
                np.repeat(np.arange(len(found)), lengths), found.flatten().to_numpy().astype(np.int64), vocabulary)


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = [model.log_odds(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("kf", "kr", "doc_id", "host", "path")], pa.array(z, pa.float64())],
                                             names=["kf", "kr", "doc_id", "host", "path", "z"])
    return run


def _strength(sites: DataFrame, mean: float | Column, spread: float) -> float:
    """How many documents the parent's rate is worth to a site: moments of a beta-binomial.

    `sites` has n and s (documents, and sum of their chances in millionths); the more the sites differ from
    `mean` beyond what chance explains, the less their parent counts. 1 to 1e6.
    """
    n, whole = F.col("n").cast("decimal(19,0)"), "decimal(38,0)"
    dev = F.col("n") * (F.col("s") / 1e6 / F.col("n") - mean) ** 2
    r = sites.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum((n * n).cast(whole)).alias("nn"),
                  F.sum(F.round(1e6 * dev).cast(whole)).alias("s")).first()
    if not r["n"] or r["k"] < 2 or spread <= 0:
        return 1e6
    room = spread * (r["n"] - float(r["nn"]) / r["n"] - (r["k"] - 1))
    rho = (float(r["s"]) / 1e6 - spread * (r["k"] - 1)) / room if room > 0 else 0.0
    return min(max(1 / rho - 1, 1.0), 1e6) if rho > 1e-6 else 1e6


def quality_posteriors(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang",
                       reject_below: float = 0.5, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Per row of `docs`: kf, kr, doc_id, host, path, evidence, host_rate, path_rate, posterior, kept.

    evidence: the chance of good by the text alone; host_rate, path_rate: shrunk rates of the
    row's site without the row itself; posterior: both combined; kept: posterior >= reject_below.
    Reads `doc_id`, `text` and the two site columns (names a web corpus would fill with
    `parse_url`); other columns are ignored. A null text counts as empty; a null host or path is
    a site of its own; repeated rows are rated once each. Without labelled rows of both
    classes the evidence is 0.5 and every row is kept. An empty table gives an empty result.
    """
    rows = keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"),
                 F.col(path).cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    model = fit(docs, labels, max_labelled)
    scored = written(rows.mapInArrow(
        _scores(model or Model()), "kf long, kr long, doc_id long, host string, path string, z double"), "scores")
    # Chances are added as whole millionths and divided last: sums don't depend on the order of adding, so reruns agree.
    scored = scored.withColumn("u", F.round(1e6 / (1 + F.exp(-F.col("z")))).cast("long"))
    paths = written(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("u").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    n, s = hosts.agg(F.sum("n"), F.sum("s")).first()
    mean = min(max(s / 1e6 / n, 1e-6), 1 - 1e-6) if n else 0.5
    of_host = _strength(hosts, mean, mean * (1 - mean))
    theta = (F.col("host_s") / 1e6 + of_host * mean) / (F.col("host_n") + of_host)
    sites = written(paths.alias("p").join(hosts.alias("h"), F.expr("p.host <=> h.host")).select(
        "p.host", "p.path", "p.n", "p.s", F.col("h.n").alias("host_n"), F.col("h.s").alias("host_s")), "sites")
    of_path = _strength(sites, theta, mean * (1 - mean))

    # Written tables and no hint: few sites are broadcast by their measured size, many are joined and a hot one split.
    at = scored.alias("d").join(sites.alias("t"), F.expr("d.host <=> t.host and d.path <=> t.path"))
    host_rate = ((F.col("host_s") - F.col("u")) / 1e6 + of_host * mean) / (F.col("host_n") - 1 + of_host)
    path_rate = ((F.col("s") - F.col("u")) / 1e6 + of_path * F.col("host_rate")) / (F.col("n") - 1 + of_path)
    prior = model.prior if model else 0.5
    rated = at.select(*[F.col(f"d.{c}") for c in (*KEY, "doc_id", "host", "path", "z", "u")], "n", "s", "host_n", "host_s") \
        .withColumn("host_rate", F.least(F.greatest(host_rate, F.lit(1e-6)), F.lit(1 - 1e-6))) \
        .withColumn("path_rate", F.least(F.greatest(path_rate, F.lit(1e-6)), F.lit(1 - 1e-6)))
    odds = F.col("z") - math.log(prior / (1 - prior)) + F.log(F.col("path_rate") / (1 - F.col("path_rate")))
    posterior = 1 / (1 + F.exp(-(odds if model else F.lit(1e3))))
    return rated.select(*KEY, "doc_id", "host", "path", (1 / (1 + F.exp(-F.col("z")))).alias("evidence"), "host_rate", "path_rate",
                        posterior.alias("posterior"), (posterior >= reject_below).alias("kept"))
