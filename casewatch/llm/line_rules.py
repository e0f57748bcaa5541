"""Quality rules: per-document counts, and lines that too many documents of a host share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import KEY, file_backed, keyed, written

#: A line is common on a host if more than this share of its documents, and MIN_DOCS of them, have it; or if
#: more than MAX_DOCS have it, however many documents the host has.
MAX_SHARE, MIN_DOCS, MAX_DOCS = 0.05, 20, 100
#: A document is depleted if fewer words, or a smaller share of its words, are left without its common lines.
MIN_WORDS, MIN_LEFT = 10, 0.5

_SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\v\f\r"
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _named(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for each distinct pair (a[i], b[i])."""
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """Words in windows of 5 words that occur at least twice, the first included. Exact: windows
    are compared by names of pairs of words, then pairs of pairs, not by a hash."""
    n = len(words) - window + 1
    if n < 2 or window != 5:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    if len(number) == len(words):
        return 0
    one = np.array(list(map(number.__getitem__, words)), np.int64)
    two = _named(one[:-1], one[1:])
    four = _named(two[:-2], two[2:])
    five = _named(four[:n], one[4:])
    hit = np.flatnonzero(np.bincount(five)[five] > 1)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + window, -1)
    return int((np.cumsum(cover) > 0).sum())


def _lines(text: str) -> list[tuple[str, list[bytes]]]:
    """Lines with a word, and their words."""
    return [(x, w) for x in text.split("\n") if (w := x.encode().split())]


def line_hash(words: list[bytes]) -> int:
    """Of the normalised line: A-Z lower-cased, one space between words."""
    return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(words).lower())).view(np.int64))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts, hashes, sizes = [], [], []
        for text in b.column("text").to_pylist():
            text = text or ""
            lines = _lines(text)
            words = [w for _, ws in lines for w in ws]
            own: dict[int, int] = {}
            for _, ws in lines:
                h = line_hash(ws)
                own[h] = own.get(h, 0) + len(ws)
            counts.append((len(words), len(text) - sum(map(text.count, _BLANKS)), sum(map(text.count, _SYMBOLS)),
                           len(lines) - len({x for x, _ in lines}), repeated_words(words)))
            hashes.append(list(own))
            sizes.append(list(own.values()))
        columns = list(zip(*counts, strict=True)) or [[]] * len(_COUNTS)
        yield pa.RecordBatch.from_arrays(
            [*[b.column(c) for c in ("kf", "kr", "doc_id", "host")], *[pa.array(c, pa.int64()) for c in columns],
             pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int64()))],
            names=["kf", "kr", "doc_id", "host", *_COUNTS, "hashes", "sizes"])


def _host(host: str):
    """The host, where null is a host of its own that no name equals."""
    return F.coalesce(F.concat(F.lit("h:"), F.col(host).cast("string")), F.lit("")).alias("host")


def _measured(docs: DataFrame, host: str) -> DataFrame:
    rows = keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), _host(host), F.col("text").cast("string").alias("text"))
    schema = "kf long, kr long, doc_id long, host string, " + ", ".join(f"{c} long" for c in _COUNTS)
    return written(rows.mapInArrow(_measure, f"{schema}, hashes array<long>, sizes array<long>"), "measured")


def common_lines(measured: DataFrame, max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS, max_docs: int = MAX_DOCS) -> DataFrame:
    """(host, h): hashes of lines in more documents of the host than the limits allow. A document
    counts once a line; each task counts its own documents first."""
    docs = measured.groupBy("host").agg(F.count("*").alias("host_docs"))
    lines = measured.select("host", F.explode("hashes").alias("h")).groupBy("host", "h").agg(F.count("*").alias("line_docs"))
    frequent = lines.filter(F.col("line_docs") > min(min_docs, max_docs))
    n = F.col("line_docs")
    over = (n > max_docs) | ((n > min_docs) & (n > max_share * F.col("host_docs")))
    return frequent.join(docs, "host").filter(over).select("host", "h")


def quality_rules(docs: DataFrame, host: str = "source", max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS,
                  max_docs: int = MAX_DOCS, min_words: int = MIN_WORDS, min_left: float = MIN_LEFT) -> DataFrame:
    """Per row of `docs`: kf, kr, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, words_left (without the host's common lines), n_common_lines, kept.

    base_failed: fewer than 10 words, or over 20 % of them in repeated 5-word windows. kept:
    not base_failed, and not depleted. Reads `doc_id`, `text` and the host column; other columns are
    ignored. A null text has no words; rows with a null host are one host of their own; repeated
    rows count as documents each; an empty table gives an empty result.
    """
    measured = _measured(docs, host)
    common = written(common_lines(measured, max_share, min_docs, max_docs), "common-lines")
    lines = measured.select(*KEY, "host", F.explode(F.arrays_zip("hashes", "sizes")).alias("x")).select(
        *KEY, "host", F.col("x.hashes").alias("h"), F.col("x.sizes").alias("size"))
    # No hint: both sides are written tables, so a small `common` is broadcast by its measured
    # size, and otherwise a line that most documents share is split at run time.
    lost = lines.join(common, ["host", "h"]).groupBy(*KEY).agg(F.sum("size").alias("lost"), F.count("*").alias("n_common_lines"))
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    depleted = (left < min_words) | (left < min_left * F.col("n_words"))
    return measured.drop("hashes", "sizes", "host").join(lost, KEY, "left").select(
        *KEY, "doc_id", *_COUNTS, failed.alias("base_failed"), left.alias("words_left"),
        F.coalesce("n_common_lines", F.lit(0)).alias("n_common_lines"), (~failed & ~depleted).alias("kept"))


def without_common_lines(docs: DataFrame, host: str = "source", max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS,
                         max_docs: int = MAX_DOCS) -> DataFrame:
    """kf, kr, doc_id, text of every row, without the lines that are common on its host (null stays null)."""
    docs = file_backed(docs)
    measured = _measured(docs, host)
    common = written(common_lines(measured, max_share, min_docs, max_docs), "common-lines")
    cut = measured.select(*KEY, "host", F.explode("hashes").alias("h")).join(common, ["host", "h"]).groupBy(*KEY).agg(
        F.collect_list("h").alias("cut"))  # at most the lines of one text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, gone in zip(b.column("text").to_pylist(), b.column("cut").to_pylist(), strict=True):
                if text is not None and gone:
                    gone = set(gone)
                    text = "\n".join(x for x in text.split("\n") if not ((w := x.encode().split()) and line_hash(w) in gone))
                out.append(text)
            yield pa.RecordBatch.from_arrays([b.column("kf"), b.column("kr"), b.column("doc_id"), pa.array(out, pa.string())],
                                             names=["kf", "kr", "doc_id", "text"])
    rows = keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.join(cut, KEY, "left").mapInArrow(run, "kf long, kr long, doc_id long, text string")
