"""Encoded lengths by a public tokenizer, and the exact length histogram.

The tokenizer's file is named by a path that the executors can open; it is never copied.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import keyed, ranked

#: Pieces of text whose ids a worker keeps at once.
CACHED_PIECES = 1_000_000
GROUP_BYTES = 3 << 20
_WORDS_AT_ONCE = 200
#: A word and signs after it (no apostrophe, which may be part of a word, and no start of a special token).
_WORD_AND_SIGNS = re.compile(rb"([a-zA-Z\x80-\xff]+)([!-&(-/:;=-@\[-`{-~]*)")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class PieceEncoder:
    """Ids (little-endian unsigned 32-bit) of texts, encoded by pieces between ASCII white space.

    For tokenizers that drop white space, never look across it and ignore case (word_bpe_49k),
    which makes the ids of a text the ids of its pieces in a row. Pieces repeat, so each worker
    keeps the ids of those it has met, up to a bound; a word with signs after it is the word's ids
    and the signs'.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), {b"": b""}
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends_word[i] = token.endswith("</w>")

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_words(self, words: list[bytes]) -> None:
        """Words of Latin letters only: many at once, told apart by the tokens that end a word."""
        groups = [words[i:i + _WORDS_AT_ONCE] for i in range(0, len(words), _WORDS_AT_ONCE)]
        for group, ids in zip(groups, self._ids([b" ".join(g).decode() for g in groups]), strict=True):
            raw, ends = ids.tobytes(), (4 * np.flatnonzero(self.ends_word[ids]) + 4).tolist()
            parts = [raw[a:b] for a, b in itertools.pairwise([0, *ends])]
            if len(parts) != len(group):
                parts = [x.tobytes() for x in self._ids([w.decode() for w in group])]
            self.known.update(zip(group, parts, strict=True))

    def _learn(self, pieces: set[bytes]) -> None:
        if len(self.known) > CACHED_PIECES:
            self.known = {b"": b""}
        split, whole = {}, []
        for p in pieces.difference(self.known):
            if (m := _WORD_AND_SIGNS.fullmatch(p)) and _latin(m[1].decode()):
                split[p] = m.groups()
            else:
                whole.append(p)
        self._learn_words(list({w for w, _ in split.values()}.difference(self.known)))
        whole += {s for _, s in split.values()}.difference(self.known)
        self.known.update(zip(whole, (x.tobytes() for x in self._ids([p.decode() for p in whole])), strict=True))
        for p, (word, signs) in split.items():
            self.known[p] = self.known[word] + self.known[signs]

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text, in order. About GROUP_BYTES of text at once: its distinct pieces are looked up or
        learnt, and the ids of all its pieces copied together by their places."""
        at = 0
        while at < len(texts):
            group, total = [], 0
            while at < len(texts) and total < GROUP_BYTES:
                group.append(texts[at] if b"<|" in texts[at] else texts[at].lower())
                total += len(texts[at])
                at += 1
            split = pc.ascii_split_whitespace(pa.array(group, pa.large_binary()).cast(pa.large_string()))
            pieces = split.flatten().dictionary_encode()
            distinct = pieces.dictionary.cast(pa.large_binary()).to_pylist()
            self._learn(set(distinct))
            parts = [self.known[p] for p in distinct]
            sizes = np.fromiter(map(len, parts), np.int32, len(parts)) // 4
            ids, begin = np.frombuffer(b"".join(parts), "<u4"), np.cumsum(sizes) - sizes
            code = pieces.indices.to_numpy(zero_copy_only=False)
            size = sizes[code]
            end = np.append(0, np.cumsum(size))  # of every piece among the ids of the group
            place = np.arange(end[-1])
            place += np.repeat(begin[code] - end[:-1], size)
            ids = ids[place]
            bounds = end[split.offsets.to_numpy()].tolist()
            for a, b in itertools.pairwise(bounds):
                yield ids[a:b].tobytes()


def _latin(word: str) -> bool:
    """Letters that are one letter in lower case too, and that no later sign combines with."""
    return word.isascii() or max(word) < "\u0250" and word.lower().isalpha()


@cache
def encoder(path: str) -> PieceEncoder:
    """One per Python worker."""
    return PieceEncoder(path)


def _lengths(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").fill_null("").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([len(x) // 4 for x in encoder(path).encode(texts)], pa.int64())], names=["length"])
    return run


def token_histogram(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Exact length histogram with running sums, one row per distinct encoded length.

    Columns: length, n_docs, docs_upto and tokens_upto (documents of at most this length,
    and their tokens), docs_over (longer documents: the suffix sum), truncated_total (tokens
    that are left if every text is cut at this length: tokens_upto + length * docs_over),
    quantile (share of documents of at most this length). A limit between two rows has the
    counts of the row below it: see `at_limit`. Reads `text`; a null text counts as empty
    (length 0). An empty table gives an empty result.
    """
    path = tokenizer or default_tokenizer()
    lengths = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_lengths(path), "length long")
    # Partial aggregation: a length that a third of the documents share is one row per task.
    hist = lengths.groupBy("length").agg(F.count("*").alias("n_docs")).withColumn("tokens", F.col("length") * F.col("n_docs"))
    docs_before = ranked(hist, ["length"], "lengths", {"docs": "n_docs", "tokens": "tokens"})
    all_docs = docs_before.agg(F.sum("n_docs").alias("all_docs")).scalar()
    upto = F.col("docs_before") + F.col("n_docs")
    return docs_before.withColumn("all_docs", all_docs).select(
        "length", "n_docs", upto.alias("docs_upto"), (F.col("tokens_before") + F.col("tokens")).alias("tokens_upto"),
        (F.col("all_docs") - upto).alias("docs_over"),
        (F.col("tokens_before") + F.col("tokens") + F.col("length") * (F.col("all_docs") - upto)).alias("truncated_total"),
        (upto / F.col("all_docs")).alias("quantile"))


def at_limit(histogram: DataFrame, limit: int) -> DataFrame:
    """One row for any context limit: documents of at most `limit` tokens and their tokens, documents
    over it, and the tokens left of all when cut at it. All zero for an empty table."""
    within = F.col("length") <= limit
    return histogram.agg(
        F.coalesce(F.sum(F.when(within, F.col("n_docs"))), F.lit(0)).alias("n_docs"),
        F.coalesce(F.sum(F.when(within, F.col("n_docs") * F.col("length"))), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.when(~within, F.col("n_docs"))), F.lit(0)).alias("docs_over"),
        F.coalesce(F.sum(F.col("n_docs") * F.least("length", F.lit(limit))), F.lit(0)).alias("truncated_total"))


def length_at(histogram: DataFrame, q: float) -> DataFrame:
    """The smallest length that at least a share q of the documents doesn't exceed (null for an empty table)."""
    return histogram.filter(F.col("quantile") >= q).agg(F.min("length").alias("length"))


def _pieces(path: str, size: int, end: int):
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").fill_null("").cast(pa.binary()).to_pylist()
            counts, starts, lengths, sums = [], [], [], []
            for ids in encoder(path).encode(texts):
                ids += tail
                counts.append(-(-len(ids) // (4 * size)))
                for at in range(0, len(ids), 4 * size):
                    part = ids[at:at + 4 * size]
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
            of = pa.array(np.repeat(np.arange(len(counts)), counts))
            starts = np.array(starts, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).take(of) for c in ("kf", "kr", "doc_id")), pa.array((starts // size).astype(np.int32)), pa.array(starts),
                 pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
                names=["kf", "kr", "doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def token_pieces(docs: DataFrame, size: int, end: int = 1, tokenizer: str | None = None) -> DataFrame:
    """Every text's ids, then `end`, cut into pieces of at most `size`: kf, kr, doc_id, piece, start, length, ids_crc32."""
    rows = keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_pieces(tokenizer or default_tokenizer(), size, end),
                           "kf long, kr long, doc_id long, piece int, start long, length long, ids_crc32 long")
