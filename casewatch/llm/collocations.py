"""Phrase collocations by multikey three-way quicksort of suffix pointers.

Every word position begins a suffix of at most `MAX_WORDS` words. Suffixes are routed to range
partitions by their leading words, so a phrase's suffixes lie together, and a hot leading word or
pair is cut into several partitions. Each partition sorts pointers to its suffixes word by word:
the equal part of a three-way split at depth d holds the occurrences of one phrase of d words, and
its size is the count. A part below the minimum is abandoned, unless its phrase may go on in the
neighbouring partition; what the partitions find of such phrases is added up.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import ranked, written

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
#: Frequent words that are sent to every task as ids of 3 bytes; with more of them, words are named by 8-byte hashes.
VOCABULARY = 1 << 18
ID_BYTES = 3
#: Suffixes of one range partition, about.
PARTITION = 1 << 20
#: Positions whose suffixes a task holds at once.
_BLOCK = 1 << 18
_BREAK = b"."
_TABLE = bytes(b" "[0] if c == 9 else b"\n"[0] if chr(c) in ".,;:!?\n\v\f\r" else c for c in range(256))


def tokens(text: bytes) -> list[bytes]:
    """Words in lower case (A-Z), with `.` (never part of a word) between pieces."""
    return text.lower().translate(_TABLE).replace(b"\n", b" . ").split()


def _texts(b: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    texts = b.column("text").fill_null("").cast(pa.binary())
    for lang, text in zip(b.column("lang").to_pylist(), texts, strict=True):
        yield lang, tokens(text.as_py())


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts: dict[str, Counter] = {}
        for lang, words in _texts(b):
            own = counts.setdefault(lang, Counter())
            own.update(words)
            del own[_BREAK]
        rows = [(lang, w.decode(), n) for lang, own in counts.items() for w, n in own.items()]
        cols = list(zip(*rows, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())],
                                         names=["lang", "word", "n"])


def _suffixes(ids: dict[str, dict[bytes, int]] | None, width: int, max_words: int):
    """key (the suffix's word ids, big-endian, zeros after its end), n: equal suffixes of a batch as one row.

    A suffix ends with its piece and before a word that is known to be infrequent; single words are left out."""
    def codes(lang: str, words: list[bytes]) -> np.ndarray:
        if ids is not None:
            return np.fromiter(map(ids.get(lang, {}).get, words, [0] * len(words)), np.uint64, len(words))
        return np.fromiter((0 if w == _BREAK else word_code(lang, w) for w in words), np.uint64, len(words))

    def rows_of(a: np.ndarray) -> pa.RecordBatch:
        """The suffixes of the positions of `a` but for its last max_words."""
        n = len(a) - max_words
        rows, alive = np.zeros((n, max_words), np.uint64), np.ones(n, bool)
        for j in range(max_words):
            alive &= a[j:j + n] != 0
            rows[alive, j] = a[j:j + n][alive]
        rows = rows[rows[:, 1] != 0]
        rows = rows[np.argsort((rows[:, 0] << np.uint64(24)) + rows[:, 1])]  # neighbours share bytes, which the shuffle's compression saves
        data = np.ascontiguousarray(rows.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width:])
        keys = pa.Array.from_buffers(pa.binary(max_words * width), len(rows), [None, pa.py_buffer(data.tobytes())])
        table = pa.table({"key": keys}).group_by("key", use_threads=False).aggregate([([], "count_all")]).combine_chunks()
        return pa.RecordBatch.from_arrays([pa.concat_arrays(table["key"].chunks or [keys]).cast(pa.binary()),
                                           pa.concat_arrays(table["count_all"].chunks or [pa.array([], pa.int64())])], names=["key", "n"])

    def blocks(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        a = np.concatenate([*parts, np.zeros(max_words, np.uint64)])
        for at in range(0, len(a) - max_words, _BLOCK):
            yield rows_of(a[at:at + _BLOCK + max_words])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts, total = [], 0
            for lang, words in _texts(b):
                parts += [codes(lang, words), np.zeros(1, np.uint64)]
                total += len(words)
                if total > _BLOCK:
                    yield from blocks(parts)
                    parts, total = [], 0
            if parts:
                yield from blocks(parts)
    return run


def word_code(lang: str, word: bytes) -> int:
    """A name of 8 bytes for a word of a language; zero is kept for the end of a suffix."""
    import xxhash
    return xxhash.xxh64_intdigest(lang.encode() + b"\0" + word, 42) | 1


def multikey_quicksort(words: np.ndarray, weight: np.ndarray, least: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """(phrase, count) of every phrase of two words or more that begins suffixes of total weight `least` or more.

    `words` has a row of word ids per suffix, zeros after its end. Phrases that begin the smallest or
    the largest suffix come with any count.
    """
    if not len(words):
        return
    order = np.lexsort(words.T[::-1])[[0, -1]]  # the two suffixes that may share phrases with other partitions
    edges = [tuple(int(x) for x in words[i] if x) for i in order]
    open_prefixes = {e[:d] for e in edges for d in range(1, len(e) + 1)}
    parents = {p[:-1] for p in open_prefixes}
    todo = [(np.arange(len(words)), ())]
    while todo:
        pointers, phrase = todo.pop()
        depth = len(phrase)
        column = words[pointers, depth]
        pivot = column[len(column) // 2]
        less, more = column < pivot, column > pivot
        for side in (pointers[less], pointers[more]):
            if len(side) and (weight[side].sum() >= least or phrase in parents):
                todo.append((side, phrase))
        if not pivot:
            continue  # suffixes that end here
        equal, longer = pointers[~(less | more)], (*phrase, int(pivot))
        count = int(weight[equal].sum())
        if count >= least or longer in open_prefixes:
            if depth:
                yield longer, count
            if depth + 1 < words.shape[1]:
                todo.append((equal, longer))


def _phrases(width: int, max_words: int, least: int):
    def decoded(column: pa.BinaryArray) -> np.ndarray:
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].reshape(-1, width)
        whole = np.zeros((len(data), 8), np.uint8)
        whole[:, 8 - width:] = data
        return whole.view(">u8").astype(np.uint64 if width > 4 else np.uint32).reshape(-1, max_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, weights = [], []
        for b in batches:
            if len(b):
                parts.append(decoded(b.column("key")))
                weights.append(b.column("n").to_numpy(zero_copy_only=False).copy())
        if not parts:
            return
        keys, counts = [], []
        for phrase, n in multikey_quicksort(np.concatenate(parts), np.concatenate(weights), least):
            keys.append(b"".join(x.to_bytes(width, "big") for x in phrase))
            counts.append(n)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(counts, pa.int64())], names=["key", "f"])
    return run


def phrase_counts(docs: DataFrame, least: int = MIN_COUNT, max_words: int = MAX_WORDS, vocabulary: int = VOCABULARY,
                  partition: int = PARTITION) -> tuple[DataFrame, DataFrame, int]:
    """(words, phrases, width): words (lang, word, f, key) that occur `least` times or more in their
    language plus `n`, all its occurrences; phrases (key, f) of 2 to `max_words` words, key being
    the keys of their words in a row, `width` bytes each."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    counted = written(rows.mapInArrow(_count_words, "lang string, word string, n long")
                      .groupBy("lang", "word").agg(F.sum("n").alias("f")), "word-counts")
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = counted.filter(F.col("f") >= least)
    listed = frequent.orderBy(F.desc("f"), "lang", "word").limit(vocabulary + 1).toArrow().to_pylist()  # bounded by the parameter
    spark, ids, width = docs.sparkSession, None, 8
    if len(listed) <= vocabulary:
        ids, width = {}, ID_BYTES
        for i, r in enumerate(listed, 1):
            ids.setdefault(r["lang"], {})[r["word"].encode()] = i
        named = spark.createDataFrame([(r["lang"], r["word"], r["f"], i.to_bytes(width, "big")) for i, r in enumerate(listed, 1)],
                                      "lang string, word string, f long, key binary")
    else:
        def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                pairs = zip(b.column("lang").to_pylist(), b.column("word").to_pylist(), strict=True)
                keys = [word_code(lang, w.encode()).to_bytes(8, "big") for lang, w in pairs]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.binary())], names=[*b.schema.names, "key"])
        named = frequent.mapInArrow(hashed, "lang string, word string, f long, key binary")
    words = written(named.join(totals, "lang"), "words")
    n = counted.agg(F.sum("f")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // partition))
    # Equal suffixes are one row per batch, so a hot one is few rows; the range split cuts hot leading words.
    phrases = (rows.mapInArrow(_suffixes(ids, width, max_words), "key binary, n long").repartitionByRange(parts, "key")
               .mapInArrow(_phrases(width, max_words, least), "key binary, f long")
               .groupBy("key").agg(F.sum("f").alias("f")).filter(F.col("f") >= least))
    return words, written(phrases, "phrases"), width


def collocations(docs: DataFrame, least: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
                 vocabulary: int = VOCABULARY, partition: int = PARTITION) -> DataFrame:
    """Each language's `top` phrases: lang, rank, phrase, a, l, r, n, score.

    Reads `text` and `lang`; other columns are ignored. A null text has no words, a null lang counts
    as `und`; repeated rows count each time; an empty table gives an empty result. A phrase's score
    is that of its weakest cut, floor(1000 * a * n / (l * r)), ties to the earliest; a phrase inside
    a longer one that occurs as often is left out. Order: score, a (both falling), phrase in bytes.
    """
    words, phrases, width = phrase_counts(docs, least, max_words, vocabulary, partition)
    counts = written(phrases.select("key", "f").union(words.select("key", "f")), "phrase-f")
    size = (F.length("key") / F.lit(width)).cast("int")

    def part(key, start, length):
        """`length` words of a phrase from the word `start` (from 0) on."""
        return F.substring(key, start * width + 1, length * width)

    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select("key", "f", "k", part(F.col("key"), F.lit(0), F.col("k")).alias("left"), part(F.col("key"), F.col("k"), size - F.col("k")).alias("right"))
    left, right = (counts.select(F.col("key").alias(side), F.col("f").alias(side[0])) for side in ("left", "right"))
    first = words.select(F.col("key").alias("first"), "lang", "n")
    cuts = (cuts.join(left, "left").join(right, "right").withColumn("first", part(F.col("key"), F.lit(0), F.lit(1))).join(first, "first")
            .withColumn("score", F.expr("CAST(f AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0)) * CAST(1000 AS DECIMAL(4,0))"
                                        " DIV (CAST(l AS DECIMAL(17,0)) * CAST(r AS DECIMAL(17,0)))")))
    scored = cuts.groupBy("key").agg(F.min(F.struct("score", "k", "f", "l", "r", "n", "lang")).alias("s")).select("key", "s.*")

    inside = phrases.filter(size > 2).withColumn("m", F.explode(F.sequence(F.lit(2), size - 1)))
    inside = inside.withColumn("at", F.explode(F.sequence(F.lit(0), size - F.col("m"))))
    covers = inside.select(part(F.col("key"), F.col("at"), F.col("m")).alias("key"), "f").groupBy("key").agg(F.max("f").alias("cover"))
    kept = scored.join(covers, "key", "left").filter(F.col("cover").isNull() | (F.lit(100) * F.col("cover") < F.lit(100) * F.col("f")))

    # Names: at most `max_words` rows a phrase.
    spelled = (kept.select("key", F.posexplode(F.transform(F.sequence(F.lit(0), size - 1), lambda i: part(F.col("key"), i, F.lit(1)))).alias("at", "word_key"))
               .join(words.select(F.col("key").alias("word_key"), "word"), "word_key")
               .groupBy("key").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    # Ranks come from the place among all phrases, so no language is sorted in one task.
    order = ranked(kept.join(spelled, "key").select("lang", "phrase", F.col("f").alias("a"), "l", "r", "n", "score", (-F.col("score")).alias("by_score"), (-F.col("f")).alias("by_f")),
                   ["lang", "by_score", "by_f", "phrase"], "ranked-phrases")
    begin = order.groupBy("lang").agg(F.min("rank").alias("begin"))
    return (order.join(begin, "lang").withColumn("rank", F.col("rank") - F.col("begin") + 1).filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
