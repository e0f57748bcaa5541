"""Registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.llm.collocations import collocations
from casewatch.llm.exact_dedup import exact_dedup
from casewatch.llm.license_scan import find_licences
from casewatch.llm.license_scan import oracle as licence_oracle
from casewatch.llm.line_rules import quality_rules
from casewatch.llm.minhash import minhash_groups
from casewatch.llm.mixing import mix
from casewatch.llm.packing import pack_documents
from casewatch.llm.pii import find_pii
from casewatch.llm.prefix_trie import conversation_trie
from casewatch.llm.quality_classifier import quality_posteriors
from casewatch.llm.secret_scan import find_secrets
from casewatch.llm.simhash import simhash_groups
from casewatch.llm.tokens import token_histogram

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op5_exact_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op5_exact_dedup"] = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(body) AS text_sha256
FROM t WINDOW g AS (PARTITION BY body)
"""


@_query("op6_simhash_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@_query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_histogram(_table(spark, sf_dir, "documents"))


@_query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents")).drop("kf", "kr")


@_query("op2_pii_spans")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(_table(spark, sf_dir, "documents")).drop("kf", "kr")


@_query("op3_secret_spans")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_table(spark, sf_dir, "documents")).drop("kf", "kr")


@_query("op10_quality_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents")).drop("kf", "kr")


ORACLE["op10_quality_rules"] = r"""
WITH doc AS (
  SELECT doc_id, source, coalesce(text, '') AS text FROM documents
), word AS (
  SELECT doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM doc
), win AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS pos, w FROM word WHERE len(w) >= 6
), win_text AS (
  SELECT doc_id, pos, array_to_string(w[pos:pos + 4], ' ') AS five FROM win
), rep AS (
  SELECT doc_id, pos FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, five) AS c FROM win_text) WHERE c > 1
), rep_words AS (
  SELECT doc_id, count(DISTINCT pos + k) AS n FROM rep, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id
), line AS (
  SELECT doc_id, source, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM doc)
), full_line AS (
  SELECT doc_id, source, line, len(lw) AS size,
         translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM line WHERE len(lw) > 0
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_line GROUP BY doc_id
), host AS (
  SELECT source, count(*) AS host_docs FROM doc GROUP BY source
), common AS (
  SELECT l.source, norm FROM full_line l JOIN host h ON l.source IS NOT DISTINCT FROM h.source
  GROUP BY l.source, norm, host_docs
  HAVING count(DISTINCT doc_id) > 100 OR count(DISTINCT doc_id) > 20 AND count(DISTINCT doc_id) > 0.05 * host_docs
), lost AS (
  SELECT doc_id, sum(size) AS lost, count(DISTINCT l.norm) AS n
  FROM full_line l JOIN common c ON l.norm = c.norm AND l.source IS NOT DISTINCT FROM c.source GROUP BY doc_id
), counted AS (
  SELECT w.doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(d.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         len(w) - coalesce(lost, 0) AS words_left, coalesce(l.n, 0) AS n_common_lines
  FROM word w LEFT JOIN dup d USING (doc_id) LEFT JOIN rep_words r USING (doc_id) LEFT JOIN lost l USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, CAST(words_left AS BIGINT) AS words_left, n_common_lines,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND words_left >= 10 AND words_left >= 0.5 * n_words AS kept
FROM counted
"""


@_query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_posteriors(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("kf", "kr")


@_query("op4_mix_sources")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


@_query("op7_license_sentences")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licences(_table(spark, sf_dir, "documents")).drop("kf", "kr")


ORACLE["op7_license_sentences"] = licence_oracle()


@_query("op11_prefix_trie")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"))


ORACLE["op11_prefix_trie"] = r"""
WITH RECURSIVE crc AS (  -- the remainder of each byte, bit by bit
  SELECT b AS byte, b::UBIGINT AS r, 0 AS bit FROM (SELECT unnest(range(0, 256)) AS b)
  UNION ALL
  SELECT byte, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::UBIGINT) ELSE r >> 1 END, bit + 1 FROM crc WHERE bit < 8
), remainders AS (
  SELECT list(r ORDER BY byte) AS rem FROM crc WHERE bit = 8
), conv AS (
  SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL
), walk AS (
  SELECT c, 0 AS k, 4294967295::UBIGINT AS r FROM conv
  UNION ALL
  SELECT c, k + 1, xor(r >> 8, rem[(xor(r, ord(substr(CAST(c AS VARCHAR), k + 1, 1))::UBIGINT) & 255)::BIGINT + 1]) FROM walk, remainders WHERE k < length(CAST(c AS VARCHAR))
), shared AS (
  SELECT c, (xor(r, 4294967295::UBIGINT) % 6)::BIGINT AS h FROM walk WHERE k = length(CAST(c AS VARCHAR))
), turns AS (
  SELECT conv_id AS c, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS turn, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), whole AS (
  SELECT c, list(turn ORDER BY pos) AS own FROM turns GROUP BY c
), seq AS (
  SELECT s.c, list_concat(coalesce(b.own[1:h], []), w.own[h + 1:]) AS turns
  FROM shared s JOIN whole w USING (c) LEFT JOIN whole b ON b.c = s.c - s.c % 100
), path AS (
  SELECT c, turns, len(turns) AS size, d, CASE WHEN d = 0 THEN '' ELSE turns[1:d]::VARCHAR END AS name, CASE WHEN d > 1 THEN turns[1:d - 1]::VARCHAR ELSE '' END AS up,
         CASE WHEN d = 0 THEN 0 ELSE length(turns[d].t) END AS chars
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM seq)
), node AS (
  SELECT name, d, any_value(up) AS up, any_value(chars) AS chars, min(c) AS low, count(*) AS n, list(c) AS members,
         sha256(coalesce(string_agg(CASE WHEN size = d THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends
  FROM path GROUP BY name, d
), kids AS (
  SELECT up, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY up, d
), flat AS (
  SELECT p.c, n.name, n.d, n.low, (n.n - 1) * n.chars AS saved, k.n IS NULL AS leaf FROM path p JOIN node n ON p.name = n.name AND p.d = n.d LEFT JOIN kids k ON k.up = n.name AND k.d = n.d
), below AS (  -- a node is counted once, on the path of its smallest member
  SELECT a.name, a.d, sum(b.saved) AS saved, count(*) FILTER (b.leaf) AS leaves FROM flat a JOIN flat b ON a.c = b.c AND b.d >= a.d AND b.low = b.c GROUP BY a.name, a.d
)
SELECT n.low AS conv_id, n.d AS depth, p.low AS parent_conv_id, n.n AS n_convs, coalesce(k.n, 0) AS n_children, b.leaves AS n_leaves,
       b.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM node n JOIN below b ON b.name = n.name AND b.d = n.d LEFT JOIN kids k ON k.up = n.name AND k.d = n.d LEFT JOIN node p ON n.d > 0 AND p.name = n.up AND p.d = n.d - 1
"""


@_query("op12_minhash_near_dedup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_groups(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


ORACLE["op12_minhash_near_dedup"] = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM doc WHERE len(w) > 0)
), size AS (
  SELECT d.doc_id, count(s.s) AS n FROM doc d LEFT JOIN shingle s USING (doc_id) GROUP BY d.doc_id
), pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY x, y
), link AS (
  SELECT x, y FROM pair JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * pair.n >= 80 * (p.n + q.n - pair.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM doc
  UNION
  SELECT a, l.v FROM reach JOIN (SELECT x AS u, y AS v FROM link UNION ALL SELECT y, x FROM link) l ON b = l.u
)
SELECT a AS doc_id, n AS n_shingles, min(b) AS component_id, a = min(b) AS kept FROM reach JOIN size ON doc_id = a GROUP BY a, n
"""


@_query("op13_phrase_collocations")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


ORACLE["op13_phrase_collocations"] = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
        FROM documents)
), total AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM piece GROUP BY lang
), gram AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM piece, (SELECT unnest(range(1, 6)) AS k))
), f AS (
  SELECT lang, k AS size, phrase, count(*) AS a FROM gram GROUP BY ALL HAVING count(*) >= 100
), words AS (
  SELECT lang, size, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE size > 1
), cut AS (
  SELECT c.lang, c.phrase, c.a, l.a AS l, r.a AS r, n, (1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a) AS score, k
  FROM (SELECT *, unnest(range(1, size)) AS k FROM words) c JOIN total USING (lang)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), part AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS cover
  FROM (SELECT lang, w, a, size, m, unnest(range(1, size - m + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS m FROM words)) GROUP BY ALL
), kept AS (
  SELECT best.* FROM best LEFT JOIN part USING (lang, phrase) WHERE cover IS NULL OR 100 * cover < 100 * best.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase::BLOB) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase::BLOB) <= 2000
"""
