"""Queries of the operators for training text: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm import pieces
from runlens.llm.byteconv import identify_language
from runlens.llm.compact_windows import repeated_passages
from runlens.llm.exact_dedup import exact_groups
from runlens.llm.fertility import tokenizer_fertility
from runlens.llm.hard_negatives import hard_negatives
from runlens.llm.license_scan import TEMPLATES, scan
from runlens.llm.license_scan import THRESHOLD as SCAN_THRESHOLD
from runlens.llm.main_text import main_text
from runlens.llm.mixing import Target, mix, positions
from runlens.llm.prefix_trie import prefix_trie
from runlens.llm.rp_forest import nearest
from runlens.llm.site_quality import classify
from runlens.llm.weighted_minhash import near_duplicates

# Passes over the smallest source for one over the largest; blocks of the mixture.
MIX_REPETITION = 2.0
MIX_TARGET = Target(max_repetition=MIX_REPETITION)
MIX_BLOCKS = 64

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_tokenizer_fertility(spark, sf_dir):
    return tokenizer_fertility(_table(spark, sf_dir, "documents"))


@query
def op2_rp_forest(spark, sf_dir):
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op3_site_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    found = classify(docs, _table(spark, sf_dir, "labels"), F.col("source"),
                     F.concat_ws("/", "source", "lang"), ["doc_id"])
    return found.select("row.doc_id", F.col("host").alias("source"), "path", "n_host", "n_path", "p_text",
                        "p_host", "p_path", "score", "kept")


@query
def op4_byte_convnet(spark, sf_dir):
    return identify_language(_table(spark, sf_dir, "documents"))


@query
def op5_temperature_mixing(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = positions(mix(docs, MIX_TARGET, n_blocks=MIX_BLOCKS))
    return mixed.select("doc_id", "source", "plan.pass_no", "plan.block", "position", "plan.tokens",
                        F.round("plan.weight", 6).alias("weight"), F.round("plan.passes", 6).alias("passes"))


ORACLE["op5_temperature_mixing"] = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) + 1 AS tokens
  FROM documents),
totals AS (SELECT source, count(*) AS n_docs, sum(tokens)::BIGINT AS n_tokens FROM docs GROUP BY source),
ends AS (SELECT min(n_tokens)::DOUBLE AS least, max(n_tokens)::DOUBLE AS most FROM totals),
-- Passes over the smallest source against the largest fall as the exponent grows.
bisect(step, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1,
         CASE WHEN pow(least / most, (low + high) / 2 - 1) <= {MIX_REPETITION} THEN low ELSE (low + high) / 2 END,
         CASE WHEN pow(least / most, (low + high) / 2 - 1) <= {MIX_REPETITION} THEN (low + high) / 2 ELSE high END
  FROM bisect, ends WHERE step < 42),
alpha AS (SELECT CASE WHEN pow(least / most, -1.0) <= {MIX_REPETITION} THEN 0.0 ELSE high END AS alpha
          FROM bisect, ends WHERE step = 42),
powered AS (SELECT totals.*, pow(n_tokens / most, alpha) AS w FROM totals, ends, alpha),
scales AS (SELECT sum(w) AS z, max(n_tokens / w) AS scale FROM powered),
weights AS (SELECT powered.*, w / z AS weight, greatest(round(w * scale), 1)::BIGINT AS quota FROM powered, scales),
copies AS (
  SELECT d.*, pass_no, quota, n_tokens, weight, md5('17:' || pass_no || ':' || coalesce(doc_id::VARCHAR, '')) AS ord
  FROM docs d JOIN weights w ON d.source IS NOT DISTINCT FROM w.source,
       LATERAL (SELECT unnest(range(0, ceil(quota / n_tokens)::BIGINT)) AS pass_no)),
placed AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source ORDER BY pass_no, ord, tokens
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS beginning FROM copies),
used AS (SELECT *, floor(beginning * {MIX_BLOCKS} / quota)::INTEGER AS block FROM placed WHERE beginning < quota)
SELECT doc_id, source, pass_no::INTEGER AS pass_no, block,
       row_number() OVER (PARTITION BY block ORDER BY ord, doc_id, source) - 1 AS position, tokens,
       round(weight, 6) AS weight, round(quota / n_tokens, 6) AS passes
FROM used
"""


@query
def op6_main_text(spark, sf_dir):
    return main_text(_table(spark, sf_dir, "pages"))


@query
def op9_stream_viterbi(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    encoded = pieces.encode(docs, ["doc_id", "text"])
    decoded = pieces.decode(encoded, ["row", "n_pieces", "n_byte_pieces", "ids"])
    return decoded.select("row.row.doc_id", "row.n_pieces", "row.n_byte_pieces", F.xxhash64("row.ids").alias("ids_hash"),
                          F.col("row.row.text").eqNullSafe(F.col("text")).alias("round_trip"))


@query
def op7_weighted_minhash(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents"))


@query
def op8_compact_windows(spark, sf_dir):
    return repeated_passages(_table(spark, sf_dir, "documents"))


@query
def op10_license_scan(spark, sf_dir):
    found = scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "license", F.round("containment", 6).alias("containment"), "first_word")


_LICENSES = ", ".join(f"('{name}', '{text}')" for name, text in sorted(TEMPLATES.items()))
ORACLE["op10_license_scan"] = rf"""
WITH templates AS (
  SELECT name, list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s
  FROM (SELECT name, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM (VALUES {_LICENSES}) AS t(name, text))),
docs AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM documents),
shingles AS (
  SELECT doc_id, unnest(range(0, len(w) - 2)) AS place, unnest(list_transform(range(1, len(w) - 1),
         lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS shingle FROM docs WHERE len(w) >= 3)
SELECT doc_id, name AS license, round(count(DISTINCT x.shingle) / any_value(len(t.s)), 6) AS containment, min(place) AS first_word
FROM shingles x JOIN (SELECT *, unnest(s) AS shingle FROM templates) t USING (shingle)
GROUP BY doc_id, name HAVING count(DISTINCT x.shingle) / any_value(len(t.s)) >= {SCAN_THRESHOLD}
"""


@query
def op11_exact_dedup(spark, sf_dir):
    return exact_groups(_table(spark, sf_dir, "documents"))


ORACLE["op11_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


ANCHOR_STEP = 50


@query
def op13_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % ANCHOR_STEP == 0, label)


ORACLE["op13_hard_negatives"] = f"""
WITH rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, list_dot_product(a.v, r.v)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % {ANCHOR_STEP} = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER best::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 3
"""


@query
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie(_table(spark, sf_dir, "conversations"))


# CRC-32 of the decimal id, bit by bit.
_CRC32 = """xor(4294967295::UBIGINT, list_reduce(list_transform(string_split({}, ''), lambda c: ord(c)::UBIGINT),
         lambda crc, byte: list_reduce(list_transform(range(8), lambda k: k::UBIGINT),
           lambda s, k: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384::UBIGINT) ELSE s >> 1 END, xor(crc, byte)),
         4294967295::UBIGINT))"""
ORACLE["op12_prefix_trie"] = f"""
WITH items AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, {_CRC32.format("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM items)),
turns AS (
  SELECT c.conv_id, 0 AS part, pos, role, text FROM convs c JOIN items i ON i.conv_id = c.conv_id - c.conv_id % 100 AND pos < h
  UNION ALL SELECT c.conv_id, 1, pos, role, text FROM convs c JOIN items i ON i.conv_id = c.conv_id AND pos >= h),
paths AS (SELECT conv_id, list({{'r': role, 't': text}} ORDER BY part, pos) AS p FROM turns GROUP BY conv_id),
lists AS (SELECT conv_id, coalesce(p, []) AS p FROM convs LEFT JOIN paths USING (conv_id)),
members AS (
  SELECT conv_id, d, sha256(to_json(list_slice(p, 1, d))) AS node, d = len(p) AS at_end,
         CASE WHEN d = 0 THEN 0 ELSE length(list_extract(p, d).t) END AS chars
  FROM (SELECT *, unnest(range(0, len(p) + 1)) AS d FROM lists)),
nodes AS (
  SELECT node, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (at_end), '')) AS ends_sha256
  FROM members GROUP BY node, d),
linked AS (
  SELECT n.*, m.node AS parent FROM nodes n LEFT JOIN members m ON m.conv_id = n.conv_id AND m.d = n.depth - 1),
counted AS (
  SELECT l.*, (SELECT count(*) FROM linked c WHERE c.parent = l.node) AS n_children FROM linked l),
subtrees AS (
  SELECT m.node, count(*) FILTER (c.n_children = 0) AS n_leaves, sum((c.n_convs - 1) * c.chars)::BIGINT AS saved_tokens
  FROM counted c JOIN members m ON m.conv_id = c.conv_id AND m.d <= c.depth GROUP BY m.node)
SELECT c.conv_id, c.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees USING (node) LEFT JOIN nodes p ON p.node = c.parent
"""
