"""The operators of this package over the given tables, and their SQL answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.llm import (
    chat, exact_dedup, licenses, mixing, negatives, pii, quality, ranked, simhash, substring, subword, topk, warc,
)
from accesslens.llm.common import table

SPACE = r"[^\x20\x09-\x0D]+"


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(table(spark, sf_dir, "documents"))


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicate(table(spark, sf_dir, "documents"), texts=False)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With conversation -7, whose two turns hold control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    both = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.read_back(chat.formatted(rows.unionByName(both)))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_subword(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword.encoded(table(spark, sf_dir, "documents"), ids=False)


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), spans=False)


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), k=5, every=100)


def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring,
        op2_chat,
        op3_mixing,
        op4_personal_data,
        op5_warc,
        op6_exact_dedup,
        op7_top_k,
        op8_simhash,
        op9_quality,
        op10_subword,
        op11_licenses,
        op12_negatives,
        op13_ranked,
    )
}

ORACLES: dict[str, str] = {}

ORACLES["op6_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# Caps in rising order of cap over weight; the extra copy by rank, cut where the words come nearest.
ORACLES["op3_mixing"] = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(text, '')) AS digest
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sizes GROUP BY source),
filled AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
         coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM per WINDOW o AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source NULLS LAST)),
capped AS (SELECT *, (total - caps) * weight >= cap * weights AS full_ FROM filled),
shared AS (
  SELECT *, total - coalesce(sum(CASE WHEN full_ THEN cap END) OVER (), 0) AS rest,
         sum(CASE WHEN NOT full_ THEN weight END) OVER () AS free FROM capped),
goal AS (
  SELECT source, source_size,
         CASE WHEN full_ THEN CAST(cap AS DOUBLE) ELSE CAST(rest * weight AS DOUBLE) / CAST(free AS DOUBLE) END AS target
  FROM shared),
split AS (
  SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS certain FROM goal),
parts AS (
  SELECT *, target - CAST(certain * source_size AS DOUBLE) AS extra,
         CASE WHEN source_size > 0 THEN (target - CAST(certain * source_size AS DOUBLE)) / source_size ELSE 0 END AS part
  FROM split),
drawn AS (
  SELECT s.doc_id, s.size, p.*,
         (CAST(CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(s.doc_id AS VARCHAR), 'null') || ':' || s.digest), 1, 13) AS BIGINT) AS DOUBLE)
          + 0.5) / 4503599627370496.0 AS u
  FROM sizes s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source),
odds AS (
  SELECT *, CASE WHEN part > 0 AND part < 1 THEN (u / (1 - u)) / (part / (1 - part)) END AS q FROM drawn),
ranked AS (SELECT *, CAST(floor(q / (1 + q) * 68719476736.0) AS BIGINT) AS rank FROM odds),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY source, rank) AS here,
         sum(size) OVER (PARTITION BY source ORDER BY rank RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM ranked),
cut AS (
  SELECT source, min(rank) AS rank FROM summed WHERE rank IS NOT NULL AND upto >= extra GROUP BY source),
taken AS (
  SELECT s.*, s.rank < c.rank OR s.rank = c.rank AND abs(upto - extra) < abs(upto - here - extra) AS more
  FROM summed s LEFT JOIN cut c ON s.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (certain + CASE WHEN more THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM taken
"""

ORACLES["op5_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < original THEN original END AS refers_to
FROM o
"""

ORACLES["op7_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

# A text with a control string or an escape code is escaped: one more code point for each of \ < [.
ORACLES["op2_chat"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (
  SELECT *, regexp_matches(text, '</?s>|\[/?(SYS|INST|OUT|ROLE)\]|\\[blk]') AS hard FROM t),
n AS (
  SELECT *,
         3 + CASE role WHEN 'system' THEN 5 WHEN 'user' THEN 6 WHEN 'assistant' THEN 5
                  ELSE 13 + length(role) + length(regexp_replace(role, '[^\\<\[]', '', 'g')) END
           + length(text) + CASE WHEN hard THEN length(regexp_replace(text, '[^\\<\[]', '', 'g')) ELSE 0 END + 4 AS chars
  FROM f)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars, TRUE AS round_trip
FROM n GROUP BY conv_id
"""

# Terms are words of digits, letters and characters beyond ASCII; only A-Z are lower-cased.
ORACLES["op13_ranked"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
total AS (
  SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS terms FROM d WHERE len(terms) > 0),
tf AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY row, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL),
weighed AS (
  SELECT item_id, term,
         CAST(floor(1000 * ln(CAST(2 * total.docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM asked JOIN df USING (term), total),
long_ AS (
  SELECT doc_id, row, 50 + (50 * len(d.terms) * total.docs) // total.terms AS m FROM d, total WHERE len(d.terms) > 0),
scored AS (
  SELECT item_id, doc_id, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM weighed JOIN tf USING (term) JOIN long_ USING (row) GROUP BY item_id, doc_id, row),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLES["op12_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.e, c.e), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id AND len(c.e) = len(a.e) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same),
n AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
    AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
  WHERE place <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
