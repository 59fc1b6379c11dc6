"""The operators on the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.llm import (
    alignment,
    archive,
    bpe,
    exact_dedup,
    filter_audit,
    mixing,
    near_dedup,
    neighbours,
    pii,
    quality,
    sharding,
    token_count,
    toxicity,
)
from dockcast.llm.common import held_out, table

TOKEN_LIMIT = 1024


def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    ledger = quality.with_ledger(table(spark, sf, "documents").select("doc_id", "text"))
    bits = F.col("ledger.failed_bits")
    base_failed = ~quality.keeps(quality.BASE, bits)
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return ledger.select(
        "doc_id", *[f"ledger.{m}" for m in measures], base_failed.alias("base_failed"),
        (~base_failed & quality.keeps(quality.PRODUCTION, bits)).alias("kept"), "ledger.failed_bits",
    )


def op2_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op3_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.spans(table(spark, sf, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(kind) for kind in pii.BASE],
        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
        pii.joined(F.concat("base", "added")).alias("spans"),
    )


def _scored(scores: DataFrame, least: float) -> DataFrame:
    return scores.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted")
    )


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return _scored(toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels"))), 0.5)


def op5_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.token_digests(table(spark, sf, "documents"), path, public_tokenizers.PATTERN)


def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op7_token_count(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    counts = token_count.token_counts(table(spark, sf, "documents"), path, public_tokenizers.PATTERN)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_warc(spark: SparkSession, sf: str) -> DataFrame:
    records = archive.read(archive.write(table(spark, sf, "pages")), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return _scored(neighbours.score(docs, neighbours.fit(docs, table(spark, sf, "labels"))), 0.3)


def op10_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align(table(spark, sf, "documents"), *paths, digest=True, pattern=public_tokenizers.PATTERN).withColumnRenamed("groups", "groups_sha256")


def op12_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shards(table(spark, sf, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        fn.__name__: fn
        for fn in (
            op1_quality_rules, op2_near_dedup, op3_pii, op4_toxicity, op5_bpe,
            op6_exact_dedup, op7_token_count, op8_warc, op9_quality_classifier, op10_mixing,
            op11_alignment, op12_sharding, op13_filter_audit,
        )
    }


# --- the same in SQL -----------------------------------------------------------------

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_DENSE = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')"

OP1_SQL = rf"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_WORDS} AS ws, {_DENSE} AS dense
  FROM documents),
g AS (
  SELECT rid, i, ws[i : i + 4] AS gram FROM w, unnest(range(1, len(ws) - 3)) AS u(i)),
c AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
r AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM c, unnest(range(0, 5)) AS u(k) GROUP BY rid),
l AS (
  SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM w),
m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(dense) AS BIGINT) AS word_chars,
    CAST(length(dense) - length(regexp_replace(dense, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(r.n_repeat_words, 0) AS n_repeat_words,
    CAST(len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS BIGINT) AS n_stutter,
    CAST(length(dense) - length(regexp_replace(dense, '\p{{Lu}}', '', 'g')) AS BIGINT) AS n_upper
  FROM w JOIN l USING (rid) LEFT JOIN r USING (rid)),
f AS (
  SELECT *, n_words < 10 AS f0, 100 * n_repeat_words > 20 * n_words AS f1, 100 * n_symbols > 20 * n_words AS f2,
    100 * n_dup_lines > 30 * n_lines AS f3, word_chars < 2 * n_words OR word_chars > 40 * n_words AS f4,
    100 * n_stutter > 30 * n_words AS f5, 100 * n_upper > 70 * word_chars AND word_chars > 0 AS f6
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f0 OR f1 AS base_failed,
  NOT (f0 OR f1 OR f2 OR f3 OR f4 OR f5 OR f6) AS kept,
  CAST(f0::INT + 2 * f1::INT + 4 * f2::INT + 8 * f3::INT + 16 * f4::INT + 32 * f5::INT + 64 * f6::INT AS BIGINT) AS failed_bits
FROM f"""

OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) END) AS grams FROM w),
e AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.gram = b.gram AND a.doc_id < b.doc_id
    AND 100 * a.n >= 75 * b.n AND 100 * b.n >= 75 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
reach AS (
  SELECT doc_id AS origin, doc_id AS node FROM s
  UNION
  SELECT reach.origin, y FROM reach JOIN both_ways ON node = x)
SELECT s.doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN (SELECT origin, min(node) AS component_id FROM reach GROUP BY origin) c ON s.doc_id = c.origin"""

OP6_SQL = rf"""
WITH d AS (SELECT doc_id, {_DENSE} AS dense, length(coalesce(text, '')) AS n FROM documents),
r AS (
  SELECT doc_id, sha256(dense) AS text_sha256, row_number() OVER o AS place, first_value(doc_id) OVER o AS keep_id,
    count(*) OVER (PARTITION BY dense) AS group_size
  FROM d WINDOW o AS (PARTITION BY dense ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r"""

OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
f AS (SELECT *, strlen(body) AS n, min(page_id) OVER (PARTITION BY body) AS first_id FROM p)
SELECT page_id, n AS payload_bytes, sha256(body) AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f"""

OP10_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, coalesce('s' || source, 'null') AS queue,
    md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS place
  FROM documents),
q AS (SELECT queue, min(source) AS source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY queue),
w AS (
  SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
    source_size * 2.0::DOUBLE AS most, sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM q),
v AS (
  SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY most / weight, queue ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, queue ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT queue, source_size, budget, least(most, max(level) OVER () * weight) AS target FROM v),
s AS (
  SELECT row_number() OVER () AS rid, d.*, source_size, budget, target,
    sum(size) OVER (PARTITION BY d.queue ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS sent
  FROM d JOIN t USING (queue)),
i AS (
  SELECT rid, size, budget, queue, place, sent, turn, (source_size * turn + sent) / target AS finish
  FROM s, unnest([0, 1]) AS u(turn) WHERE target > 0),
k AS (
  SELECT rid, size, budget, sum(size) OVER (ORDER BY finish, queue, place, sent, turn ROWS UNBOUNDED PRECEDING) AS total FROM i),
n AS (SELECT rid, count(*) AS times FROM k WHERE total <= budget GROUP BY rid)
SELECT doc_id, size, source_size, target, size * coalesce(times, 0) AS taken FROM s LEFT JOIN n USING (rid)"""


# Checksums by the table of the reversed polynomial, a byte at a time in chunks of 256 bytes counted from the
# end; a chunk's checksum is then moved past the bytes behind it, bit by bit (p: each bit after j chunks of zeros).
OP12_SQL = r"""
WITH RECURSIVE t AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS tab
  FROM (SELECT CAST(range AS BIGINT) AS n FROM range(256))),
p AS (
  SELECT 0 AS j, CAST(range AS INT) AS k, CAST(1 AS BIGINT) << range AS v FROM range(32)
  UNION ALL
  SELECT j + 1, k, list_reduce(list_prepend(v, list_transform(range(256), lambda i: CAST(0 AS BIGINT))), lambda c, x: xor(c >> 8, tab[(c & 255) + 1]))
  FROM p, t WHERE j < (SELECT max(strlen(text)) // 256 FROM documents)),
d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
h AS (SELECT rid, strlen(text) AS n, hex(encode(text)) AS x FROM d),
b AS (
  SELECT rid, j, j + 1 >= n / 256 AS leads, substr(x, greatest(0, n - 256 * (j + 1)) * 2 + 1, (n - 256 * j - greatest(0, n - 256 * (j + 1))) * 2) AS x
  FROM h, unnest(range(0, greatest(1, (n + 255) // 256))) AS u(j)),
e AS (
  SELECT rid, j, list_reduce(list_prepend(CASE WHEN leads THEN 4294967295 ELSE 0 END,
    list_transform(range(0, length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
    lambda c, y: xor(c >> 8, tab[(xor(c, y) & 255) + 1])) AS own FROM b, t),
c AS (
  SELECT rid, xor(4294967295, bit_xor(CASE WHEN own >> k & 1 = 1 THEN v ELSE 0 END)) AS crc FROM e JOIN p USING (j) GROUP BY rid),
s AS (
  SELECT doc_id, source, strlen(text) + 1 AS size, crc,
    md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(text)) AS place
  FROM d JOIN c USING (rid)),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY place) AS rank, count(*) OVER (PARTITION BY source) AS n FROM s),
o AS (
  SELECT *, row_number() OVER (ORDER BY (rank - CAST('0x' || substr(md5('0:' || coalesce('0' || source, '1')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)
      / CAST(n AS DOUBLE), source IS NULL, source, rank) - 1 AS idx,
    count(*) OVER () AS total FROM r)
SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, CAST(idx * 16 // total AS INT) AS shard,
  idx - (idx * 16 // total * total + 15) // 16 AS slot, CAST(NULL AS INT) AS grown_shard
FROM o"""

OP13_SQL = rf"""
WITH RECURSIVE orders AS (
  SELECT '' AS o
  UNION ALL
  SELECT o || l FROM orders, unnest(['A', 'B', 'C', 'D', 'E']) AS u(l) WHERE length(o) < 5 AND NOT contains(o, l)),
steps AS (
  SELECT o AS filter_order, CAST(k AS INT) AS step, substr(o, k, 1) AS own, substr(o, 1, k - 1) AS prior
  FROM orders, unnest(range(1, 6)) AS u(k) WHERE length(o) = 5),
w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_WORDS} AS ws, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN first_id < w.doc_id THEN 'E' ELSE '' END AS failed
  FROM w LEFT JOIN l USING (doc_id)),
m AS (
  SELECT part, failed, count(*) AS n, sum(good) AS n_good, sum(toxic) AS n_toxic FROM f GROUP BY part, failed),
x AS (
  SELECT *, contains(failed, own) AS fails, length(translate(failed, prior, '')) < length(failed) AS earlier FROM m, steps)
SELECT part, filter_order, step,
  CAST(coalesce(sum(n) FILTER (NOT fails AND NOT earlier), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER (fails AND NOT earlier), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(n) FILTER (fails AND earlier), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (failed = own), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(n_good) FILTER (fails AND NOT earlier), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(n_toxic) FILTER (fails AND NOT earlier), 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(n * (120 // greatest(length(failed), 1))) FILTER (fails), 0) AS BIGINT) AS shapley
FROM x GROUP BY part, filter_order, step"""


def oracle_sql() -> dict[str, str]:
    """SQL for the operators that SQL can express."""
    return {
        "op1_quality_rules": OP1_SQL, "op2_near_dedup": OP2_SQL, "op6_exact_dedup": OP6_SQL,
        "op8_warc": OP8_SQL, "op10_mixing": OP10_SQL, "op12_sharding": OP12_SQL, "op13_filter_audit": OP13_SQL,
    }
