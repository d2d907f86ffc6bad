"""The numbered queries over the synthetic tables, with reference SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, audit, bpe, ctw, exact, hilbert, mixing, neardup, packing, resampling, substring, toxicity, warc
from .staging import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query("op5_exact_dedup", r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept,
       sha256(body) AS text_sha256
FROM t WINDOW g AS (PARTITION BY body)""")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return exact.classes(_table(spark, folder, "documents"))


@_query("op7_warc", r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT *, sha1(body) AS hex, max(page_id) OVER (PARTITION BY body) AS keeper FROM p)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((
    CAST('0x' || substr(hex, CAST(1 + 10 * (k // 8) AS INTEGER), 10) AS BIGINT) >> CAST(5 * (7 - k % 8) AS INTEGER)) & 31) + 1 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM h""")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "archives")
    warc.write(warc.plan_records(_table(spark, folder, "pages")), path)
    records = warc.check_payloads(warc.read(spark, path))
    return records.select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("long"), F.col("http_length")).alias("payload_bytes"),
        F.expr("substr(payload_digest, 6)").alias("payload_digest"), "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"))


@_query("op10_substring_dedup")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring.cut_repeats(_table(spark, folder, "documents"))
    return cut.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query("op4_minhash_near_dedup")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.near_duplicates(_table(spark, folder, "documents"), shingle=4)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                        F.col("id").eqNullSafe(F.col("component")).alias("kept"))


@_query("op8_bpe_words")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    encoded = bpe.encode(_table(spark, folder, "documents"))
    decoded = bpe.decode(encoded.select("id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids"))
    return decoded.select(F.col("id").alias("doc_id"), "n_tokens", "ids_sha256",
                          F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


@_query("op9_packing")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@_query("op2_toxicity")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, _table(spark, folder, "labels")))
    return scored.select(F.col("id").alias("doc_id"), (toxicity.fold(F.col("id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query("op3_context_tree")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return ctw.score(docs, toxicity.fold(F.col("doc_id")) == 1).withColumnRenamed("id", "doc_id")


@_query("op1_hilbert_shards")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    placed = hilbert.shard(_table(spark, folder, "documents"), 24)
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@_query("op6_multi_index_hashing")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@_query("op11_source_mix", r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
r AS (SELECT doc_id AS rated, max(quality) AS rating FROM labels GROUP BY 1),
s AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS place FROM d GROUP BY 1),
w AS (SELECT *, 1 + (place - 1) % 3 AS weight, 3 * source_size AS cap, sum(source_size) OVER () AS total, sum(1 + (place - 1) % 3) OVER () AS heads FROM s),
o AS (SELECT *, coalesce(sum(cap) OVER before, 0) AS gone, coalesce(sum(weight) OVER before, 0) AS settled FROM w
      WINDOW before AS (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, cap * (heads - settled) <= weight * (total - gone) AS full_ FROM o),
t AS (SELECT source, source_size, weight, cap, full_, total - coalesce(sum(cap) FILTER (WHERE full_) OVER (), 0) AS rest_total,
             heads - coalesce(sum(weight) FILTER (WHERE full_) OVER (), 0) AS rest_weight FROM f),
b AS (SELECT source, source_size, CASE WHEN full_ THEN cap::DOUBLE ELSE (weight * rest_total)::DOUBLE / rest_weight::DOUBLE END AS target,
             CASE WHEN full_ THEN cap ELSE weight * rest_total // rest_weight END AS budget FROM t),
e AS (SELECT *, budget // greatest(source_size, 1) AS epochs, budget % greatest(source_size, 1) AS rest FROM b),
k AS (SELECT doc_id, size, e.*, -ln((CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE)
        / CASE WHEN rated IS NULL THEN 1.0::DOUBLE WHEN rating > 0 THEN 3.0::DOUBLE ELSE 0.5::DOUBLE END AS key
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source LEFT JOIN r ON doc_id = rated),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       (epochs * size + greatest(least(rest - before, size), 0))::BIGINT AS taken FROM p""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    good = F.when(F.col("quality") > 0, 3.0).otherwise(0.5)
    ratings = _table(spark, folder, "labels").select(F.col("doc_id").alias("id"), good.alias("quality"))
    mixed = mixing.mix(_table(spark, folder, "documents"), ratings=ratings)
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@_query("op12_source_divergence", r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
w AS (SELECT k, lang, source, unnest(terms) AS term FROM d),
keep AS (SELECT lang, term, count(*) AS total FROM w GROUP BY 1, 2 HAVING count(DISTINCT k) >= 3),
v AS (SELECT lang, count(*) AS kept, sum(total) AS words FROM keep GROUP BY 1),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN keep USING (lang, term) GROUP BY 1, 2, 3),
gn AS (SELECT lang, source, coalesce(sum(n), 0) AS words FROM g LEFT JOIN c USING (lang, source) GROUP BY 1, 2),
q AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (total + 1) // (words + kept) AS q FROM keep JOIN v USING (lang)),
p AS (SELECT gn.lang, gn.source, keep.term, coalesce(n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(n, 0) + 1) // (gn.words + v.kept) AS p
      FROM gn JOIN v ON gn.lang = v.lang JOIN keep ON gn.lang = keep.lang
      LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = keep.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL
      SELECT p.lang, p.source, 'term', p.term, (p - q) * (p - q) // q FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q),
r AS (SELECT lang, source, part, item, value::BIGINT AS value,
             CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM f)
SELECT * FROM r WHERE part = 'pair' OR rank <= 200""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return audit.divergence(_table(spark, folder, "documents"))


@_query("op13_target_resampling")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark")).withColumnRenamed("id", "doc_id")
