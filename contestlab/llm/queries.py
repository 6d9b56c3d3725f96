"""The registered queries: each operator over the whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from contestlab.llm import bpe, digest, lines, mixing, near, quality_model, quality_rules, resample, search, secrets, sharding, spans, toxicity
from contestlab.llm.common import WORD, documents, sha256, whole

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


@query("op1_mix_sources", r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS seeded
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM s0),
s2 AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS weight,
         coalesce(sum(3 * source_size) OVER before, 0) AS capped, coalesce(sum(w) OVER before, 0) AS gone,
         row_number() OVER (ORDER BY 3 * source_size / w, source NULLS LAST) AS pos
       FROM s1 WINDOW before AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
edge AS (SELECT capped, gone, total, weight, pos FROM s2 WHERE w * (total - capped) <= 3 * source_size * (weight - gone) ORDER BY pos LIMIT 1),
s3 AS (SELECT s.source, s.source_size,
         CASE WHEN s.pos < e.pos THEN (3 * s.source_size)::DOUBLE
              ELSE (s.w * (e.total - e.capped))::DOUBLE / (e.weight - e.gone)::DOUBLE END AS target
       FROM s2 s, edge e),
q AS (SELECT *, floor(target)::BIGINT // greatest(source_size, 1) AS passes, floor(target)::BIGINT % greatest(source_size, 1) AS rest FROM s3),
t AS (SELECT d.*, sum(size) OVER (PARTITION BY source ORDER BY seeded, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM d)
SELECT t.doc_id, t.size::BIGINT AS size, q.source_size, q.target,
  (q.passes * t.size + greatest(0, least(t.size, q.rest - t.upto + t.size)))::BIGINT AS taken
FROM t JOIN q ON t.source IS NOT DISTINCT FROM q.source
""")
def mix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    mix = mixing.mix_sources(docs, "doc_id", F.regexp_count(whole(F.col("text")), F.lit(WORD)), F.array("source"))
    by_source = mix.rows.join(F.broadcast(mixing.facts(spark, mix)), F.col("pattern")[0].eqNullSafe(F.col("name")), "left")
    return by_source.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op5_line_dedup", r"""
WITH l AS MATERIALIZED (
  SELECT doc_id, unnest(generate_series(1, len(a))) AS pos, unnest(a) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
k AS (SELECT doc_id, pos, line,
        translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (first < doc_id)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (first IS NULL OR first = doc_id), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY doc_id
""")
def lines_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(documents(spark, sf_dir))
    return out.select(F.col("key").alias("doc_id"), "n_lines", "n_dropped", sha256(F.col("kept")).alias("kept_sha256"))


@query("op6_shard_documents")
def shard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = whole(F.col("text"))
    out = sharding.shard_documents(
        documents(spark, sf_dir), F.col("doc_id"), F.octet_length(text).cast("long") + 1, F.crc32(text), F.md5(text))
    return out.select(
        F.col("key").alias("doc_id"), F.col("size").cast("long").alias("size"), F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


@query("op7_quality_rules")
def rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir)).select(
        F.col("key").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "class_distance", "word_distance")


@query("op10_quality_classifier")
def classifier_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.classify(documents(spark, sf_dir), labels).withColumnRenamed("key", "doc_id")


@query("op3_secret_scan")
def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(documents(spark, sf_dir))
    base = F.filter("spans", lambda x: x.kind < 3)
    kinds = F.transform("spans", lambda x: x["name"])
    counts = [F.size(F.filter(kinds, F.lit(name).__eq__)).cast("long").alias(f"n_{name}") for name in secrets.KINDS]
    return out.select(F.col("key").alias("doc_id"), *counts, sha256(secrets.listed(base)).alias("base_sha256"),
                      secrets.listed(F.col("spans")).alias("spans"))


@query("op9_span_dedup")
def spans_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spans.remove_repeats(documents(spark, sf_dir))
    return out.select(F.col("key").alias("doc_id"), "n_sentences", "n_removed", sha256(F.col("kept")).alias("kept_sha256"),
                      F.col("kept").alias("kept_text"))


@query("op4_fingerprints")
def digest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.fingerprints(documents(spark, sf_dir)).withColumnRenamed("key", "doc_id")


def vocabulary(path: str | None = None) -> bpe.Vocabulary:
    import public_tokenizers

    return bpe.Vocabulary.read(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op2_byte_bpe")
def bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(documents(spark, sf_dir), vocabulary()).withColumnRenamed("key", "doc_id")


@query("op8_near_duplicates")
def near_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(documents(spark, sf_dir)).select(F.col("key").alias("doc_id"), "class_id", "n_links", "n_copies")


@query("op11_resample", r"""
WITH k AS MATERIALIZED (
  SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), x)) AS crc),
w AS (SELECT row, own, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM (SELECT row, true AS own, coalesce(text, '') AS text FROM (SELECT row_number() OVER () AS row, text FROM documents)
            UNION ALL SELECT 0, false, coalesce(text, '') FROM benchmark)),
f AS MATERIALIZED (
  SELECT row, own, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS feature FROM w),
b AS MATERIALIZED (
  SELECT feature, xor(4294967295, list_reduce(
      list_transform(range(octet_length(encode(feature))), lambda i: ('0x' || substr(hex(encode(feature)), (2 * i + 1)::INT, 2))::BIGINT),
      lambda a, x: xor(a >> 8, crc[1 + (xor(a, x) & 255)]), 4294967295)) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM f), k),
n AS (SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM f JOIN b USING (feature) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM n),
m AS (SELECT row, count(*)::BIGINT AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
      FROM f JOIN b USING (feature) JOIN g USING (bucket) WHERE own GROUP BY row),
d AS (SELECT doc_id, coalesce(len(w.w), 0)::BIGINT AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('7:' || doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
      FROM (SELECT doc_id, row_number() OVER () AS row FROM documents) JOIN w USING (row) LEFT JOIN m USING (row) WHERE own),
r AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place FROM d)
SELECT doc_id, n_features, weight, score, n_words,
  CASE WHEN n_words >= 20 AND place <= 25 * (SELECT count(*) FROM d WHERE n_words >= 20) // 100 THEN place END::BIGINT AS rank
FROM r
""")
def resample_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resample.resample(documents(spark, sf_dir), benchmark).select(
        F.col("key").alias("doc_id"), "n_features", "weight", "score", "rank", "n_words")


@query("op12_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.classify(documents(spark, sf_dir), labels).withColumnRenamed("key", "doc_id")


@query("op13_ranked_search", r"""
WITH w AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS row, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tf AS MATERIALIZED (SELECT doc_id, row, term, count(*)::BIGINT AS tf FROM w GROUP BY ALL),
d AS (SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM d),
q AS MATERIALIZED (SELECT item_id, unnest(list_distinct(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
  FROM benchmark),
t AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
      FROM tf, c WHERE term IN (SELECT term FROM q) GROUP BY term, docs),
s AS (SELECT item_id, tf.doc_id, row,
        sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::BIGINT AS score
      FROM q JOIN t USING (term) JOIN tf USING (term) JOIN d USING (row), c GROUP BY item_id, tf.doc_id, row),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM s WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM r WHERE place <= 50
""")
def search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return search.rank(documents(spark, sf_dir), items).select(
        F.col("item").alias("item_id"), "rank", F.col("key").alias("doc_id"), "score")
