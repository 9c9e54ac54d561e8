"""Registered queries of the text operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reconkit.llm import (
    decontaminate, hard_negatives, importance, licenses, neighbours, packing, quality, secret_scan, simhash, token_counts, token_output, toxicity, warc,
)
from reconkit.llm.common import held_out
from reconkit.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def checked(sql: str):
    """Register a query with its SQL."""

    def add(fn):
        ORACLE[fn.__name__] = sql
        return query(fn)

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op1_hash_prefix_forest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return neighbours.search(vectors, vectors.filter("vec_id % 20 = 0"))


@query
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    cut = packing.pieces(table(spark, folder, "documents"), tokenizer("word_bpe_49k.json"), 1)
    return packing.place(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@query
def op7_token_file(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-file")
    found = token_output.token_round_trip(table(spark, folder, "documents"), path, tokenizer("byte_bpe_50k.json"))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    network = quality.fit(docs, labels.filter(~held_out(F.col("doc_id"))), "quality")
    return quality.score(docs, network).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.expr("cast(score >= 0.7 as int)").alias("predicted")
    )


# fixed values: English insults by kind, weak labels of the first two links
ABOUT_PEOPLE = ("idiot", "moron", "loser", "clown", "scum")
ABOUT_WORTH = ("worthless", "pathetic", "disgusting", "stupid", "trash")
TOXIC_FROM = 0.15  # probability from which a text is called toxic


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Chain "people" -> "worth" -> "toxic"; the first two are weak labels, the last is ``labels.toxic``."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    kinds = {"people": ABOUT_PEOPLE, "worth": ABOUT_WORTH}
    weak = {c: F.lower("text").rlike(rf"\b({'|'.join(w)})\b") for c, w in kinds.items()}
    chain = toxicity.fit(docs, labels.filter(~held_out(F.col("doc_id"))), ["people", "worth", "toxic"], weak)
    found = toxicity.score(docs, chain)
    return found.select("*", F.expr(f"cast(p_toxic >= {TOXIC_FROM} as int)").alias("toxic"))


@query
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


@query
def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"))
    joined = {c: F.concat_ws(",", c) for c in ("base_labels", "labels")}
    return found.withColumns(joined).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query
def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, folder, "documents"))
    base = F.filter("found", lambda x: x["kind"] != "random")
    counts = [F.size(F.expr(f"filter(found, x -> x.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in secret_scan.KINDS[:3]]
    return found.select(
        "doc_id", *counts, F.sha2(secret_scan.digest(base), 256).alias("base_sha256"), secret_scan.digest(F.col("found")).alias("spans")
    )


@checked("""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS last FROM p WHERE strlen(html) >= 1000 GROUP BY html)
SELECT page_id, strlen(p.html)::BIGINT AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN last <> page_id THEN last END AS refers_to
FROM p LEFT JOIN g ON p.html = g.html""")
def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.round_trip(table(spark, folder, "pages"), scratch_path(spark, "warc"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@checked("""
WITH RECURSIVE crc(i, step, c) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i) UNION ALL
  SELECT i, step + 1, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) FROM crc WHERE step < 8),
byte_table AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE step = 8),
w AS (
  SELECT 'd' AS side, doc_id AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM documents UNION ALL
  SELECT 'b', item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) FROM benchmark),
words AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM w),
bytes AS (SELECT word, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b FROM words),
hashed AS (
  SELECT word, xor(list_reduce(b, lambda a, x: xor(a >> 8, t[xor(a, x) % 256 + 1]), 4294967295::BIGINT), 4294967295::BIGINT) % 10000 AS bucket
  FROM bytes, byte_table),
f AS (SELECT side, id, bucket, count(*) AS n FROM w JOIN hashed USING (word) GROUP BY ALL),
totals AS (SELECT sum(n) FILTER (side = 'd') AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t FROM f),
each AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t FROM f GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((each.t + 1)::DOUBLE * (totals.s + 10000)::DOUBLE) / ((each.s + 1)::DOUBLE * (totals.t + 10000)::DOUBLE)))::BIGINT AS gain
  FROM each, totals),
weights AS (SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM f JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
noise AS (SELECT doc_id, (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296 AS u FROM documents),
scored AS (
  SELECT noise.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln(u))))::BIGINT AS score
  FROM noise LEFT JOIN weights ON noise.doc_id = weights.id),
pool AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20)
SELECT scored.doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN pool USING (doc_id)""")
def op12_importance(spark: SparkSession, folder: str) -> DataFrame:
    found = importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@checked("""
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.id % 50 = 0 AND a.id <> b.id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM positives JOIN pairs USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3""")
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end")
    return hard_negatives.mine(table(spark, folder, "embeddings"), F.col("id") % 50 == 0, label)
