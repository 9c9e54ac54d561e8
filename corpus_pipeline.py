"""A cleaning pipeline over ``documents``: quality, near copies, benchmark leaks, secrets, packing.

Each stage takes what its predecessor kept and returns the columns of ``documents``; the
last one returns the pieces of the texts with their places in packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reconkit.llm import decontaminate, near_copies, packing, quality, secret_scan
from reconkit.llm.common import held_out, stored
from reconkit.llm.queries import table, tokenizer


# Of an Arrow batch, which a task holds on both sides of its Python worker.  Buffers of this
# size come from the allocator's pool; larger ones are malloced, and what is freed of them
# stays with the executor.
BATCH_BYTES = 1 << 20
READ_ROWS = 512  # that a Parquet reader decodes at once; texts of 4096 rows are arrays of many MB
GROUP_BYTES = 8 << 20  # of a Parquet row group, which a writer holds until it is full


def small_batches(spark: SparkSession) -> None:
    """Bound what the text stages hold at once, for this session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_ROWS))
    spark.conf.set("parquet.block.size", str(GROUP_BYTES))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the byte network, trained on the labels, scores below 0.7."""
    small_batches(spark)
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    return quality.accepted(docs, quality.fit(docs, labels, "quality"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of near copies (five words, similarity 0.8)."""
    small_batches(spark)
    return near_copies.deduplicated(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold at least 0.8 of the five-word shingles of a benchmark item.

    Documents are matched by a digest of their text, so ids may repeat or be null.
    """
    small_batches(spark)
    keyed = docs.withColumn("__key", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = decontaminate.contained_items(keyed, table(spark, sf_dir, "benchmark"), id_col="__key")
    leaked = stored(found.select(F.col("doc_id").alias("__key")).distinct(), "leaked")
    # broadcast where the number of keys allows it, so that no text is shuffled
    few = leaked.count() <= near_copies.BROADCAST_KEYS
    return keyed.join(F.broadcast(leaked) if few else leaked, "__key", "left_anti").select(docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts by a mark and set ``n_chars`` anew; every document stays."""
    small_batches(spark)
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens, best-fit packed into sequences."""
    small_batches(spark)
    cut = packing.pieces(docs, tokenizer("word_bpe_49k.json"), 1)
    return packing.place(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("quality classifier", good_quality),
    ("simhash near-dedup", without_near_copies),
    ("benchmark decontamination", without_leaks),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

# the classifier and the tokenizer are beyond SQL; tests/llm holds a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
