"""From raw documents to token ids: quality, near duplicates, benchmark overlaps, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. Its result is written to the
folder that executors share and read again, so a stage can be repeated without those before it.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.llm.bpe import BytePairCoder
from tallywell.llm.common import keep, reach_workers, table
from tallywell.llm.decontaminate import without_overlaps
from tallywell.llm.kneser_ney import judged
from tallywell.llm.secrets import redact_secrets
from tallywell.llm.simhash import representatives

#: Benchmark items of fewer tokens are phrases that ordinary text holds too; they remove nothing.
SHORTEST_ITEM = 4

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's threshold; identical texts of a document share a verdict."""
    kept = judged(docs, table(spark, sf_dir, "labels")).filter("keep")
    kept = kept.select(F.col("doc_id").alias("id"), F.col("t"), F.col("lang").alias("l")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("id"))
    same &= F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("t")
    same &= F.coalesce("lang", F.lit("")) == F.col("l")
    return docs.select(*COLUMNS).join(kept, same, "left_semi")


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id.

    Where that doc_id has several texts in the group, the one with the smallest hash stays; different texts under one doc_id
    that are in different groups stay all. Documents without doc_id stay only if all of their group are, and then one of
    them.
    """
    reach_workers(spark)
    found = representatives(docs).withColumnRenamed("doc_id", "id")
    t = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("id")) & (t == F.col("t"))
    first = docs.select(*COLUMNS).join(found, same, "left_semi")
    # Rows of one doc_id and text are in one group; of them one stays.
    rows = first.groupBy("doc_id", t.alias("t")).agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("row"))
    return rows.select("doc_id", "row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark; short items, of SHORTEST_ITEM tokens or more, count where all of them stand."""
    reach_workers(spark)
    return without_overlaps(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"), shortest=SHORTEST_ITEM)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret, and n_chars of the new text."""
    reach_workers(spark)
    return redact_secrets(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids."""
    reach_workers(spark)
    return BytePairCoder.train(docs, public_tokenizers.path("byte_bpe_50k.json")).encode(docs)


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", distinct_documents),
    ("benchmark decontamination", decontaminated),
    ("secret scans", redacted),
    ("bpe encoding and decoding", tokens),
]

#: SQL cannot express the model of the first stage, the fingerprints or the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
