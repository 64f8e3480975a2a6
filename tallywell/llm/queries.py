"""The registered queries of this package: each operator over its whole table."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.llm.automaton_dedup import deduplicated_words
from tallywell.llm.bpe import BytePairCoder
from tallywell.llm.bwt_dedup import deduplicated_bytes
from tallywell.llm.chat import END, START, conversation_digests, format_conversations
from tallywell.llm.common import table
from tallywell.llm.decontaminate import find_overlaps
from tallywell.llm.hard_negatives import mined_negatives
from tallywell.llm.kneser_ney import judged
from tallywell.llm.secrets import BASE_RULES, find_secrets
from tallywell.llm.sharding import sharded
from tallywell.llm.simhash import near_duplicates
from tallywell.llm.spelling import counted_words, letter_runs, spelling_variants
from tallywell.llm.topk import top_k
from tallywell.llm.warc import resolve_revisits

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run):
    REGISTRY[run.__name__] = run
    return run


@query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    same = f"{END}{START}assistant ok"
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(same).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_digests(format_conversations(turns.unionByName(more)))


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return BytePairCoder.train(docs, public_tokenizers.path("byte_bpe_50k.json")).digests(docs)


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = [r.kind for r in BASE_RULES]
    found = find_secrets(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *map(number, kinds),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shortest=1)


@query
def op9_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op10_automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated_words(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the filter keeps."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return judged(docs, labels).filter("keep").drop("t")


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 97th run, by its hash, loses a letter, as misspelt words do."""
    runs = letter_runs(table(spark, sf_dir, "documents"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary"))
    gone = (h % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), gone), F.substring(F.col("run"), gone + 2, F.length("run")))
    return spelling_variants(counted_words(runs.select(F.when(h % 97 == 0, short).otherwise(F.col("run")).alias("word"))))


@query
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharded(table(spark, sf_dir, "documents"))
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return rows.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row is labelled wrongly first, as real labels are."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mined_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def captures(pages: DataFrame) -> DataFrame:
    """Web captures that the pages table stands for: each page captured, and again later without a change.

    Every row is a full response in its second and a revisit an hour and 40 seconds later. The page's hash is its etag; every
    seventh revisit has that of another version, every eleventh no validator, and every thirteenth page is an error.
    """
    seen = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id"))
    etag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    full = pages.select(
        (F.col("page_id") * 2).alias("record_id"),
        F.lit("response").alias("kind"),
        "url",
        seen.alias("captured"),
        F.when(F.col("page_id") % 13 == 5, 500).otherwise(200).cast("long").alias("status"),
        F.create_map(F.lit("etag"), etag, F.lit("date"), F.col("page_id").cast("string"), F.lit("content-type"), F.lit("text/html")).alias("headers"),
    )
    again = F.when(F.col("page_id") % 7 == 3, F.lit('"other"')).otherwise(etag)
    date = F.concat(F.lit("later "), F.col("page_id").cast("string"))
    headers = F.when(F.col("page_id") % 11 == 4, F.create_map(F.lit("date"), date)).otherwise(
        F.create_map(F.lit("etag"), again, F.lit("date"), date, F.lit("content-type"), F.lit("none"))
    )
    revisit = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"),
        F.lit("revisit").alias("kind"),
        "url",
        (seen + F.expr("INTERVAL 3640 SECONDS")).alias("captured"),
        F.lit(304).cast("long").alias("status"),
        headers.alias("headers"),
    )
    return full.unionByName(revisit)


@query
def op2_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(captures(table(spark, sf_dir, "pages")))
    return found.select(
        "record_id",
        "canonical",
        "response_id",
        "outcome",
        F.try_element_at("headers", F.lit("etag")).alias("etag"),
        F.try_element_at("headers", F.lit("date")).alias("date"),
        F.try_element_at("headers", F.lit("content-type")).alias("content_type"),
    )


ORACLES["op2_warc_revisit"] = r"""
WITH parts AS (
  SELECT page_id, md5(html) AS tag,
         regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^(?i:https?)://', '') AS plain
  FROM pages
), pieces AS (
  SELECT page_id, '"' || tag || '"' AS etag,
         regexp_replace(lower(regexp_extract(plain, '^([^/?]*)', 1)), '^www\.|:(80|443)$', '') AS host,
         regexp_replace(regexp_extract(plain, '^[^/?]*(/[^?]*)', 1), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(plain, '\?(.*)$', 1), '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS params
  FROM parts
), pages_ AS (
  SELECT page_id, etag, host || path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS canonical
  FROM pieces
), asked AS (
  SELECT page_id, canonical, page_id + 3640 AS seen,
         CASE WHEN page_id % 11 = 4 THEN NULL WHEN page_id % 7 = 3 THEN '"other"' ELSE etag END AS etag
  FROM pages_
), earlier AS (
  SELECT a.page_id, max(p.page_id) AS response FROM asked a JOIN pages_ p
    ON p.canonical = a.canonical AND p.page_id < a.seen AND p.page_id % 13 <> 5 GROUP BY a.page_id
), judged AS (
  SELECT a.page_id, a.canonical, e.response, a.etag AS own,
         CASE WHEN e.response IS NULL THEN 'missing' WHEN a.etag IS NULL THEN 'unchecked'
              WHEN a.etag <> p.etag THEN 'changed' ELSE 'resolved' END AS outcome
  FROM asked a LEFT JOIN earlier e USING (page_id) LEFT JOIN pages_ p ON p.page_id = e.response
)
SELECT page_id * 2 + 1 AS record_id, canonical, response * 2 AS response_id, outcome, own AS etag,
       'later ' || page_id AS date,
       CASE WHEN outcome = 'resolved' THEN 'text/html' WHEN own IS NULL THEN NULL ELSE 'none' END AS content_type
FROM judged
"""


ORACLES["op6_top_k"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
"""


ORACLES["op13_hard_negatives"] = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, c.vec_id, c.label,
         CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM whole a JOIN whole c ON c.vec_id <> a.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT anchor_id, positive_id,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id AS negative_id, positive_score, score AS negative_score
  FROM positives JOIN scored USING (anchor_id)
  WHERE label <> anchor_label AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT * FROM ranked WHERE rank <= 10
"""
