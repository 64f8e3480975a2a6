"""Every registered query: (spark, sf_dir) -> DataFrame over the whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywell.operators.ingest import chronological, envelope, inject_faults, join_payments
from tallywell.operators.keyed import latest_per_key, upsert
from tallywell.operators.purge import anomalies, without_anomalies, without_blank_days
from tallywell.operators.quality import CONTRACTS, alert_messages, contract_results, expectation_results
from tallywell.operators.remediate import EMPTY_STATUS_RULE, repair_column
from tallywell.operators.report import BREAKDOWNS, breakdown, inspect_layers, layer_sample, top_rows
from tallywell.operators.review import ReviewOutcome, apply_decisions, pending_queue
from tallywell.operators.validate import Policy, clean_rows, classify, quarantined_rows, violations
from tallywell.plans.gold import (
    customer_activity,
    daily_revenue,
    daily_revenue_merged,
    one_row_per_key,
    published_files,
    create_views,
    refresh_customer_activity,
    refresh_daily_revenue,
    register_views,
)
from tallywell.plans.governance import find_review, open_reviews, purge_job, review_job
from tallywell.plans.ingest import order_events
from tallywell.schemas import DAILY_REVENUE_SCHEMA, EVENT_FIELDS, EVENT_SCHEMA, IDENTITY_FIELDS, ORIGIN_FIELDS, SILVER_SCHEMA
from tallywell.sinks import Layers, append_batch, create_layers, upsert_table
from tallywell.sinks.publish import batch_file_writer, publish_stream
from tallywell.sinks.workspace import shared_folder
from tallywell.sources import (
    current_table,
    decode_events,
    encode_events,
    file_stream,
    read_csv_text,
    read_raw_orders,
    read_raw_payments,
    rows_or_empty,
    split_structural,
)
from tallywell.sources.codec import CORRUPT
from tallywell.streaming import start_pipeline
from tallywell.streaming.dedup import without_redeliveries
from tallywell.streaming.pipeline import append_pending, merged_pending, pending_from, silver_from
from workload.events import FIRST_MS, as_events, raw_events, raw_orders, raw_payments, republished_events, table

#: Bytes of a row group in a file that is a batch of its own.
ROW_GROUP = 4 << 20

CONTRACT_TABLES = {c.table for c in CONTRACTS}

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


def _classified(spark: SparkSession, sf_dir: str, delivery: int | None = None) -> DataFrame:
    return classify(raw_events(spark, sf_dir, delivery))


def _silver(spark: SparkSession, sf_dir: str, delivery: int | None = None) -> DataFrame:
    return silver_from(_classified(spark, sf_dir, delivery))


def _pending(spark: SparkSession, sf_dir: str, delivery: int | None = None) -> DataFrame:
    return pending_from(_classified(spark, sf_dir, delivery))


def _shown(pending: DataFrame) -> DataFrame:
    """Without the origin, which only unreadable payloads have, and the hashes that tell rows apart."""
    return pending.drop(*ORIGIN_FIELDS, *IDENTITY_FIELDS)


# Scan, decode, ingest


@query
def csv_roundtrip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "csv")
    writer = raw_events(spark, sf_dir).write.option("header", True)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)
    return read_csv_text(spark, path, EVENT_FIELDS)


@query
def decode_events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode, spoil the payload of every third order, decode."""
    events = raw_events(spark, sf_dir)
    payload = encode_events(events).select(F.col("value").cast("string").alias("text"))
    spoiled = F.when(F.crc32(F.col("text").cast("binary")) % 3 == 0, F.concat(F.lit("{broken"), "text"))
    whole = payload.select(F.coalesce(spoiled, F.col("text")).cast("binary").alias("value"))
    decoded = decode_events(whole, keep_corrupt=True)
    # What was spoiled is read back from the kept payload, so every row can be checked.
    restored = decode_events(decoded.select(F.substring(CORRUPT, 8, 2**30).alias("value")))
    return decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT).unionByName(
        restored.filter(F.col("ingest_id").isNotNull())
    )


@query
def structural_split_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_structural(raw_events(spark, sf_dir))[0]


@query
def structural_dlq_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    dead = split_structural(raw_events(spark, sf_dir))[1]
    fields = F.from_json("payload", EVENT_SCHEMA)
    return dead.select(fields.alias("event"), "error").select("event.*", "error")


@query
def orders_payments_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_payments(raw_orders(spark, sf_dir), raw_payments(spark, sf_dir))


@query
def chronological_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the place of each row: its place in its partition, after the rows of those before. Deliveries of one order at
    one time get the first of their places."""
    ordered = chronological(raw_events(spark, sf_dir)).withColumn("__id", F.monotonically_increasing_id())
    kept = shared_folder(spark, "ordered")
    ordered.write.parquet(kept)
    rows = spark.read.parquet(kept).withColumn("__part", F.shiftright("__id", 33))
    # One row for each partition.
    sizes = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("start"))
    place = F.col("start") + F.col("__id").bitwiseAND((1 << 33) - 1) + 1
    placed = rows.join(F.broadcast(starts), "__part").select(*EVENT_FIELDS, place.alias("place"))
    same = Window.partitionBy("order_purchase_timestamp", "order_id")
    return placed.withColumn("place", F.min("place").over(same))


@query
def event_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timestamp text stands in for the delivery time; the amount is absent."""
    rows = raw_events(spark, sf_dir).drop("ingest_id", "payment_value")
    at = F.unix_millis(F.concat("order_purchase_timestamp", F.lit("Z")).try_cast("timestamp"))
    identity = [F.col("order_id"), F.col("customer_id"), F.col("order_purchase_timestamp")]
    return envelope(rows, F.coalesce(at, F.lit(0)), identity)


@query
def published_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and payments to events, as the publishing job sends them."""
    return order_events(raw_orders(spark, sf_dir), raw_payments(spark, sf_dir), delivered_at=F.lit(FIRST_MS))


@query
def redelivery_newest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders are published twice; within a batch the later delivery counts."""
    early, late = republished_events(spark, sf_dir)
    silver = silver_from(classify(late.unionByName(early)))
    return silver.select("order_id", "order_status", "payment_value")


@query
def upsert_last_batch_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older delivery arrives in a later batch: by default the last batch counts."""
    early, late = (silver_from(classify(e)) for e in republished_events(spark, sf_dir))
    return upsert(late, early, ["order_id"]).select("order_id", "order_status", "payment_value")


@query
def fault_injection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inject_faults(raw_events(spark, sf_dir), 0.10, 0.20, seed=42)


# Validation, routing, repair, newest delivery


@query
def validation_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).drop("route")


@query
def validation_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = Policy(strict_amount=True)
    names = F.array_join(violations(policy), ",")
    return raw_events(spark, sf_dir).select("ingest_id", names.alias("violations"))


@query
def route_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_rows(_classified(spark, sf_dir))


@query
def route_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantined_rows(_classified(spark, sf_dir))


@query
def route_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All opt-in departures at once."""
    policy = Policy(strict_amount=True, blank_is_empty=True, route_on="all")
    return classify(raw_events(spark, sf_dir), policy).select("ingest_id", "validation_status", "route")


@query
def remediate_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_column(clean_rows(_classified(spark, sf_dir)), "order_status", EMPTY_STATUS_RULE)


@query
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(raw_events(spark, sf_dir), ["order_id"], ["ingest_id"])


# Row-level writes as DataFrames


@query
def upsert_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(_silver(spark, sf_dir, 1), _silver(spark, sf_dir, 2), ["order_id"])


@query
def upsert_silver_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older delivery arrives last and must not win."""
    return upsert(_silver(spark, sf_dir, 2), _silver(spark, sf_dir, 1), ["order_id"], newer_by="ingest_id")


@query
def upsert_silver_protected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repaired rows stand for reviewed ones and stay as they are."""
    return upsert(
        _silver(spark, sf_dir, 1), _silver(spark, sf_dir, 2), ["order_id"], protect="_is_remediated"
    )


@query
def upsert_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load repeats all of the first: nothing is inserted twice."""
    return _shown(merged_pending(_pending(spark, sf_dir, 1), _pending(spark, sf_dir)))


@query
def upsert_pending_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews of the first load are closed; loading all again opens only what was not there."""
    closed = _pending(spark, sf_dir, 1).withColumn("_status", F.lit("REJECTED"))
    return _shown(merged_pending(closed, _pending(spark, sf_dir)))


@query
def quarantine_same_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All deliveries lose their ids: rows that differ in anything else stay apart."""
    lost = raw_events(spark, sf_dir).withColumns({"ingest_id": F.lit("9"), "order_id": F.lit("")})
    pending = pending_from(classify(lost))
    return merged_pending(pending, pending).select(*EVENT_FIELDS)


# Gold


@query
def daily_revenue_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_revenue(_silver(spark, sf_dir), order_ids_unique=True)


@query
def daily_revenue_all_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over rows not reduced to one per order, so the distinct count matters."""
    return daily_revenue(route_clean(spark, sf_dir))


@query
def daily_revenue_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First run on everything before 2000; second on all rows, late ones and changed ones included."""
    silver = _silver(spark, sf_dir)
    first = daily_revenue(_silver(spark, sf_dir, 1).filter("created_date < DATE'2000-01-01'"))
    return daily_revenue_merged(silver, first)


@query
def daily_revenue_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _silver(spark, sf_dir)
    first = daily_revenue(_silver(spark, sf_dir, 1).filter("created_date < DATE'2000-01-01'"))
    return daily_revenue_merged(silver, first, lookback_days=365)


@query
def customer_activity_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_activity(_silver(spark, sf_dir))


@query
def dedup_view_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of the table, as their Parquet files lie side by side."""
    folder = shared_folder(spark, "published")
    for delivery in (1, None):
        daily = daily_revenue(_silver(spark, sf_dir, delivery))
        daily.write.mode("append").parquet(f"{folder}/data/snapshot={delivery or 2}")
    return one_row_per_key(published_files(spark, folder), "revenue_date")


@query
def dedup_view_customer_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = customer_activity(_silver(spark, sf_dir, 1))
    new = customer_activity(_silver(spark, sf_dir))
    return one_row_per_key(old.unionByName(new), "customer_id")


@query
def gold_delete_blank_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per customer and day kept as text, where some days are NULL and some blank."""
    day = F.when(F.col("created_date").isNotNull(), F.col("created_date").cast("string")).when(
        F.col("validation_status") == "VALID", F.lit("  ")
    )
    daily = (
        _classified(spark, sf_dir)
        .groupBy("customer_id", day.alias("revenue_date"))
        .agg(F.count(F.lit(1)).alias("total_orders"))
    )
    return without_blank_days(daily)


# Governance


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decision on every delivery, open or not, and a second, earlier one on half of them."""
    number = F.col("ingest_id").cast("bigint")
    word = F.element_at(
        F.array(*[F.lit(w) for w in ("Y", " n ", "S", "approved", "maybe")]), (number % 5 + 1).cast("int")
    )
    corrected = F.when(number % 4 == 0, F.lit("oops")).otherwise(F.concat((number % 1000).cast("string"), F.lit(".50")))
    late = raw_events(spark, sf_dir).select(
        "order_id",
        "ingest_id",
        word.alias("decision"),
        corrected.alias("corrected_value"),
        F.lit("second auditor").alias("reviewed_by"),
        F.lit("2024-05-02T10:00:00").alias("reviewed_at"),
    )
    early = late.filter("CAST(ingest_id AS BIGINT) % 2 = 0").withColumns(
        {
            "decision": F.lit("N"),
            "reviewed_by": F.lit("first auditor"),
            "reviewed_at": F.lit("2024-05-01T10:00:00"),
        }
    )
    return late.unionByName(early)


def _review(spark: SparkSession, sf_dir: str) -> ReviewOutcome:
    return apply_decisions(_pending(spark, sf_dir), decisions(spark, sf_dir))


@query
def pending_queue_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(pending_queue(_review(spark, sf_dir).pending))


@query
def review_silver_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _review(spark, sf_dir).silver_updates


@query
def review_pending_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_review(spark, sf_dir).pending)


@query
def review_audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _review(spark, sf_dir).audit


@query
def review_bad_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _review(spark, sf_dir).bad_decisions.drop("row_key")


def _legacy_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean table as loaded before there were rules: every row, whatever its route."""
    rows = repair_column(_classified(spark, sf_dir), "order_status", EMPTY_STATUS_RULE)
    return rows.select(*SILVER_SCHEMA.fieldNames())


@query
def purge_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_anomalies(_legacy_silver(spark, sf_dir))


@query
def purge_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(anomalies(_legacy_silver(spark, sf_dir)))


# Quality and inspection


def _contract_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    silver = _legacy_silver(spark, sf_dir)
    return {
        "silver_transactions": silver,
        "daily_revenue": daily_revenue(silver),
        "customer_activity": customer_activity(silver),
    }


@query
def contract_failures_per_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_results(_contract_frames(spark, sf_dir))


@query
def expectation_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expectation_results(_legacy_silver(spark, sf_dir))


@query
def expectation_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_messages(expectation_results(_legacy_silver(spark, sf_dir)))


@query
def inspect_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _silver(spark, sf_dir)
    outcome = _review(spark, sf_dir)
    return inspect_layers(
        spark,
        {
            "bronze_transactions": raw_events(spark, sf_dir),
            "silver_transactions": silver,
            "silver_pending_review": outcome.pending,
            "audit_log": outcome.audit,
            "daily_revenue": daily_revenue(silver, order_ids_unique=True),
            "customer_activity": None,
        },
    )


@query
def inspect_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = BREAKDOWNS["silver_transactions"]
    return breakdown(_silver(spark, sf_dir), columns)


@query
def top_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_rows(daily_revenue_model(spark, sf_dir), "revenue_date", 3)


@query
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_rows(customer_activity_model(spark, sf_dir), "total_spent", 3)


# Tables and streams


def _fresh_layers(spark: SparkSession) -> Layers:
    location = shared_folder(spark, "lakehouse")
    return create_layers(spark, Layers(prefix=f"q{location[-12:]}_"), location=location)


@query
def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the second delivered twice."""
    layers = _fresh_layers(spark)
    append_batch(raw_events(spark, sf_dir, 1), layers.bronze, "orders", 0)
    for _ in range(2):
        append_batch(raw_events(spark, sf_dir, 2), layers.bronze, "orders", 1)
    return current_table(spark, layers.bronze).drop("ingested_at", "stream_id", "arrived_on", *ORIGIN_FIELDS)


@query
def table_upsert_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge on stored tables; some orders move to another day's partition."""
    layers = _fresh_layers(spark)
    upsert_table(_silver(spark, sf_dir, 1), layers.silver, ["order_id"])
    upsert_table(_silver(spark, sf_dir, 2), layers.silver, ["order_id"])
    return current_table(spark, layers.silver)


@query
def table_review_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _reviewed_layers(spark, sf_dir)
    return current_table(spark, layers.silver)


@query
def table_review_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _reviewed_layers(spark, sf_dir)
    return _shown(current_table(spark, layers.pending))


@query
def table_review_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_table(spark, _reviewed_layers(spark, sf_dir).audit)


@query
def table_review_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job stops after its first write and is repeated, and nothing is doubled."""
    layers = _fresh_layers(spark)
    upsert_table(_silver(spark, sf_dir), layers.silver, ["order_id"])
    append_pending(_pending(spark, sf_dir), layers)
    upsert_table(_review(spark, sf_dir).silver_updates, layers.silver, ["order_id"])
    for _ in range(2):
        review_job(spark, layers, decisions(spark, sf_dir))
    return current_table(spark, layers.silver)


def _reviewed_layers(spark: SparkSession, sf_dir: str) -> Layers:
    layers = _fresh_layers(spark)
    upsert_table(_silver(spark, sf_dir), layers.silver, ["order_id"])
    append_pending(_pending(spark, sf_dir), layers)
    review_job(spark, layers, decisions(spark, sf_dir))
    return layers


@query
def table_purge_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _fresh_layers(spark)
    upsert_table(_legacy_silver(spark, sf_dir), layers.silver, ["ingest_id"])
    purge_job(spark, layers)
    return current_table(spark, layers.silver)


@query
def table_purge_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the purged rows go; the job is repeated."""
    layers = _fresh_layers(spark)
    upsert_table(_legacy_silver(spark, sf_dir), layers.silver, ["ingest_id"])
    purge_job(spark, layers)
    purge_job(spark, layers)
    return _shown(current_table(spark, layers.pending))


@query
def table_activity_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer activity is built anew on each refresh."""
    layers = _fresh_layers(spark)
    for delivery in (1, None):
        upsert_table(_silver(spark, sf_dir, delivery), layers.silver, ["order_id"])
        refresh_customer_activity(spark, layers)
    return current_table(spark, layers.customer_activity)


@query
def table_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue of the first deliveries, then all of silver, built anew."""
    layers = _fresh_layers(spark)
    upsert_table(_silver(spark, sf_dir, 1), layers.silver, ["order_id"])
    refresh_daily_revenue(spark, layers)
    upsert_table(_silver(spark, sf_dir), layers.silver, ["order_id"])
    refresh_daily_revenue(spark, layers, full_refresh=True)
    return current_table(spark, layers.daily_revenue)


@query
def stored_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reporting view of revenue, read by name from the catalog."""
    layers = _fresh_layers(spark)
    upsert_table(_silver(spark, sf_dir), layers.silver, ["order_id"])
    refresh_daily_revenue(spark, layers)
    refresh_customer_activity(spark, layers)
    create_views(spark, layers)
    return spark.table(f"{layers.schema('gold_finance')}.v_daily_revenue")


@query
def contracts_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contracts over the stored tables."""
    layers = _fresh_layers(spark)
    upsert_table(_silver(spark, sf_dir), layers.silver, ["order_id"])
    refresh_daily_revenue(spark, layers)
    refresh_customer_activity(spark, layers)
    return contract_results({k: v for k, v in layers.frames(spark).items() if v is not None and k in CONTRACT_TABLES})


@query
def csv_orders_payments_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and payments as the CSV files that the publishing job reads."""
    folder = shared_folder(spark, "raw")
    for name, rows in (("orders", raw_orders(spark, sf_dir)), ("payments", raw_payments(spark, sf_dir))):
        rows.write.option("header", True).csv(f"{folder}/{name}")
    return join_payments(read_raw_orders(spark, f"{folder}/orders"), read_raw_payments(spark, f"{folder}/payments"))


@query
def table_gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full build, more silver rows, then the incremental merge of stored gold."""
    layers = _fresh_layers(spark)
    upsert_table(_silver(spark, sf_dir, 1).filter("created_date < DATE'2000-01-01'"), layers.silver, ["order_id"])
    refresh_daily_revenue(spark, layers)
    upsert_table(_silver(spark, sf_dir), layers.silver, ["order_id"])
    refresh_daily_revenue(spark, layers, lookback_days=0)
    refresh_customer_activity(spark, layers)
    return current_table(spark, layers.daily_revenue)


def _append_file(rows: DataFrame, folder: str) -> None:
    """Add ``rows`` as one file. Tasks make them side by side, one of them writes; the file is in row groups small enough that many
    tasks share its reading."""
    rows.repartition(1).write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(folder)


@query
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First deliveries are streamed, then the second ones after a restart from the checkpoint."""
    layers = _fresh_layers(spark)
    inbox, checkpoint = shared_folder(spark, "inbox"), shared_folder(spark, "offsets")
    for delivery in (1, 2):
        raw_events(spark, sf_dir, delivery).write.mode("append").parquet(inbox)
        start_pipeline(file_stream(spark, inbox), layers, checkpoint, trigger=None).awaitTermination()
    return current_table(spark, layers.silver)


def _streamed_from_table(spark: SparkSession, sf_dir: str) -> Layers:
    """Straight from the given table's file, as one micro-batch."""
    layers = _fresh_layers(spark)
    schema = table(spark, sf_dir, "orders").schema
    events = as_events(file_stream(spark, sf_dir, schema, glob="orders.parquet"))
    start_pipeline(events, layers, shared_folder(spark, "offsets"), trigger=None).awaitTermination()
    return layers


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(current_table(spark, _streamed_from_table(spark, sf_dir).pending))


@query
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = current_table(spark, _streamed_from_table(spark, sf_dir).bronze)
    return bronze.drop("ingested_at", "stream_id", "arrived_on", *ORIGIN_FIELDS)


@query
def stream_rate_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file a batch, and one file without rows, whose batch writes nothing: each delivery with its batch's size."""
    layers, inbox = _fresh_layers(spark), shared_folder(spark, "inbox")
    for delivery in (1, 2):
        _append_file(raw_events(spark, sf_dir, delivery), inbox)
    raw_events(spark, sf_dir, 1).filter("false").coalesce(1).write.mode("append").parquet(inbox)
    stream = file_stream(spark, inbox, max_files_per_trigger=1)
    start_pipeline(stream, layers, shared_folder(spark, "offsets"), trigger=None).awaitTermination()
    bronze = current_table(spark, layers.bronze)
    sizes = bronze.groupBy("batch_id").agg(F.count(F.lit(1)).alias("in_batch"))
    return bronze.join(sizes, "batch_id").select("ingest_id", "in_batch")


@query
def stream_corrupt_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third payload is spoiled, alike for all; two batches, then all of it again. What bronze and quarantine keep
    of each spoiled payload, read back."""
    layers, inbox, checkpoint = _fresh_layers(spark), shared_folder(spark, "inbox"), shared_folder(spark, "offsets")

    def stream(offsets: str) -> None:
        raw = file_stream(spark, inbox, "value binary", position=True)
        start_pipeline(decode_events(raw, origin=True), layers, offsets, trigger=None).awaitTermination()

    spoil = F.col("ingest_id").cast("bigint") % 3 == 0
    for delivery in (1, 2):
        events = raw_events(spark, sf_dir, delivery)
        broken = encode_events(events.filter(spoil)).select(F.concat(F.lit("{broken").cast("binary"), "value").alias("value"))
        broken.unionByName(encode_events(events.filter(~spoil))).write.mode("append").parquet(inbox)
        # The same garbage twice: nothing but its place tells one from the other.
        spark.range(2).select(F.lit("garbage").cast("binary").alias("value")).coalesce(1).write.mode("append").parquet(inbox)
        stream(checkpoint)
    first = current_table(spark, layers.bronze).select("stream_id").distinct().first()[0]
    stream(shared_folder(spark, "offsets"))

    def read(layer: str, rows: DataFrame) -> DataFrame:
        payload = rows.filter("payload IS NOT NULL").select(F.regexp_replace("payload", r"^\{broken", "").alias("value"))
        return decode_events(payload).withColumn("layer", F.lit(layer))

    bronze = current_table(spark, layers.bronze).filter(F.col("stream_id") == first)
    return read("bronze", bronze).unionByName(read("quarantine", current_table(spark, layers.pending)))


@query
def stream_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expectations on each of two micro-batches, counted while silver is written."""
    layers, inbox, found = _fresh_layers(spark), shared_folder(spark, "inbox"), []
    for delivery in (1, 2):
        _append_file(raw_events(spark, sf_dir, delivery), inbox)

    def heard(results: DataFrame) -> None:
        found.append([(len(found), *r) for r in results.collect()])

    stream = file_stream(spark, inbox, max_files_per_trigger=1)
    start_pipeline(stream, layers, shared_folder(spark, "offsets"), trigger=None, on_results=heard).awaitTermination()
    columns = "batch int, check string, column string, failed bigint, total bigint, success boolean"
    return spark.createDataFrame([row for batch in found for row in batch], columns)


@query
def stream_structural_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two micro-batches are published; every event with where it went, dead letters with the number their batch's alert
    named."""
    inbox, out, alerts = shared_folder(spark, "inbox"), shared_folder(spark, "published"), []
    for delivery in (1, 2):
        _append_file(raw_events(spark, sf_dir, delivery), inbox)
    stream = file_stream(spark, inbox, max_files_per_trigger=1)
    main, dead = batch_file_writer(f"{out}/main"), batch_file_writer(f"{out}/dead")
    publish_stream(stream, main, dead, shared_folder(spark, "offsets"), on_dead=alerts.append).awaitTermination()
    sound = decode_events(spark.read.parquet(f"{out}/main")).select(
        *EVENT_FIELDS, F.lit(None).cast("string").alias("error"), F.lit(None).cast("bigint").alias("alert")
    )
    letters = spark.read.parquet(f"{out}/dead")
    batches = [r["batch"] for r in letters.select("batch").distinct().orderBy("batch").collect()]
    heard = spark.createDataFrame(list(zip(batches, alerts, strict=True)), "batch int, alert bigint")
    event = F.from_json(F.col("value").cast("string"), EVENT_SCHEMA).alias("event")
    dead = letters.select(event, "error", "batch").join(heard, "batch").select("event.*", "error", "alert")
    return sound.unionByName(dead)


@query
def stream_watermark_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders published twice, the first time again after a restart: each delivery passes once, and reaches silver."""
    layers, inbox, checkpoint = _fresh_layers(spark), shared_folder(spark, "inbox"), shared_folder(spark, "offsets")
    early, late = republished_events(spark, sf_dir, shared_folder(spark, "priced"))
    for publish in (lambda: early, lambda: late, lambda: spark.read.schema(early.schema).parquet(inbox)):
        # Both publishes again are what the inbox holds by then.
        publish().write.mode("append").parquet(inbox)
        once = without_redeliveries(file_stream(spark, inbox))
        start_pipeline(once, layers, checkpoint, trigger=None).awaitTermination()
    bronze = current_table(spark, layers.bronze)
    return bronze.select("order_id", "order_status", "payment_value")


@query
def gold_touched_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late deliveries, reviews and a purge change old days of silver; each refresh computes those anew, as a full one would."""
    layers = _fresh_layers(spark)
    upsert_table(_silver(spark, sf_dir, 1), layers.silver, ["order_id"])
    refresh_daily_revenue(spark, layers)
    upsert_table(_silver(spark, sf_dir), layers.silver, ["order_id"])
    no_customer = _legacy_silver(spark, sf_dir).filter("coalesce(customer_id, '') = '' AND order_id <> ''")
    upsert_table(latest_per_key(no_customer, ["order_id"], ["ingest_id"]), layers.silver, ["order_id"])
    refresh_daily_revenue(spark, layers)
    append_pending(_pending(spark, sf_dir), layers)
    review_job(spark, layers, decisions(spark, sf_dir))
    purge_job(spark, layers)
    refresh_daily_revenue(spark, layers)
    return current_table(spark, layers.daily_revenue)


@query
def table_review_same_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined rows lose what tells them apart by id, and half of the payloads are not readable; each is decided alone, by
    its row key. The queue after it, the orders that reached silver, and the decisions that could not be applied."""
    layers = _fresh_layers(spark)
    events = raw_events(spark, sf_dir).withColumn("ingest_id", F.lit("9"))
    by_customer = F.concat(F.lit("c"), F.pmod(F.coalesce(F.col("customer_id").try_cast("bigint"), F.lit(0)), F.lit(10)).cast("string"))
    shared = events.withColumn("order_id", F.when(F.col("order_id") != "", by_customer).otherwise(F.col("order_id")))
    append_pending(pending_from(classify(shared)), layers)
    lost = encode_events(raw_events(spark, sf_dir, 2)).select(F.concat(F.lit("{broken").cast("binary"), "value").alias("value"))
    append_pending(pending_from(classify(decode_events(lost, origin=True))), layers)
    queue = open_reviews(spark, layers)
    number = F.length(F.coalesce("payload", F.concat_ws("|", "order_purchase_timestamp", "payment_value", "customer_id")))
    word = F.element_at(F.array(F.lit("Y"), F.lit("N"), F.lit("S")), (number % 3 + 1).cast("int"))
    decided = queue.select(
        "order_id",
        "ingest_id",
        word.alias("decision"),
        F.lit("12.50").alias("corrected_value"),
        F.lit("auditor").alias("reviewed_by"),
        F.lit("2024-05-01T10:00:00").alias("reviewed_at"),
        "row_key",
    )
    bad = review_job(spark, layers, decided)
    pending = current_table(spark, layers.pending)
    none = F.lit(None).cast("string")
    payload = F.regexp_replace("payload", r"^\{broken", "")
    read = pending.filter("payload IS NOT NULL").select(payload.alias("value"), "_status")
    text = F.from_json("value", EVENT_SCHEMA)
    return (
        pending.filter("payload IS NULL")
        .select(F.lit("row").alias("what"), "order_id", "customer_id", "payment_value", "_status")
        .unionByName(
            read.select(
                F.lit("payload").alias("what"),
                text["order_id"].alias("order_id"),
                text["customer_id"].alias("customer_id"),
                text["payment_value"].alias("payment_value"),
                "_status",
            )
        )
        .unionByName(
            current_table(spark, layers.silver).select(
                F.lit("silver").alias("what"), "order_id", none.alias("customer_id"), "payment_value", none.alias("_status")
            )
        )
        .unionByName(
            bad.select(
                F.lit("bad").alias("what"), "order_id", none.alias("customer_id"), none.alias("payment_value"), F.col("reason").alias("_status")
            )
        )
    )


@query
def review_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review, looked up in the stored queue by two ids that are bound as parameters."""
    layers = _fresh_layers(spark)
    append_pending(_pending(spark, sf_dir), layers)
    first = open_reviews(spark, layers).filter("order_id <> ''").agg(F.min(F.struct("order_id", "ingest_id")).alias("ids")).first().ids
    return _shown(find_review(spark, layers, first.order_id, first.ingest_id))


@query
def temporary_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both reporting views of a session, joined by SQL over their names."""
    silver = _silver(spark, sf_dir)
    register_views(spark, daily_revenue(silver, order_ids_unique=True), customer_activity(silver))
    return spark.sql(
        "SELECT customer_id, last_purchase_date, total_spent, gross_revenue FROM v_customer_activity "
        "LEFT JOIN v_daily_revenue ON last_purchase_date = revenue_date"
    )


@query
def first_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue read before its table exists, as no rows of its schema, and after the first refresh."""
    layers = _fresh_layers(spark)
    before = rows_or_empty(spark, layers.daily_revenue, DAILY_REVENUE_SCHEMA).withColumn("read", F.lit("before"))
    upsert_table(_silver(spark, sf_dir), layers.silver, ["order_id"])
    refresh_daily_revenue(spark, layers)
    after = rows_or_empty(spark, layers.daily_revenue, DAILY_REVENUE_SCHEMA).withColumn("read", F.lit("after"))
    return before.unionByName(after)


@query
def layer_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rows of each layer in the columns its report shows. Any three will do, so they are told by their number, and how
    many of them the layer holds."""
    layers = _fresh_layers(spark)
    append_batch(raw_events(spark, sf_dir), layers.bronze, "orders", 0)
    frames = {"bronze_transactions": current_table(spark, layers.bronze), "silver_transactions": _silver(spark, sf_dir)}
    samples = []
    for layer, rows in frames.items():
        sample = layer_sample(layer, rows)
        shown = F.struct(*sample.columns)
        held = rows.select(shown.alias("held")).distinct()
        found = sample.select(shown.alias("row")).join(held, F.col("row").eqNullSafe(F.col("held")), "left")
        sizes = found.agg(F.count(F.lit(1)).alias("n"), F.count("held").alias("n_held"))
        samples.append(sizes.select(F.lit(layer).alias("layer"), "n", "n_held", F.lit(",".join(sample.columns)).alias("columns")))
    return samples[0].unionByName(samples[1])


@query
def stream_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that looks for new files every second, and is stopped when it has had both: each delivery with its batch's
    size."""
    layers, inbox = _fresh_layers(spark), shared_folder(spark, "inbox")
    for delivery in (1, 2):
        _append_file(raw_events(spark, sf_dir, delivery), inbox)
    stream = file_stream(spark, inbox, max_files_per_trigger=1)
    running = start_pipeline(stream, layers, shared_folder(spark, "offsets"), trigger="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    bronze = current_table(spark, layers.bronze)
    sizes = bronze.groupBy("batch_id").agg(F.count(F.lit(1)).alias("in_batch"))
    return bronze.join(sizes, "batch_id").select("ingest_id", "in_batch")
