"""Micro-batch body and query start.

Each batch is classified once and kept while its three sinks are written. Every write replaces or
merges by key, so a replayed batch leaves the tables as one run would have.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywell.operators.identity import ROW_KEY, with_identity
from tallywell.operators.keyed import latest_per_key, rows_absent_from
from tallywell.operators.quality import alert_messages, observed_expectations, observed_results
from tallywell.operators.remediate import BLANK_STATUS_RULE, EMPTY_STATUS_RULE, repair_column
from tallywell.operators.review import HUMAN_RULE, pending_queue
from tallywell.operators.validate import DEFAULT_POLICY, Policy, clean_rows, classify, quarantined_rows
from tallywell.schemas import EVENT_FIELDS, ORIGIN_FIELDS, PENDING_SCHEMA, SILVER_SCHEMA
from tallywell.sinks.layers import Layers
from tallywell.sinks.writes import append_batch, append_rows, upsert_table
from tallywell.sources.codec import with_origin
from tallywell.sources.tables import current_table

# Fixed value: default trigger interval.
TRIGGER = "15 seconds"

@dataclass(frozen=True)
class PipelineOptions:
    """``protect_reviewed`` keeps a human-corrected order when the order is delivered again.
    ``keep_newest`` keeps the row with the greater ingest id instead of the one that came last.
    ``order_day_is_fixed`` promises that a redelivered order keeps its purchase day.
    """

    policy: Policy = field(default_factory=lambda: DEFAULT_POLICY)
    protect_reviewed: bool = True
    keep_newest: bool = False
    order_day_is_fixed: bool = False


def silver_from(classified: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Clean rows, repaired, newest delivery per order, in silver layout."""
    rule = BLANK_STATUS_RULE if policy.blank_is_empty else EMPTY_STATUS_RULE
    repaired = repair_column(clean_rows(classified), "order_status", rule)
    return latest_per_key(repaired, ["order_id"], ["ingest_id"], EVENT_FIELDS).select(*SILVER_SCHEMA.fieldNames())


def pending_from(classified: DataFrame) -> DataFrame:
    """Quarantined rows, each once, in quarantine layout."""
    rows = quarantined_rows(with_origin(classified))
    place = F.when(F.col("payload").isNotNull(), F.col("source"))
    rows = with_identity(rows.withColumn("source", place))
    return rows.select(*PENDING_SCHEMA.fieldNames()).dropDuplicates([*ROW_KEY])


def absent_from_pending(rows: DataFrame, pending: DataFrame) -> DataFrame:
    """Rows that ``pending`` does not hold, whatever their state there."""
    return rows_absent_from(rows, pending, ROW_KEY, null_safe=False)


def merged_pending(pending: DataFrame, rows: DataFrame) -> DataFrame:
    """Quarantine after adding ``rows``; a row it holds already stays as it is, its state included."""
    return pending.unionByName(absent_from_pending(rows, pending))


def append_pending(rows: DataFrame, layers: Layers, *, only_open: bool = False) -> None:
    """Add the rows that quarantine does not hold yet, or with ``only_open`` does not hold open.

    A row's key fixes its day of delivery, so only the days among ``rows`` are compared.
    """
    pending = current_table(rows.sparkSession, layers.pending)
    own, kept = not rows.is_cached, rows
    if own:
        kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        days = [r["arrival"] for r in kept.select("arrival").distinct().collect()]
        if not days:
            return
        held = pending.filter(F.col("arrival").isin(*days))
        append_rows(absent_from_pending(kept, pending_queue(held) if only_open else held), layers.pending)
    finally:
        if own:
            kept.unpersist()


def process_batch(
    batch: DataFrame,
    batch_id: int,
    layers: Layers,
    *,
    stream_id: str,
    options: PipelineOptions | None = None,
    on_alert: Callable[[str], None] | None = None,
    on_results: Callable[[DataFrame], None] | None = None,
) -> None:
    """Write one batch of events to bronze, quarantine and silver.

    ``on_results`` gets the outcome of the expectations on the rows for silver, ``on_alert`` a message for each that failed.
    Both hear of it after the write.
    """
    options, spark = options or PipelineOptions(), batch.sparkSession
    events = with_origin(batch).select(*EVENT_FIELDS, *ORIGIN_FIELDS)
    classified = classify(events, options.policy).persist(StorageLevel.MEMORY_AND_DISK)
    silver = None
    try:
        # Asked of the rows kept: of the batch itself it would read, and shuffle, what a stream does before once more.
        if classified.isEmpty():
            return
        append_batch(classified.select(*EVENT_FIELDS, *ORIGIN_FIELDS), layers.bronze, stream_id, batch_id)
        append_pending(pending_from(classified), layers)
        # The expectations are counted while the rows are made for the write: no job of their own.
        checked, seen = observed_expectations(silver_from(classified, options.policy))
        silver = checked.persist(StorageLevel.MEMORY_AND_DISK)
        upsert_table(
            silver,
            layers.silver,
            ["order_id"],
            protect=f"_remediation_rule = '{HUMAN_RULE}'" if options.protect_reviewed else None,
            newer_by="ingest_id" if options.keep_newest else None,
            key_fixes_partition=options.order_day_is_fixed,
        )
        if on_results is not None or on_alert is not None:
            results = observed_results(spark, seen)
            if on_results is not None:
                on_results(results)
            if on_alert is not None:
                # At most one row per expectation.
                for row in alert_messages(results).collect():
                    on_alert(row["message"])
    finally:
        if silver is not None:
            silver.unpersist()
        classified.unpersist()


def start_pipeline(
    events: DataFrame,
    layers: Layers,
    checkpoint: str,
    *,
    trigger: str | None = TRIGGER,
    options: PipelineOptions | None = None,
    on_alert: Callable[[str], None] | None = None,
    on_results: Callable[[DataFrame], None] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start the stream; ``trigger=None`` works off what is there and stops.

    Offsets live in ``checkpoint``, on shared storage. Bronze batches are filed under the id the
    checkpoint gives the query, so a new checkpoint never replaces older batches.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream_id:
            raise RuntimeError("the stream's id is unknown, so its batches cannot be told from those of others")
        process_batch(batch, batch_id, layers, stream_id=stream_id, options=options, on_alert=on_alert, on_results=on_results)

    writer = events.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()
