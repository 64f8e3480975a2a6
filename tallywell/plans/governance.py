"""Review and purge as jobs on the tables. Every job may be repeated after a failure."""

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tallywell.operators.identity import ROW_KEY
from tallywell.operators.purge import NO_DAY, anomalies
from tallywell.operators.quality import CONTRACTS, contract_results
from tallywell.operators.review import ReviewOutcome, apply_decisions, pending_queue
from tallywell.operators.validate import DEFAULT_POLICY, Policy, key_contract_breach
from tallywell.schemas import AUDIT_SCHEMA, BAD_DECISION_SCHEMA, PENDING_SCHEMA
from tallywell.sinks.layers import Layers
from tallywell.sinks.workspace import ensure_checkpoint_dir
from tallywell.sinks.writes import append_absent, delete_from_table, upsert_table
from tallywell.sources.tables import current_table, rows_or_empty
from tallywell.streaming.pipeline import append_pending


def open_reviews(spark: SparkSession, layers: Layers) -> DataFrame:
    """The open queue; empty before the table exists."""
    return pending_queue(rows_or_empty(spark, layers.pending, PENDING_SCHEMA))


def find_review(spark: SparkSession, layers: Layers, order_id: str, ingest_id: str) -> DataFrame:
    """One queue entry by its two ids, bound as parameters."""
    spark.catalog.refreshTable(layers.pending)
    return spark.sql(
        f"SELECT * FROM {layers.pending} WHERE order_id = :order_id AND ingest_id = :ingest_id",
        args={"order_id": order_id, "ingest_id": ingest_id},
    )


def review_job(spark: SparkSession, layers: Layers, decisions: DataFrame) -> DataFrame:
    """Apply a batch of decisions to the tables; returns the decisions that could not be applied, which are stored too.

    The queue is updated last: a job that stops before that finds the rows still open, and the
    earlier writes are keyed, so repeating them changes nothing.
    """
    outcome: ReviewOutcome = apply_decisions(current_table(spark, layers.pending), decisions)
    updates = outcome.silver_updates.persist(StorageLevel.MEMORY_AND_DISK)
    closed = outcome.closed.persist(StorageLevel.MEMORY_AND_DISK)
    ensure_checkpoint_dir(spark)
    # Read before the queue changes; a reliable checkpoint cuts it from the table.
    bad = outcome.bad_decisions.checkpoint()
    try:
        upsert_table(updates, layers.silver, ["order_id"])
        append_absent(outcome.audit, layers.audit, AUDIT_SCHEMA.fieldNames())
        append_absent(bad, layers.bad_decisions, BAD_DECISION_SCHEMA.fieldNames())
        upsert_table(closed, layers.pending, ROW_KEY, null_safe=False, key_fixes=["arrival"])
    finally:
        updates.unpersist()
        closed.unpersist()
    return bad


def contracts_job(spark: SparkSession, layers: Layers, report: Callable[[str], object]) -> int:
    """Run the contracts on the stored tables, report each, and return 1 if one is broken or its table missing."""
    tested = {c.table for c in CONTRACTS}
    frames = {name: df for name, df in layers.frames(spark).items() if name in tested}
    if not any(df is not None for df in frames.values()):
        report("FAIL no table")
        return 1
    failed = 0
    for row in contract_results(frames).collect():  # one row for each contract
        failed += row["failures"] != 0
        state = "FAIL no table" if row["failures"] is None else f"FAIL {row['failures']}" if row["failures"] else "PASS"
        report(f"{state} {row['test']} {row['table']}.{row['column']}")
    return int(failed > 0)


def purge_job(spark: SparkSession, layers: Layers, policy: Policy = DEFAULT_POLICY) -> int:
    """Move anomalies of the clean table to quarantine; returns how many rows left it.

    Quarantine is written first and by key, so a repeated job converges.
    """
    moving = anomalies(current_table(spark, layers.silver), policy)
    # Compared with the open rows only: a delivery closed earlier is opened again.
    append_pending(moving, layers, only_open=True)
    moved = delete_from_table(spark, layers.silver, key_contract_breach(policy))
    if spark.catalog.tableExists(layers.daily_revenue):
        delete_from_table(spark, layers.daily_revenue, NO_DAY)
    return moved
