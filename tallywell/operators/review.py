"""Human review decisions, applied in bulk instead of row by row."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywell.functions import exact_money
from tallywell.operators.identity import ROW_KEY
from tallywell.operators.keyed import content_hash, latest_per_key, update_columns
from tallywell.operators.skew import lookup_join
from tallywell.operators.validate import DEFAULT_POLICY, Policy, key_contract_breach
from tallywell.schemas import AUDIT_SCHEMA, DECISION_SCHEMA, SILVER_SCHEMA

# A decision file may not tell an empty id from a missing one.
REVIEW_KEYS = ("coalesce(order_id, '')", "coalesce(ingest_id, '')")

# Accepted decision words, and what each writes.
APPROVE_WORDS = ("Y", "APPROVED")
REJECT_WORDS = ("N", "REJECTED")
SKIP_WORDS = ("S", "SKIP")
HUMAN_RULE = "HUMAN_OVERRIDE"
APPROVE_ACTION = "APPROVE_AND_FIX"
REJECT_ACTION = "REJECT"
NO_VALUE = "N/A"


@dataclass(frozen=True)
class ReviewOutcome:
    """``silver_updates`` holds each order once, ready for an upsert on ``order_id``. ``pending`` is
    the whole queue table after the decisions, ``closed`` only the rows they changed."""

    silver_updates: DataFrame
    pending: DataFrame
    closed: DataFrame
    audit: DataFrame
    bad_decisions: DataFrame


def pending_queue(pending: DataFrame) -> DataFrame:
    return pending.filter(F.col("_status") == "PENDING")


def _sorted_out(decisions: DataFrame) -> DataFrame:
    """Decisions with the word read, the amount typed, and the fault of those not applicable."""
    word = F.upper(F.trim(F.coalesce("decision", F.lit(""))))
    if "row_key" not in decisions.columns:
        decisions = decisions.withColumn("row_key", F.lit(None).cast("string"))
    # A file writes a missing key as an empty text.
    decisions = decisions.withColumn("row_key", F.when(F.trim("row_key") != "", F.trim("row_key")))
    read = decisions.select(*DECISION_SCHEMA.fieldNames()).withColumns(
        {
            "__verdict": F.when(word.isin(*APPROVE_WORDS), F.lit("APPROVED"))
            .when(word.isin(*REJECT_WORDS), F.lit("REJECTED"))
            .when(word.isin(*SKIP_WORDS), F.lit("SKIP")),
            "__amount": exact_money(F.col("corrected_value")),
        }
    )
    fault = F.when(F.col("__verdict").isNull(), F.lit("UNKNOWN_DECISION")).when(
        (F.col("__verdict") == "APPROVED") & F.col("__amount").isNull(), F.lit("INVALID_AMOUNT")
    )
    return read.withColumn("reason", fault)


def apply_decisions(pending: DataFrame, decisions: DataFrame, policy: Policy = DEFAULT_POLICY) -> ReviewOutcome:
    """Apply ``decisions`` to the open rows of ``pending``.

    A decision is meant for the row whose ``row_key`` it names. Without a key, as in files that know only ids, it is meant for
    the one open row that has its order id and ingest id; if several have, it is not applied, as it does not tell which.

    A skip changes nothing. Of several applicable decisions on one row the latest ``reviewed_at`` counts. An approval corrects
    the amount: a row that would still lack its order, customer or day stays open. Whatever cannot be applied comes back in
    ``bad_decisions`` with a reason.
    """
    read = _sorted_out(decisions)
    usable = read.filter(F.col("reason").isNull() & (F.col("__verdict") != "SKIP")).drop("reason")
    judged = _located(usable, pending_queue(pending), policy)
    sound = judged.filter(F.col("reason").isNull())
    # Equal decisions share a place. A row has as many decisions as people made on it.
    newest = Window.partitionBy("__key").orderBy(F.desc_nulls_last("reviewed_at"), F.desc("__verdict"), content_hash(_names()))
    placed = sound.withColumn("__place", F.dense_rank().over(newest)).withColumn("__row", F.row_number().over(newest))
    decided = placed.filter("__row = 1")

    row = [F.col(f"__found.{c}").alias(c) for c in pending.columns if c != "_status"]
    verdict = [F.col(c) for c in ("__verdict", "__amount", "reviewed_by", "reviewed_at")]
    rows = decided.select(*row, *verdict)
    approved = rows.filter(F.col("__verdict") == "APPROVED").withColumns(
        {
            "payment_value": F.col("__amount").cast("string"),
            "parsed_payment_value": F.col("__amount"),
            "validation_status": F.lit("VALID"),
            "_is_remediated": F.lit(True),
            "_remediation_rule": F.lit(HUMAN_RULE),
        }
    )
    updates = latest_per_key(approved, ["order_id"], ["reviewed_at", "ingest_id"])
    states = rows.select("row_key", F.col("__verdict").alias("_status"))
    closed = rows.withColumn("_status", F.col("__verdict")).select(*pending.columns)
    overruled = placed.filter("__place > 1").withColumn("reason", F.lit("SUPERSEDED"))
    names = [*DECISION_SCHEMA.fieldNames(), "reason"]
    bad = read.filter(F.col("reason").isNotNull()).select(*names)
    bad = bad.unionByName(judged.filter(F.col("reason").isNotNull()).select(*names)).unionByName(overruled.select(*names))
    return ReviewOutcome(
        silver_updates=updates.select(*SILVER_SCHEMA.fieldNames()),
        pending=update_columns(pending, states, ROW_KEY, ["_status"], where="_status = 'PENDING'"),
        closed=closed,
        audit=_audit_rows(rows),
        bad_decisions=bad,
    )


def _names() -> list[str]:
    return DECISION_SCHEMA.fieldNames()


def _ids() -> Column:
    """Both ids as one text; the length tells where the first ends."""
    first, second = (F.expr(k) for k in REVIEW_KEYS)
    return F.concat(F.length(first).cast("string"), F.lit(":"), first, second)


def _located(usable: DataFrame, queue: DataFrame, policy: Policy) -> DataFrame:
    """Decisions with the key and the row (``__found``) they are meant for, or the reason why there is none.

    Most decisions may have no open row. They have no key, and are spread over the tasks like all others.
    """
    by_ids = queue.groupBy(_ids().alias("__ids")).agg(F.count(F.lit(1)).alias("__n"), F.min("row_key").alias("__only"))
    asked = usable.withColumn("__ids", F.when(F.col("row_key").isNull(), _ids()))
    keyed = lookup_join(asked, by_ids, "__ids").drop("__ids")
    keyed = keyed.withColumn("__key", F.coalesce("row_key", F.when(F.col("__n") == 1, F.col("__only")))).drop("__only")
    rows = queue.select(
        F.col("row_key").alias("__key"),
        F.col("row_key").alias("__row_key"),
        F.expr(key_contract_breach(policy)).alias("__breach"),
        F.struct(*[c for c in queue.columns if c != "_status"]).alias("__found"),
    )
    reason = (
        F.when(F.col("__n") > 1, F.lit("AMBIGUOUS"))
        .when(F.col("__row_key").isNull(), F.lit("NOT_PENDING"))
        .when((F.col("__verdict") == "APPROVED") & F.col("__breach"), F.lit("BREAKS_KEY_CONTRACT"))
    )
    return lookup_join(keyed, rows, "__key").withColumn("reason", reason)


def _audit_rows(decided: DataFrame) -> DataFrame:
    fixed = F.col("__verdict") == "APPROVED"
    columns = {
        "order_id": F.col("order_id"),
        "old_value": F.coalesce("payment_value", F.lit("None")),
        "new_value": F.when(fixed, F.col("__amount").cast("string")).otherwise(F.lit(NO_VALUE)),
        "field_changed": F.lit("payment_value"),
        "action": F.when(fixed, F.lit(APPROVE_ACTION)).otherwise(F.lit(REJECT_ACTION)),
        "reviewed_by": F.col("reviewed_by"),
        "reviewed_at": F.col("reviewed_at"),
    }
    return decided.select(*[columns[n].alias(n) for n in AUDIT_SCHEMA.fieldNames()])
