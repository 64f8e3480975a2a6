import pytest
from pyspark.sql import functions as F

from tallywell.operators.review import apply_decisions
from tallywell.operators.validate import classify
from tallywell.schemas import DECISION_SCHEMA
from tallywell.streaming.pipeline import pending_from


@pytest.mark.parametrize("named", [False, True])
def test_decisions_without_an_open_row_are_spread_over_tasks(spark, events, named):
    """They have no key in common with any row; by ids or by row key, they may not all meet in one task."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    kept = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        pending = pending_from(classify(events(("i1", "", "c1", "shipped", "2026-01-01", "1.00"))))
        n = F.col("id").cast("string")
        fields = {
            # Decisions that name a row may well share their ids.
            "order_id": F.lit("o") if named else n,
            "ingest_id": n if not named else F.lit("i"),
            "decision": F.lit("N"),
            "corrected_value": F.lit(None).cast("string"),
            "reviewed_by": F.lit("ann"),
            "reviewed_at": F.lit("2026-01-02T00:00:00"),
            "row_key": F.concat(F.lit("key"), n) if named else F.lit(None).cast("string"),
        }
        late = spark.range(4000).select(*[fields[name].alias(name) for name in DECISION_SCHEMA.fieldNames()])
        bad = apply_decisions(pending, late).bad_decisions
        parts = bad.groupBy("reason", F.spark_partition_id().alias("part")).count().collect()
        assert {r["reason"] for r in parts} == {"NOT_PENDING"}
        assert sum(r["count"] for r in parts) == 4000
        assert max(r["count"] for r in parts) < 2000
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_ids_are_not_taken_for_those_of_another_row(spark, events):
    """The same letters, parted differently into order and ingest id."""
    pending = pending_from(classify(events(("bc", "a", "", "shipped", "2026-01-01", "1.00"))))
    rows = [("ab", "c", "N", None, "ann", "2026-01-02"), ("a", "bc", "N", None, "ann", "2026-01-02")]
    names = [n for n in DECISION_SCHEMA.fieldNames() if n != "row_key"]
    decisions = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    outcome = apply_decisions(pending, decisions)
    assert [(r["order_id"], r["reason"]) for r in outcome.bad_decisions.collect()] == [("ab", "NOT_PENDING")]
    assert [r["_status"] for r in outcome.pending.collect()] == ["REJECTED"]
