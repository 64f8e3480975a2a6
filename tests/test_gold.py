import datetime
from decimal import Decimal

from plain_rows import as_dicts
from pyspark.sql import functions as F

from tallywell.operators.quality import alert_messages, contract_results, expectation_results
from tallywell.operators.report import inspect_layers, sample_rows, top_rows
from tallywell.operators.validate import classify
from tallywell.plans.gold import (
    MISSING_STATUS_LABEL,
    create_views,
    customer_activity,
    daily_revenue,
    daily_revenue_merged,
    refresh_customer_activity,
    refresh_daily_revenue,
    register_views,
)
from tallywell.schemas import CUSTOMER_ACTIVITY_SCHEMA, DAILY_REVENUE_SCHEMA, SILVER_SCHEMA
from tallywell.sinks import delete_from_table, upsert_table
from tallywell.streaming.pipeline import silver_from

D1, D2, D3 = (datetime.date(2026, 1, d) for d in (1, 2, 3))


def at(day):
    return f"{day} 10:00:00"


def silver(events, *rows):
    return silver_from(classify(events(*rows)))


ROWS = [
    ("1", "a", "c1", "delivered", at(D1), "10.01"),
    ("2", "b", "c1", "", at(D1), "20.00"),
    ("3", "c", "c2", "shipped", at(D2), "abc"),
    ("4", "d", "c1", "delivered", at(D2), "0.01"),
]


def test_daily_revenue(events):
    df = daily_revenue(silver(events, *ROWS))
    assert df.schema.fieldNames() == DAILY_REVENUE_SCHEMA.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in DAILY_REVENUE_SCHEMA]
    got = {r["revenue_date"]: tuple(r)[1:] for r in df.collect()}
    assert got == {D1: (2, Decimal("30.01"), Decimal("15.01")), D2: (2, Decimal("0.01"), Decimal("0.01"))}
    assert as_dicts(daily_revenue(silver(events, *ROWS), order_ids_unique=True)) == as_dicts(df)


def test_distinct_orders_and_blank_ids(spark):
    rows = [("a", D1, Decimal(1)), ("a", D1, Decimal(2)), (" ", D1, Decimal(4)), (None, D1, Decimal(8)), ("b", None, Decimal(16))]
    df = spark.createDataFrame(rows, "order_id string, created_date date, parsed_payment_value decimal(18,2)")
    assert [tuple(r) for r in daily_revenue(df).collect()] == [(D1, 1, Decimal("3.00"), Decimal("1.50"))]


def test_incremental_cutoff_and_lookback(events):
    first = daily_revenue(silver(events, ROWS[0], ROWS[3]))
    late = silver(events, *ROWS, ("9", "z", "c9", "shipped", at(D3), "5"))
    merged = {r["revenue_date"]: r["total_orders"] for r in daily_revenue_merged(late, first).collect()}
    assert merged == {D1: 1, D2: 2, D3: 1}
    wide = {r["revenue_date"]: r["total_orders"] for r in daily_revenue_merged(late, first, lookback_days=1).collect()}
    assert wide == {D1: 2, D2: 2, D3: 1}
    assert as_dicts(daily_revenue_merged(late, first.limit(0))) == as_dicts(daily_revenue(late))


def test_customer_activity(events):
    df = customer_activity(silver(events, *ROWS))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in CUSTOMER_ACTIVITY_SCHEMA]
    got = {r["customer_id"]: tuple(r)[1:] for r in df.collect()}
    assert got["c1"] == (D1, D2, 3, Decimal("30.02"), f"{MISSING_STATUS_LABEL}, delivered")
    assert got["c2"] == (D2, D2, 1, None, "shipped")


def test_stored_models_and_views(spark, layers, events):
    upsert_table(silver(events, *ROWS), layers.silver, ["order_id"])
    for _ in range(2):
        refresh_daily_revenue(spark, layers)
        refresh_customer_activity(spark, layers)
    assert spark.table(layers.daily_revenue).count() == 2
    upsert_table(silver(events, ("8", "y", "c1", "s", at(D1), "1"), ("9", "z", "c9", "s", at(D3), "5")), layers.silver, ["order_id"])
    for options, first in (({"lookback_days": 0}, 2), ({}, 3), ({"full_refresh": True}, 3)):
        refresh_daily_revenue(spark, layers, **options)
        assert {r["revenue_date"]: r["total_orders"] for r in spark.table(layers.daily_revenue).collect()} == {D1: first, D2: 2, D3: 1}
    # A day that loses its last order goes.
    delete_from_table(spark, layers.silver, "order_id = 'z'")
    refresh_daily_revenue(spark, layers)
    assert {r["revenue_date"] for r in spark.table(layers.daily_revenue).collect()} == {D1, D2}
    upsert_table(silver(events, ("9", "z", "c9", "s", at(D3), "5")), layers.silver, ["order_id"])
    refresh_daily_revenue(spark, layers)

    create_views(spark, layers)
    home = layers.daily_revenue.rsplit(".", 1)[0]
    assert spark.table(f"{home}.v_daily_revenue").count() == 3
    daily, activity = spark.table(layers.daily_revenue), spark.table(layers.customer_activity)
    register_views(spark, daily.unionByName(daily).withColumn("revenue_date", F.col("revenue_date")), activity)
    assert as_dicts(spark.table("v_daily_revenue")) == as_dicts(daily)
    assert as_dicts(spark.table("v_customer_activity")) == as_dicts(activity)

    frames = layers.frames(spark)
    report = {(r["layer"], r["metric"], r["key"]): r["value"] for r in inspect_layers(spark, frames).collect()}
    assert report[("silver_transactions", "rows", "all")] == 6
    assert report[("silver_transactions", "breakdown", "validation_status=EMPTY_STATUS|_is_remediated=true")] == 1
    assert report[("silver_pending_review", "rows", "all")] == 0
    assert report[("daily_revenue", "rows", "all")] == 3
    frames["audit_log"] = None
    assert ("audit_log", "missing", "all") in {(r["layer"], r["metric"], r["key"]) for r in inspect_layers(spark, frames).collect()}
    assert [r["revenue_date"] for r in top_rows(daily, "revenue_date", 2).collect()] == [D3, D2]
    assert sample_rows(daily, ["revenue_date"], 2).count() == 2


def test_contracts_count_every_breach(spark, events):
    rows = silver(events, *ROWS)
    broken = rows.unionByName(rows.filter("order_id IN ('a', 'b')")).unionByName(
        rows.limit(1).withColumn("order_id", F.lit(None).cast("string"))
    )
    results = contract_results(
        {"silver_transactions": broken, "daily_revenue": daily_revenue(rows), "customer_activity": customer_activity(rows)}
    )
    failures = {(r["table"], r["column"], r["test"]): r["failures"] for r in results.collect()}
    assert len(failures) == 13
    assert {k: v for k, v in failures.items() if v} == {
        ("silver_transactions", "order_id", "unique"): 2,
        ("silver_transactions", "order_id", "not_null"): 1,
        ("customer_activity", "total_spent", "not_null"): 1,
    }
    empty = contract_results({"silver_transactions": spark.createDataFrame([], SILVER_SCHEMA)})
    assert [r["failures"] for r in empty.collect()] == [0, 0, 0]


def test_expectations(spark, events):
    ok = expectation_results(silver(events, *ROWS))
    assert [r["success"] for r in ok.collect()] == [True, True] and alert_messages(ok).count() == 0
    empty = expectation_results(spark.createDataFrame([], SILVER_SCHEMA)).collect()
    assert [(r["failed"], r["total"], r["success"]) for r in empty] == [(0, 0, True)] * 2
