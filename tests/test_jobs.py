"""All jobs in a row, from CSV files to the report."""

import uuid

import pytest
from pyspark.sql.functions import lit

from tallywell.__main__ import run
from tallywell.sinks import Layers
from tallywell.sources import current_table

ORDERS = """order_id,customer_id,order_status,order_purchase_timestamp,note
o1,c1,delivered,2026-01-02 10:00:00,x
o2,c1,,2026-01-01 10:00:00,x
o3,c2,shipped,2026-01-03 10:00:00,x
o4,c3,shipped,,x
o5,c3,shipped,2026-01-03 11:00:00,x
"""
PAYMENTS = "order_id,payment_value\no1,10.00\no1,5.50\no2,7\no3,-20.00\no4,1\n"


def test_jobs_end_to_end(spark, tmp_path, capsys):
    (tmp_path / "orders.csv").write_text(ORDERS)
    (tmp_path / "payments.csv").write_text(PAYMENTS)
    prefix = f"j{uuid.uuid4().hex[:8]}_"
    layers = Layers(prefix=prefix)
    shared = ["--prefix", prefix, "--location", f"{tmp_path}/lake"]
    files = ["--topic", f"{tmp_path}/topic", "--codec", "json"]

    def job(*args):
        run(spark, [*shared, *args])

    job("create")
    job("publish", f"{tmp_path}/orders.csv", f"{tmp_path}/payments.csv", *files, "--dead", f"{tmp_path}/dead")
    assert spark.read.parquet(f"{tmp_path}/topic").count() == 5
    assert spark.read.parquet(f"{tmp_path}/dead").count() == 0
    job("stream", *files, "--checkpoint", f"{tmp_path}/offsets", "--trigger", "once")
    silver = {r["order_id"]: r for r in current_table(spark, layers.silver).collect()}
    assert set(silver) == {"o1", "o2", "o5"}
    assert silver["o1"]["payment_value"] == "15.50" and silver["o5"]["payment_value"] == "0.00"
    pending = {r["order_id"]: r["ingest_id"] for r in current_table(spark, layers.pending).collect()}
    assert set(pending) == {"o3", "o4"}

    (tmp_path / "decisions.csv").write_text(
        "order_id,ingest_id,decision,corrected_value,reviewed_by,reviewed_at\n"
        f"o3,{pending['o3']},Y,20.00,ann,2026-02-01T10:00:00\n"
        f"o4,{pending['o4']},what,,ann,2026-02-01T10:00:00\n"
    )
    job("queue", f"{tmp_path}/queue")
    assert spark.read.csv(f"{tmp_path}/queue", header=True).count() == 2
    job("review", f"{tmp_path}/decisions.csv")
    assert "1 decisions could not be applied" in capsys.readouterr().out
    assert [r["reason"] for r in current_table(spark, layers.bad_decisions).collect()] == ["UNKNOWN_DECISION"]
    job("purge")
    assert "0 rows moved" in capsys.readouterr().out
    assert run(spark, [*shared, "contracts"]) == 1  # gold is not there yet
    shown = capsys.readouterr().out
    assert shown.count("PASS") == 3 and shown.count("FAIL no table") == 10
    job("refresh")
    job("refresh", "--lookback-days", "2")
    revenue = {str(r["revenue_date"]): str(r["gross_revenue"]) for r in current_table(spark, layers.daily_revenue).collect()}
    assert revenue == {"2026-01-01": "7.00", "2026-01-02": "15.50", "2026-01-03": "20.00"}
    assert run(spark, [*shared, "contracts"]) == 0
    assert capsys.readouterr().out.count("PASS") == 13
    current_table(spark, layers.silver).limit(1).withColumn("validation_status", lit(None).cast("string")).write.insertInto(layers.silver)
    assert run(spark, [*shared, "contracts"]) == 1
    assert "FAIL 1 not_null silver_transactions.validation_status" in capsys.readouterr().out
    job("inspect")
    shown = capsys.readouterr().out
    assert "silver_pending_review" in shown and "_status=APPROVED" in shown and "FIX_EMPTY_STATUS" in shown


def test_faults_reach_the_dead_letters(spark, tmp_path, capsys):
    (tmp_path / "orders.csv").write_text(ORDERS)
    (tmp_path / "payments.csv").write_text(PAYMENTS)
    run(
        spark,
        ["publish", f"{tmp_path}/orders.csv", f"{tmp_path}/payments.csv", "--topic", f"{tmp_path}/topic"]
        + ["--dead", f"{tmp_path}/dead", "--structural-rate", "1.0", "--delivered-at", "1000"],
    )
    assert "5 events could not be encoded" in capsys.readouterr().out
    assert spark.read.parquet(f"{tmp_path}/dead").count() == 5


def test_unknown_job_is_refused(spark):
    with pytest.raises(SystemExit):
        run(spark, ["dance"])


def test_contracts_without_any_table_fail(spark, capsys):
    assert run(spark, ["--prefix", "nowhere_", "contracts"]) == 1
    assert "FAIL no table" in capsys.readouterr().out
