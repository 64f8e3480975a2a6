import json
import uuid

import pytest
from plain_rows import as_dicts
from pyspark.errors import AnalysisException

from tallywell.schemas import EVENT_FIELDS, EVENT_SCHEMA, PENDING_SCHEMA, event_avro_schema
from tallywell.sinks import file_writer, publish_events
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
from tallywell.sources import tables
from tallywell.sources.codec import CORRUPT
from tallywell.sources.streams import kafka_options, kafka_stream

ROW = ("del-07", "ord:88", "buyer 5", "in transit", "2031-06-30 23:59:59", "12345.678")


def test_csv_by_header_name_with_bom_quotes_and_empty_cells(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(
        "﻿order_id,extra,order_status,customer_id,order_purchase_timestamp\n"
        'o1,x,delivered,"c ""1"", x",2026-01-01 10:00:00\no2,x,,c2,\n',
        encoding="utf-8",
    )
    rows = read_raw_orders(spark, str(path)).orderBy("order_id").collect()
    assert tuple(rows[0]) == ("o1", 'c "1", x', "delivered", "2026-01-01 10:00:00")
    assert tuple(rows[1]) == ("o2", "c2", "", "")
    assert read_csv_text(spark, str(path)).columns[0] == "order_id"


def test_files_of_another_header_fail_the_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order_id,payment_value\no1,1.00\n")
    (tmp_path / "b.csv").write_text("payment_value,order_id\n2.00,o2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_raw_payments(spark, str(tmp_path)).collect()


def test_payments_scan_reads_only_its_columns(spark, tmp_path):
    path = tmp_path / "payments.csv"
    path.write_text("order_id,kind,payment_value\no1,card,99.90\n")
    df = read_raw_payments(spark, str(path))
    assert [tuple(r) for r in df.collect()] == [("o1", "99.90")]
    assert "kind" not in df._jdf.queryExecution().executedPlan().toString()


def test_json_roundtrip_and_corrupt_payloads(spark, events):
    df = events(ROW, ("i2", None, "c", "", "", "1"))
    assert as_dicts(decode_events(encode_events(df))) == as_dicts(df)
    raw = spark.createDataFrame([(b"not json",), (None,)], "value binary")
    rows = decode_events(raw, keep_corrupt=True).collect()
    assert all(r[f] is None for r in rows for f in EVENT_FIELDS)
    assert {r[CORRUPT] for r in rows} == {"not json", None}
    with pytest.raises(ValueError):
        decode_events(raw, codec="xml")


def test_avro_roundtrip_where_the_module_is_present(spark, events):
    assert [f["name"] for f in json.loads(event_avro_schema())["fields"]] == list(EVENT_FIELDS)
    try:
        got = as_dicts(decode_events(encode_events(events(ROW), "avro"), codec="avro"))
    except AnalysisException as error:
        pytest.skip(f"no Avro module: {error.getCondition()}")
    assert got == as_dicts(events(ROW))


def test_structural_split(spark, events, tmp_path):
    df = events(ROW, ("i2", None, "c", "", "", None))
    sound, dead = split_structural(df)
    assert as_dicts(sound) == as_dicts(events(ROW))
    letter = dead.first()
    assert json.loads(letter["payload"]) == dict(zip(EVENT_FIELDS, ("i2", None, "c", "", "", None)))
    assert letter["error"] == "required field is null: order_id,payment_value"
    publish_events(df, file_writer(f"{tmp_path}/main"), file_writer(f"{tmp_path}/dead"))
    assert as_dicts(decode_events(spark.read.parquet(f"{tmp_path}/main"))) == as_dicts(events(ROW))
    assert spark.read.parquet(f"{tmp_path}/dead").count() == 1


def test_streaming_publish(spark, events, tmp_path):
    events(ROW, ("i2", None, "c", "", "", None)).write.parquet(f"{tmp_path}/in")
    queries = publish_events(
        file_stream(spark, f"{tmp_path}/in"),
        file_writer(f"{tmp_path}/main", f"{tmp_path}/cp1"),
        file_writer(f"{tmp_path}/dead", f"{tmp_path}/cp2"),
    )
    for q in queries:
        q.processAllAvailable()
        q.stop()
    assert spark.read.parquet(f"{tmp_path}/main").count() == spark.read.parquet(f"{tmp_path}/dead").count() == 1


def test_csv_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(",".join(EVENT_FIELDS) + "\n" + ",".join(ROW) + "\n")
    stream = file_stream(spark, f"{tmp_path}/in", file_format="csv", max_files_per_trigger=1, header=True)
    assert stream.isStreaming and stream.schema == EVENT_SCHEMA
    q = stream.writeStream.format("memory").queryName("csv_rows").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [tuple(r) for r in spark.table("csv_rows").collect()] == [ROW]


def test_kafka_options(spark):
    options = kafka_options("broker:9092", "raw")
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "raw",
        "startingOffsets": "earliest",
    }
    assert kafka_options("b", "t", max_offsets_per_trigger=7)["maxOffsetsPerTrigger"] == "7"
    try:
        assert kafka_stream(spark, "broker:9092", "raw").isStreaming
    except AnalysisException as error:
        pytest.skip(f"no Kafka connector: {error.getCondition()}")


def test_missing_table_is_empty(spark):
    df = rows_or_empty(spark, "no_such_schema.pending", PENDING_SCHEMA)
    assert df.count() == 0 and df.schema == PENDING_SCHEMA


def test_folders_of_a_table_are_listed_by_few_tasks(spark):
    name, group = f"many_{uuid.uuid4().hex[:8]}", uuid.uuid4().hex
    spark.range(60).selectExpr("id", "id AS part").coalesce(1).write.partitionBy("part").saveAsTable(name)
    context, before = spark.sparkContext, spark.conf.get(tables._LISTING)
    spark.conf.set(tables._LISTING, "10000")
    context.setJobGroup(group, "listing")
    try:
        assert current_table(spark, name).count() == 60
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set(tables._LISTING, before)
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds]
    known = [info for info in map(tracker.getStageInfo, stages) if info]
    enough = tables.LISTINGS_PER_CORE * context.defaultParallelism
    assert known and max(info.numTasks for info in known) <= enough < 60


def test_a_session_that_lists_with_fewer_tasks_keeps_its_setting(spark):
    before = spark.conf.get(tables._LISTING)
    spark.conf.set(tables._LISTING, "3")
    try:
        tables.list_in_few_tasks(spark)
        assert spark.conf.get(tables._LISTING) == "3"
    finally:
        spark.conf.set(tables._LISTING, before)
