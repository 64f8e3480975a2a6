import shutil

from plain_rows import as_dicts
from pyspark.sql import functions as F

from tallywell.operators.validate import classify
from tallywell.schemas import EVENT_FIELDS, EVENT_SCHEMA
from tallywell.sinks import Layers, create_layers, upsert_table
from tallywell.sinks.publish import batch_file_writer, publish_stream
from tallywell.sources import current_table, decode_events, file_stream
from tallywell.streaming import PipelineOptions, process_batch, start_pipeline
from tallywell.streaming.dedup import without_redeliveries
from tallywell.streaming.pipeline import pending_from, silver_from

# Two of each kind: sound, to be repaired, negative, and without a customer.
MICRO_BATCH = [
    ("k01", "A-7", "anna", "packed", "2031-03-09 08:15:00", "19.99"),
    ("k02", "A-8", "bert", "shipped", "2031-03-10 09:30:00", "1e2"),
    ("k03", "B-1", "anna", "", "2031-03-09 23:59:59", "0.01"),
    ("k04", "B-2", "cora", None, "2031-03-11 00:00:00", "7"),
    ("k05", "C-1", "bert", "packed", "2031-03-10 12:00:00", "-3.50"),
    ("k06", "C-2", "dora", "packed", "2031-03-12 12:00:00", "-0.01"),
    ("k07", "D-1", "", "packed", "2031-03-12 12:00:00", "5"),
    ("k08", "D-2", None, "packed", "2031-03-13 12:00:00", "6"),
]
SOUND, REPAIRED, HELD = {"A-7", "A-8"}, {"B-1", "B-2"}, {"C-1", "C-2", "D-1", "D-2"}


def run(spark, layers, batch, batch_id=0, **kwargs):
    process_batch(batch, batch_id, layers, stream_id="test", **kwargs)


def snapshot(spark, layers):
    names = (layers.silver, layers.pending)
    return [as_dicts(current_table(spark, n)) for n in names] + [as_dicts(current_table(spark, layers.bronze).drop("ingested_at"))]


def test_batch_is_routed_repaired_and_replayable(spark, layers, events):
    run(spark, layers, events(*MICRO_BATCH))
    first = snapshot(spark, layers)
    shown = {r["order_id"]: (r["order_status"], r["_is_remediated"], r["_remediation_rule"]) for r in first[0]}
    assert shown == {
        "A-7": ("packed", False, None),
        "A-8": ("shipped", False, None),
        "B-1": ("UNKNOWN", True, "FIX_EMPTY_STATUS"),
        "B-2": ("UNKNOWN", True, "FIX_EMPTY_STATUS"),
    }
    assert {(r["order_id"], r["_status"], r["validation_status"]) for r in first[1]} == {
        ("C-1", "PENDING", "NEGATIVE_VALUE"),
        ("C-2", "PENDING", "NEGATIVE_VALUE"),
        ("D-1", "PENDING", "INVALID"),
        ("D-2", "PENDING", "INVALID"),
    }
    assert len(first[2]) == len(MICRO_BATCH)
    run(spark, layers, events(*MICRO_BATCH))
    assert snapshot(spark, layers) == first


def test_empty_batch_writes_nothing(spark, layers, events):
    run(spark, layers, events(*MICRO_BATCH).limit(0))
    assert current_table(spark, layers.bronze).count() == 0


def test_newest_delivery_in_a_batch_wins(spark, layers, events):
    day = "2026-01-01 10:00:00"
    run(spark, layers, events(*[(f"{i:03}", "o", "c", "s", day, str(i)) for i in range(50)]))
    row = current_table(spark, layers.silver).first()
    assert (row["ingest_id"], row["payment_value"]) == ("049", "49")
    assert current_table(spark, layers.bronze).count() == 50


def test_redelivery_options(spark, layers, events):
    day = "2026-01-01 10:00:00"
    run(spark, layers, events(("5", "a", "c", "s", day, "5")), 0)
    run(spark, layers, events(("4", "a", "c", "s", day, "4")), 1, options=PipelineOptions(keep_newest=True))
    assert current_table(spark, layers.silver).first()["payment_value"] == "5"
    run(spark, layers, events(("4", "a", "c", "s", day, "4")), 2)
    assert current_table(spark, layers.silver).first()["payment_value"] == "4"

    reviewed = current_table(spark, layers.silver).withColumn("_remediation_rule", F.lit("HUMAN_OVERRIDE"))
    upsert_table(reviewed, layers.silver, ["order_id"])
    run(spark, layers, events(("6", "a", "c", "s", day, "6")), 3)
    assert current_table(spark, layers.silver).first()["payment_value"] == "4"
    run(spark, layers, events(("6", "a", "c", "s", day, "6")), 4, options=PipelineOptions(protect_reviewed=False))
    assert current_table(spark, layers.silver).first()["payment_value"] == "6"


def test_replay_does_not_reopen_a_closed_review(spark, layers, events):
    run(spark, layers, events(*MICRO_BATCH))
    closed = current_table(spark, layers.pending).withColumn("_status", F.lit("REJECTED"))
    upsert_table(closed, layers.pending, ["row_key"])
    run(spark, layers, events(*MICRO_BATCH))
    assert [r["_status"] for r in current_table(spark, layers.pending).collect()] == ["REJECTED"] * len(HELD)


def test_alerts_are_advisory(spark, layers, events):
    alerts = []
    # An empty status hides the negative amount, so the row reaches the clean table.
    run(spark, layers, events(("1", "o", "c", "", "2026-01-01 10:00:00", "-5")), on_alert=alerts.append)
    assert alerts == ["quality check at_least_0(parsed_payment_value) failed for 1 of 1 rows"]
    run(spark, layers, events(*MICRO_BATCH), 1, on_alert=alerts.append)
    assert len(alerts) == 1


def random_events(spark, n):
    u = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 6), 16, 10).cast("int")
    return spark.range(n).select(
        F.lpad(F.col("id").cast("string"), 8, "0").alias("ingest_id"),
        F.when(u % 17 == 0, "").when(u % 3 == 0, "hot").otherwise((u % 400).cast("string")).alias("order_id"),
        F.when(u % 19 == 0, F.lit(None)).otherwise((u % 50).cast("string")).alias("customer_id"),
        F.when(u % 5 == 0, "").otherwise("shipped").alias("order_status"),
        F.when(u % 23 == 0, "").otherwise(
            F.concat(F.lit("2026-01-0"), (u % 7 + 1).cast("string"), F.lit(" 00:00:00"))
        ).alias("order_purchase_timestamp"),
        F.when(u % 11 == 0, "-1.50").otherwise((u % 1000).cast("string")).alias("payment_value"),
    )


def test_stream_equals_batch_over_restarts_and_many_batches(spark, layers, tmp_path):
    source = random_events(spark, 3000).persist()
    inbox, checkpoint = f"{tmp_path}/in", f"{tmp_path}/cp"
    options = PipelineOptions(keep_newest=True)
    for part in range(3):
        # Arrival order differs from ingest order on purpose.
        source.filter(F.col("ingest_id").cast("int") % 3 == 2 - part).coalesce(2).write.mode("append").parquet(inbox)
        stream = file_stream(spark, inbox, max_files_per_trigger=1)
        start_pipeline(stream, layers, checkpoint, trigger=None, options=options, name=f"s{part}").awaitTermination()
    whole = classify(source)
    assert as_dicts(current_table(spark, layers.silver)) == as_dicts(silver_from(whole).select(current_table(spark, layers.silver).columns))
    assert as_dicts(current_table(spark, layers.pending)) == as_dicts(pending_from(whole))
    assert as_dicts(current_table(spark, layers.bronze).select(*EVENT_FIELDS)) == as_dicts(source)
    assert current_table(spark, layers.bronze).select("stream_id").distinct().count() == 1


def test_new_checkpoint_keeps_older_bronze(spark, layers, events, tmp_path):
    events(*MICRO_BATCH).write.parquet(f"{tmp_path}/in")
    for n in range(2):
        start_pipeline(file_stream(spark, f"{tmp_path}/in"), layers, f"{tmp_path}/cp{n}", trigger=None).awaitTermination()
    assert current_table(spark, layers.bronze).count() == 2 * len(MICRO_BATCH)
    assert current_table(spark, layers.silver).count() == len(SOUND | REPAIRED)


def test_interval_trigger(spark, tmp_path, layers, events):
    events(*MICRO_BATCH).write.parquet(f"{tmp_path}/in")
    q = start_pipeline(file_stream(spark, f"{tmp_path}/in"), layers, f"{tmp_path}/cp", trigger="1 second")
    q.processAllAvailable()
    q.stop()
    assert current_table(spark, layers.silver).count() == len(SOUND | REPAIRED)


def test_failed_batch_is_replayed_whole(spark, tmp_path, layers, events):
    """The batch dies after its first sink; the restart completes it without doubles."""
    events(*MICRO_BATCH).write.parquet(f"{tmp_path}/in")
    missing = Layers(prefix=layers.prefix + "x_")
    create_layers(spark, missing, location=f"{tmp_path}/lake2")
    spark.sql(f"DROP TABLE {missing.pending}")
    failed = start_pipeline(file_stream(spark, f"{tmp_path}/in"), missing, f"{tmp_path}/cp", trigger=None)
    try:
        failed.awaitTermination()
        raise AssertionError("the batch should have failed")
    except Exception as error:
        assert "silver_pending_review" in str(error)
    assert current_table(spark, missing.bronze).count() == len(MICRO_BATCH)
    assert current_table(spark, missing.silver).count() == 0
    create_layers(spark, missing, location=f"{tmp_path}/lake2")
    start_pipeline(file_stream(spark, f"{tmp_path}/in"), missing, f"{tmp_path}/cp", trigger=None).awaitTermination()
    assert current_table(spark, missing.bronze).count() == len(MICRO_BATCH)
    assert {r["order_id"] for r in current_table(spark, missing.silver).collect()} == SOUND | REPAIRED
    assert {r["order_id"] for r in current_table(spark, missing.pending).collect()} == HELD


def test_unreadable_payloads_and_blank_ids_are_all_kept(spark, tmp_path, layers):
    for part in (["{a", "{b", "{a"], ["{a", "{c"]):
        spark.createDataFrame([(p.encode(),) for p in part], "value binary").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        for checkpoint in ("cp", f"again{len(part)}"):
            raw = file_stream(spark, f"{tmp_path}/in", "value binary", position=True)
            start_pipeline(decode_events(raw, origin=True), layers, f"{tmp_path}/{checkpoint}", trigger=None).awaitTermination()
    kept = sorted(r["payload"] for r in current_table(spark, layers.pending).collect())
    assert kept == ["{a", "{a", "{a", "{b", "{c"]


def test_rows_with_the_same_ids_are_all_kept(spark, layers, events):
    rows = [("9", "", f"c{k}", "s", "2031-01-01 00:00:00", "1") for k in range(3)]
    run(spark, layers, events(*rows, rows[0]), 0)
    run(spark, layers, events(*rows, ("9", "", "c9", "s", "2031-01-01 00:00:00", "1")), 1)
    assert sorted(r["customer_id"] for r in current_table(spark, layers.pending).collect()) == ["c0", "c1", "c2", "c9"]


def test_expectations_ride_on_the_write(spark, layers, events):
    heard, jobs = [], spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("expectations", "")
    run(spark, layers, events(("1", "o", "c", "", "2026-01-01 10:00:00", "-5"), *MICRO_BATCH), on_results=heard.append)
    with_results = len(jobs.getJobIdsForGroup("expectations"))
    spark.sparkContext.setJobGroup("plain", "")
    run(spark, layers, events(("2", "p", "c", "", "2026-01-01 10:00:00", "-5"), *MICRO_BATCH), 1)
    assert with_results <= len(jobs.getJobIdsForGroup("plain")) + 1  # the first batch also files its rows anew
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    rows = {(r["check"], r["column"]): (r["failed"], r["total"], r["success"]) for r in heard[0].collect()}
    assert rows == {("not_null", "order_id"): (0, 5, True), ("at_least_0", "parsed_payment_value"): (1, 5, False)}


def test_publishing_a_stream_reads_it_once_and_counts_dead_letters(spark, events, tmp_path):
    inbox, alerts = f"{tmp_path}/in", []
    for part in (MICRO_BATCH[:3], MICRO_BATCH[3:], [("k09", None, None, "s", "", "1")]):
        events(*part).coalesce(1).write.mode("append").parquet(inbox)
        writers = [batch_file_writer(f"{tmp_path}/{name}") for name in ("main", "dead")]
        publish_stream(file_stream(spark, inbox), *writers, f"{tmp_path}/cp", on_dead=alerts.append).awaitTermination()
    assert alerts == [2, 1]
    dead = spark.read.parquet(f"{tmp_path}/dead").collect()
    assert sorted(r["error"].split(": ")[1] for r in dead) == ["customer_id", "order_id,customer_id", "order_status"]
    assert spark.read.parquet(f"{tmp_path}/main").count() == 6
    # A batch that is repeated replaces its own files.
    shutil.rmtree(f"{tmp_path}/cp/commits")
    publish_stream(file_stream(spark, inbox), *writers, f"{tmp_path}/cp").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/main").count() + spark.read.parquet(f"{tmp_path}/dead").count() == 9


def timed_id(ms, n):
    stamp = f"{ms:012x}"
    return f"{stamp[:8]}-{stamp[8:]}-7abc-8def-{n:012}"


def test_redeliveries_are_dropped_within_the_watermark(spark, events, tmp_path):
    hour, inbox = 3_600_000, f"{tmp_path}/in"

    def row(at, n):
        return (timed_id(at, n), f"o{n}", "c", "s", "2031-03-09 08:15:00", "1")

    batches = [
        [row(hour, 1), row(hour, 1), row(hour, 2), ("plain", "o3", "c", "s", "2031-03-09 08:15:00", "1")],
        [row(hour, 1), row(hour + 60_000, 4)],  # again after a restart
        [row(5 * hour, 5)],
    ]
    for part in batches:
        events(*part).coalesce(1).write.mode("append").parquet(inbox)
        once = without_redeliveries(file_stream(spark, inbox), "30 minutes")
        assert once.columns == [*EVENT_FIELDS]
        writer = once.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True)
        writer.start(f"{tmp_path}/out").awaitTermination()
    assert sorted(r["order_id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["o1", "o2", "o3", "o4", "o5"]


def test_a_batch_is_read_once(spark, layers):
    read = spark.sparkContext.accumulator(0)

    def seen(row):
        read.add(1)
        return row

    rows = [(timed_id(k, k), f"o{k}", "c", "s", f"2031-03-{k % 9 + 1:02} 08:15:00", "1") for k in range(40)]
    process_batch(spark.createDataFrame(spark.sparkContext.parallelize(rows, 4).map(seen), EVENT_SCHEMA), 0, layers, stream_id="s")
    assert read.value == 40
    assert spark.table(layers.bronze).count() == spark.table(layers.silver).count() == 40
    process_batch(spark.createDataFrame([], EVENT_SCHEMA), 1, layers, stream_id="s")
    assert spark.table(layers.bronze).count() == 40


def test_the_state_of_redeliveries_lies_on_disk(spark, events, tmp_path):
    name, inbox = "spark.sql.streaming.stateStore.providerClass", f"{tmp_path}/in"
    before = spark.conf.get(name, None)
    spark.conf.unset(name)
    try:
        for k in range(2):
            events((timed_id(1, 1), "o1", "c", "s", "2031-03-09 08:15:00", "1")).write.mode("append").parquet(inbox)
            once = without_redeliveries(file_stream(spark, inbox))
            writer = once.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True)
            query = writer.start(f"{tmp_path}/out")
            query.awaitTermination()
            assert "rocksdb" in str(query.lastProgress["stateOperators"][0]["customMetrics"]).lower()
        assert spark.read.parquet(f"{tmp_path}/out").count() == 1
        spark.conf.set(name, "own")
        without_redeliveries(file_stream(spark, inbox))
        assert spark.conf.get(name) == "own"
    finally:
        spark.conf.unset(name)
        if before is not None:
            spark.conf.set(name, before)
