"""Redeliveries dropped ahead of the sinks."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.operators.identity import row_key
from tallywell.sources.codec import with_origin


_STATE = "spark.sql.streaming.stateStore"
#: The state store on local disk, with bounded memory for all its partitions in an executor. The one that Spark takes by default
#: holds all keys as objects in memory.
STATE_STORE = {
    "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "rocksdb.boundedMemoryUsage": "true",
    "rocksdb.trackTotalNumberOfRows": "false",
}


def keep_state_on_disk(spark: SparkSession) -> None:
    """Streams started from now on keep their state in STATE_STORE, unless the session names a state store of its own. A stream that
    has a checkpoint goes on with the one it was started with."""
    if spark.conf.get(f"{_STATE}.providerClass", None) is None:
        for name, value in STATE_STORE.items():
            spark.conf.set(f"{_STATE}.{name}", value)


def delivery_time() -> Column:
    """The time at which a time-ordered id was made; NULL for other ids."""
    digits = F.concat(F.substring("ingest_id", 1, 8), F.substring("ingest_id", 10, 4))
    timed = F.col("ingest_id").rlike(r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-7")
    return F.when(timed, F.timestamp_millis(F.conv(digits, 16, 10).cast("bigint")))


def without_redeliveries(
    events: DataFrame, within: str = "1 hour", at: Column | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """A stream's events, each once among those delivered up to ``within`` of each other.

    Events are told apart by ``keys``, by default by all they hold. ``at`` is an event's time, by default that of its id. The
    state store holds the keys of the last ``within`` only, and survives a restart from the checkpoint. Events that come later
    than ``within`` behind the newest are dropped as too late to tell, those without a time are passed on as they are; the
    sinks merge by key and stay right without this step, which spares them the work.
    """
    keep_state_on_disk(events.sparkSession)
    rows = with_origin(events).withColumn("__at", delivery_time() if at is None else at)
    rows = rows.withColumn("__key", F.to_json(F.struct(*keys)) if keys else row_key())
    timed = rows.filter(F.col("__at").isNotNull()).withWatermark("__at", within).dropDuplicatesWithinWatermark(["__key"])
    return timed.unionByName(rows.filter(F.col("__at").isNull())).select(*events.columns)
