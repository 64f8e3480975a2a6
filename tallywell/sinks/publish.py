"""Send events on: sound ones encoded to the main output, dead letters to their own."""

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywell.sources.codec import encode_events, split_structural

Writer = Callable[[DataFrame], object]
#: Writes the rows of a micro-batch, given with its number.
BatchWriter = Callable[[DataFrame, int], object]


def kafka_writer(servers: str, topic: str, checkpoint: str | None = None) -> Writer:
    """Writes a ``value`` column to a topic. Streams need ``checkpoint``, and all need the connector."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}

    def write(df: DataFrame):
        if df.isStreaming:
            stream = df.writeStream.format("kafka").options(**options)
            return stream.option("checkpointLocation", checkpoint).start()
        return df.write.format("kafka").options(**options).save()

    return write


def file_writer(path: str, checkpoint: str | None = None) -> Writer:
    """Appends Parquet files to a folder."""

    def write(df: DataFrame):
        if df.isStreaming:
            stream = df.writeStream.format("parquet").option("path", path)
            return stream.option("checkpointLocation", checkpoint).start()
        return df.write.mode("append").parquet(path)

    return write


def publish_events(
    events: DataFrame, to_main: Writer, to_dead: Writer, codec: str = "json", on_dead: Callable[[int], object] | None = None
) -> tuple:
    """Returns what the two writers return: streaming queries for a stream.

    ``on_dead`` hears of the number of dead letters of a bounded input, if there are any.

    A bounded input is kept while both outputs are written, so that it is computed once.
    """
    keep = not events.isStreaming and not events.is_cached
    if keep:
        events.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sound, dead = split_structural(events)
        letters = dead.select(F.encode("payload", "UTF-8").alias("value"), "error")
        written = to_main(encode_events(sound, codec)), to_dead(letters)
        if on_dead is not None and not events.isStreaming and (number := letters.count()):
            on_dead(number)
        return written
    finally:
        if keep:
            events.unpersist()


def batch_file_writer(path: str) -> BatchWriter:
    """Parquet files in a folder for each batch: a batch that is repeated replaces its own."""

    def write(df: DataFrame, batch_id: int):
        return df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return write


def batch_kafka_writer(servers: str, topic: str) -> BatchWriter:
    """Writes a ``value`` column to a topic; a batch that is repeated is sent again."""

    def write(df: DataFrame, batch_id: int):
        return df.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return write


def publish_stream(
    events: DataFrame,
    to_main: BatchWriter,
    to_dead: BatchWriter,
    checkpoint: str,
    *,
    codec: str = "json",
    on_dead: Callable[[int], object] | None = None,
    trigger: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """One query that sends a stream's sound events and its dead letters on; ``trigger=None`` works off what is there.

    Both outputs are written from one reading of the source. Dead letters are counted as they are written, and ``on_dead``
    hears of the number in each batch that has any, once both outputs are written.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sound, dead = split_structural(kept)
            seen = Observation()
            letters = dead.select(F.encode("payload", "UTF-8").alias("value"), "error")
            to_main(encode_events(sound, codec), batch_id)
            to_dead(letters.observe(seen, F.count(F.lit(1)).alias("number")), batch_id)
            number = seen.get["number"]
        finally:
            kept.unpersist()
        if on_dead is not None and number:
            on_dead(number)

    writer = events.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()
