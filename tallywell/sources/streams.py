"""Unbounded sources."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.schemas import EVENT_SCHEMA


def kafka_options(
    servers: str,
    topic: str,
    max_offsets_per_trigger: int | None = None,
    starting_offsets: str = "earliest",
) -> dict[str, str]:
    """A batch takes all there is, unless ``max_offsets_per_trigger`` limits it."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, **limits) -> DataFrame:
    """Binary key/value records. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **limits)).load()


def file_stream(
    spark: SparkSession,
    directory: str,
    schema: T.StructType = EVENT_SCHEMA,
    *,
    file_format: str = "parquet",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    position: bool = False,
    **options,
) -> DataFrame:
    """Files arriving in a directory, oldest first; ``options`` go to the file format.

    ``position`` adds ``source``, the file and row each row comes from (Parquet files).
    """
    reader = spark.readStream.schema(schema).format(file_format).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(directory)
    if position:
        rows = rows.select("*", F.concat_ws("#", "_metadata.file_path", "_metadata.row_index").alias("source"))
    return rows
