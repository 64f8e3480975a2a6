"""Events as encoded payloads, and the split that keeps unencodable ones out.

Two codecs: ``json`` works everywhere, ``avro`` (schemaless binary records) needs the spark-avro
module on the class path.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.schemas import EVENT_FIELDS, EVENT_SCHEMA, ORIGIN_FIELDS, event_avro_schema

CODECS = ("json", "avro")
CORRUPT = "_corrupt_record"


def _check(codec: str) -> None:
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}, not {codec!r}")


def decode_events(
    raw: DataFrame, column: str = "value", codec: str = "json", keep_corrupt: bool = False, origin: bool = False
) -> DataFrame:
    """Binary or text payload to the six event columns.

    An unreadable payload becomes a row of NULLs, which routing sends to quarantine; it never fails
    the batch. ``keep_corrupt`` adds the payload of such rows (as text for JSON, base64 for Avro).
    ``origin`` adds it as ``payload``, and with ``source`` the place of every row: topic, partition and
    offset, or what the source column of a file stream says.
    """
    _check(codec)
    payload = F.col(column)
    if codec == "avro":
        from pyspark.sql.avro.functions import from_avro

        data = from_avro(payload, event_avro_schema(), {"mode": "PERMISSIVE"})
        bad = F.base64(payload)
    else:
        data = F.from_json(payload.cast("string"), EVENT_SCHEMA, {"mode": "PERMISSIVE"})
        bad = payload.cast("string")
    decoded = raw.select(data.alias("data"), bad.alias("payload"), _place(raw).alias("source"))
    columns = [F.col(f"data.{name}").alias(name) for name in EVENT_FIELDS]
    nothing = reduce(lambda a, b: a & b, [F.col(f"data.{n}").isNull() for n in EVENT_FIELDS])
    if keep_corrupt:
        columns.append(F.when(nothing, F.col("payload")).alias(CORRUPT))
    if origin:
        columns += [F.when(nothing, F.coalesce("payload", F.lit(""))).alias("payload"), F.col("source")]
    return decoded.select(*columns)


def with_origin(events: DataFrame) -> DataFrame:
    """Events with the origin columns, NULL where the source does not tell."""
    missing = {name: F.lit(None).cast("string") for name in ORIGIN_FIELDS if name not in events.columns}
    return events.withColumns(missing) if missing else events


def _place(raw: DataFrame) -> Column:
    if {"topic", "partition", "offset"} <= set(raw.columns):
        return F.concat_ws(":", "topic", "partition", "offset")
    return F.col("source") if "source" in raw.columns else F.lit(None).cast("string")


def _json(fields=EVENT_FIELDS) -> Column:
    return F.to_json(F.struct(*[F.col(n) for n in fields]), {"ignoreNullFields": "false"})


def encode_events(events: DataFrame, codec: str = "json") -> DataFrame:
    """The six event columns to one binary ``value`` column, as a Kafka sink takes it."""
    _check(codec)
    if codec == "avro":
        from pyspark.sql.avro.functions import to_avro

        record = F.struct(*[F.col(n).alias(n) for n in EVENT_FIELDS])
        return events.select(to_avro(record, event_avro_schema()).alias("value"))
    return events.select(F.encode(_json(), "UTF-8").alias("value"))


def _missing_fields() -> Column:
    return F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in EVENT_FIELDS]))


def split_structural(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events every codec can encode, dead letters).

    Each field is required. A dead letter is the event as JSON text, NULLs written out, with the
    reason. Both halves are filters of one input and keep streaming inputs streaming.
    """
    broken = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in EVENT_FIELDS])
    dead = events.filter(broken).select(
        _json().alias("payload"),
        F.concat(F.lit("required field is null: "), F.array_join(_missing_fields(), ",")).alias("error"),
    )
    return events.filter(~broken), dead
