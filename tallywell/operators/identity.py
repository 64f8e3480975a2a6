"""Identity of quarantined rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.schemas import EVENT_FIELDS, ORIGIN_FIELDS

ROW_KEY = ("row_key",)
_TIMED_ID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-7"


def row_key() -> Column:
    """128 bits of a hash of the whole row, as text: rows that share their ids but differ in anything have keys of their own.

    A readable row has no origin, so that it keeps its key when it is delivered again at another place.
    """
    fields = F.struct(*EVENT_FIELDS, *ORIGIN_FIELDS)
    return F.substring(F.sha2(F.to_json(fields, {"ignoreNullFields": "false"}), 256), 1, 32)


def arrival() -> Column:
    """The UTC day at which the row's id was made, as text. Rows whose id tells no time are dealt out by their key.

    Being a function of the row, a row that is delivered again is found where it was filed.
    """
    digits = F.concat(F.substring("ingest_id", 1, 8), F.substring("ingest_id", 10, 4))
    days = F.floor(F.conv(digits, 16, 10).cast("bigint") / 86_400_000).cast("int")
    day = F.date_add(F.lit("1970-01-01").cast("date"), days).cast("string")
    return F.when(F.col("ingest_id").rlike(_TIMED_ID), day).otherwise(F.concat(F.lit("key-"), F.substring("row_key", 1, 1)))


def with_identity(rows: DataFrame) -> DataFrame:
    return rows.withColumn("row_key", row_key()).withColumn("arrival", arrival())
