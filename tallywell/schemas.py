"""Column layouts of every record and table the pipeline touches."""

import json

from pyspark.sql import types as T

# Names, order and types of the event record, and of the columns the later layers add.
EVENT_FIELDS = (
    "ingest_id",
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "payment_value",
)
# Where a row came from: the payload that could not be read, as text, and its place in the source.
ORIGIN_FIELDS = ("payload", "source")
RAW_ORDER_FIELDS = ("order_id", "customer_id", "order_status", "order_purchase_timestamp")
RAW_PAYMENT_FIELDS = ("order_id", "payment_value")

MONEY = T.DecimalType(18, 2)


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType(), True) for name in names]


EVENT_SCHEMA = T.StructType(_strings(*EVENT_FIELDS))
RAW_ORDERS_SCHEMA = T.StructType(_strings(*RAW_ORDER_FIELDS))
RAW_PAYMENTS_SCHEMA = T.StructType(_strings(*RAW_PAYMENT_FIELDS))

# What tells a quarantined row from all others, and the day of its delivery, see ``operators.identity``.
IDENTITY_FIELDS = ("row_key", "arrival")

# The stream id and batch id are not business columns: they make a replayed append replace itself.
BRONZE_SCHEMA = T.StructType(
    [
        *EVENT_SCHEMA.fields,
        *_strings(*ORIGIN_FIELDS),
        T.StructField("ingested_at", T.TimestampType(), True),
        T.StructField("stream_id", T.StringType(), True),
        T.StructField("batch_id", T.LongType(), True),
        T.StructField("arrived_on", T.DateType(), True),
    ]
)

_CLASSIFIED = [
    *EVENT_SCHEMA.fields,
    T.StructField("parsed_payment_value", MONEY, True),
    T.StructField("created_date", T.DateType(), True),
    *_strings("validation_status"),
]

SILVER_SCHEMA = T.StructType(
    [
        *_CLASSIFIED,
        T.StructField("_is_remediated", T.BooleanType(), True),
        *_strings("_remediation_rule"),
    ]
)
PENDING_SCHEMA = T.StructType([*_CLASSIFIED, *_strings(*ORIGIN_FIELDS, *IDENTITY_FIELDS, "_status")])
AUDIT_SCHEMA = T.StructType(
    _strings(
        "order_id",
        "old_value",
        "new_value",
        "field_changed",
        "action",
        "reviewed_by",
        "reviewed_at",
    )
)
DAILY_REVENUE_SCHEMA = T.StructType(
    [
        T.StructField("revenue_date", T.DateType(), True),
        T.StructField("total_orders", T.LongType(), True),
        T.StructField("gross_revenue", T.DecimalType(28, 2), True),
        T.StructField("average_order_value", MONEY, True),
    ]
)
CUSTOMER_ACTIVITY_SCHEMA = T.StructType(
    [
        *_strings("customer_id"),
        T.StructField("first_purchase_date", T.DateType(), True),
        T.StructField("last_purchase_date", T.DateType(), True),
        T.StructField("total_orders", T.LongType(), True),
        T.StructField("total_spent", T.DecimalType(28, 2), True),
        *_strings("order_statuses"),
    ]
)
DECISION_SCHEMA = T.StructType(
    _strings("order_id", "ingest_id", "decision", "corrected_value", "reviewed_by", "reviewed_at", "row_key")
)
BAD_DECISION_SCHEMA = T.StructType([*DECISION_SCHEMA.fields, *_strings("reason")])


def event_avro_schema(record_name: str = "OrderTransaction") -> str:
    """Avro record of the event: one required string per field."""
    fields = [{"name": name, "type": "string"} for name in EVENT_FIELDS]
    return json.dumps({"type": "record", "name": record_name, "fields": fields})


def ddl(schema: T.StructType) -> str:
    """Column list of ``schema`` for a CREATE TABLE statement."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
