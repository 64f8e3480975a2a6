"""From raw orders and payments to the event stream."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.functions import event_instant, time_ordered_id
from tallywell.operators.keyed import content_hash
from tallywell.operators.skew import lookup_join
from tallywell.schemas import EVENT_FIELDS

# What a missing field becomes, and the amount an injected business fault carries.
FIELD_DEFAULTS = {
    "order_id": "",
    "customer_id": "",
    "order_status": "",
    "order_purchase_timestamp": "",
    "payment_value": "0.00",
}
FAULTY_AMOUNT = "-150.75"

# Room for sub-cent parts, so only the total is rounded.
_PART = "decimal(30,6)"


def sum_payments(payments: DataFrame) -> DataFrame:
    """One row per order: ``paid`` as text with two decimals.

    Text that is no number counts as zero; ``_`` may group digits. A NaN or infinite payment, or one too
    large for an exact sum, makes the total 'nan', 'inf' or '-inf', which validation then rejects.
    """
    amount = F.replace(F.col("payment_value"), F.lit("_"), F.lit(""))
    as_double, exact = amount.try_cast("double"), amount.try_cast(_PART)
    infinite = F.lit(float("inf"))
    special = F.when(F.isnan(as_double) | (F.abs(as_double) == infinite), as_double).when(
        exact.isNull() & as_double.isNotNull(), F.signum(as_double) * infinite
    )
    totals = payments.groupBy("order_id").agg(
        F.try_sum(F.coalesce(exact, F.lit(0).cast(_PART))).alias("total"),
        F.sum(special).alias("special"),
    )
    totals = totals.withColumn("special", F.when(F.col("total").isNull(), F.coalesce("special", infinite)).otherwise(F.col("special")))
    text = (
        F.when(F.col("special").isNull(), F.round("total", 2).cast("decimal(38,2)").cast("string"))
        .when(F.isnan("special"), F.lit("nan"))
        .when(F.col("special") > 0, F.lit("inf"))
        .otherwise(F.lit("-inf"))
    )
    return totals.select("order_id", text.alias("paid"))


def join_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Every order with the text sum of its payments, '0.00' where there are none."""
    joined = lookup_join(orders, sum_payments(payments), "order_id")
    paid = F.coalesce(F.col("paid"), F.lit(FIELD_DEFAULTS["payment_value"]))
    return joined.withColumn("payment_value", paid).drop("paid")


def chronological(events: DataFrame) -> DataFrame:
    """Global sort by event time; rows without a readable time come first.

    The range partitioner cuts on all sort columns. After time and order come a content hash and a
    row number, so a moment shared by very many rows, or one row copied very often, still spreads
    over several tasks. Numbering follows a sort by content inside each task: a recomputed task
    gives equal rows the same set of numbers, so no copy is lost or doubled.
    """
    keyed = events.withColumns(
        {"__at": event_instant(F.col("order_purchase_timestamp")), "__tie": content_hash(events.columns)}
    )
    numbered = keyed.sortWithinPartitions("__tie").withColumn("__row", F.monotonically_increasing_id())
    order = [F.col("__at").asc_nulls_first(), F.col("order_id").asc_nulls_first(), F.col("__tie"), F.col("__row")]
    return numbered.orderBy(*order).drop("__at", "__tie", "__row")


def envelope(rows: DataFrame, epoch_ms: Column, identity: Sequence[Column] = ()) -> DataFrame:
    """The six event columns: a technical id per delivery, and a default for each absent field.

    ``epoch_ms`` is the delivery time; ``identity`` sets deliveries of one millisecond apart and
    defaults to the whole row.
    """
    identity = identity or [F.col(c) for c in rows.columns]
    fields = {
        name: F.coalesce(F.col(name).cast("string"), F.lit(default)) if name in rows.columns else F.lit(default)
        for name, default in FIELD_DEFAULTS.items()
    }
    fields["ingest_id"] = time_ordered_id(epoch_ms, *identity)
    return rows.select(*[fields[name].alias(name) for name in EVENT_FIELDS])


def inject_faults(
    events: DataFrame,
    structural_rate: float,
    business_rate: float,
    *,
    seed: int = 42,
    key: Column | None = None,
) -> DataFrame:
    """Damage a share of rows: order id lost, or status emptied / amount made negative.

    The draw is a hash of ``key`` (the ingest id by default) and the seed: the same rows are hit
    on every run and on every retry of a task.
    """
    key = F.col("ingest_id") if key is None else key
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f"|{seed}")))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))
    coin = F.substring(digest, 9, 1) < "8"
    structural = draw < structural_rate
    business = (draw >= structural_rate) & (draw < structural_rate + business_rate)
    return events.withColumns(
        {
            "order_id": F.when(~structural, F.col("order_id")),
            "order_status": F.when(business & coin, F.lit("")).otherwise(F.col("order_status")),
            "payment_value": F.when(business & ~coin, F.lit(FAULTY_AMOUNT)).otherwise(F.col("payment_value")),
        }
    )
