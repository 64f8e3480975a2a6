"""Gold models: revenue per day and activity per customer, and the views that publish them."""

import datetime
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.operators.keyed import upsert
from tallywell.schemas import CUSTOMER_ACTIVITY_SCHEMA, DAILY_REVENUE_SCHEMA, MONEY
from tallywell.sinks.companions import TouchedDays
from tallywell.sinks.layers import Layers
from tallywell.sinks.writes import replace_table, upsert_table
from tallywell.sources.tables import current_table

# The first day of all, the separator, and the label (Vietnamese: status
# information missing) shown for a repaired status.
FIRST_DAY = datetime.date(1970, 1, 1)
STATUS_SEPARATOR = ", "
MISSING_STATUS_LABEL = "Thiếu thông tin trạng thái"


def daily_revenue(silver: DataFrame, *, order_ids_unique: bool = False) -> DataFrame:
    """Distinct orders, revenue and average order value per day.

    The distinct count is planned as two aggregations, first by day and order, so a day that holds
    a large part of all rows is spread over tasks. With ``order_ids_unique`` (what an upsert on the
    order id guarantees) a plain count gives the same number, and only partial sums are shuffled.
    """
    counted = F.count("order_id") if order_ids_unique else F.count_distinct("order_id")
    return (
        silver.filter(F.col("created_date").isNotNull() & F.col("order_id").isNotNull())
        .filter(F.trim("order_id") != "")
        .groupBy(F.col("created_date").alias("revenue_date"))
        .agg(
            counted.alias("total_orders"),
            F.sum("parsed_payment_value").alias("gross_revenue"),
            F.avg("parsed_payment_value").cast(MONEY).alias("average_order_value"),
        )
    )


def revenue_cutoff(existing: DataFrame, lookback_days: int = 0) -> datetime.date:
    """First day the next increment recomputes: the newest published day, less the look-back.

    Returned as a value, not a subquery, so it prunes silver partitions when the scan is planned.
    """
    newest = existing.agg(F.coalesce(F.max("revenue_date"), F.lit(FIRST_DAY)).alias("day")).first()["day"]
    return newest - datetime.timedelta(days=lookback_days)


def daily_revenue_increment(
    silver: DataFrame, existing: DataFrame, *, lookback_days: int = 0, order_ids_unique: bool = False
) -> DataFrame:
    """Days to merge into ``existing``. Rows for days before the cutoff are not looked at."""
    cutoff = revenue_cutoff(existing, lookback_days)
    return daily_revenue(silver.filter(F.col("created_date") >= F.lit(cutoff)), order_ids_unique=order_ids_unique)


def daily_revenue_merged(
    silver: DataFrame, existing: DataFrame, *, lookback_days: int = 0, order_ids_unique: bool = False
) -> DataFrame:
    """``existing`` after the increment: recomputed days replace their row."""
    increment = daily_revenue_increment(
        silver, existing, lookback_days=lookback_days, order_ids_unique=order_ids_unique
    )
    return upsert(existing, increment, ["revenue_date"])


def customer_activity(silver: DataFrame, *, missing_label: str = MISSING_STATUS_LABEL) -> DataFrame:
    """First and last purchase, orders, spending and distinct statuses per customer.

    Grouped by customer and status first: that level is all fixed-width sums which combine before
    the shuffle, so a customer with very many rows reaches the second level as one row per status.
    """
    status = F.when(
        (F.col("order_status") == "UNKNOWN") & F.col("_is_remediated"), F.lit(missing_label)
    ).otherwise(F.col("order_status"))
    per_status = (
        silver.filter(
            F.col("customer_id").isNotNull() & F.col("order_id").isNotNull() & F.col("created_date").isNotNull()
        )
        .groupBy("customer_id", status.alias("status"))
        .agg(
            F.min("created_date").alias("first"),
            F.max("created_date").alias("last"),
            F.count("order_id").alias("orders"),
            F.sum("parsed_payment_value").alias("spent"),
        )
    )
    return per_status.groupBy("customer_id").agg(
        F.min("first").alias("first_purchase_date"),
        F.max("last").alias("last_purchase_date"),
        F.sum("orders").alias("total_orders"),
        F.sum("spent").cast("decimal(28,2)").alias("total_spent"),
        F.concat_ws(STATUS_SEPARATOR, F.array_sort(F.collect_set("status"))).alias("order_statuses"),
    )


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """Reporting view over files that may hold a key twice: the greatest value of each column."""
    others = [c for c in df.columns if c != key]
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.max(c).alias(c) for c in others])


def published_files(spark: SparkSession, folder: str, below: str = "data/*") -> DataFrame:
    """All Parquet files a table wrote, whichever snapshot they are from. Some formats keep them under ``data``; for the
    file tables of this library ``below`` is empty."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{below}".rstrip("/"))


def register_views(spark: SparkSession, daily: DataFrame, activity: DataFrame) -> None:
    one_row_per_key(daily, "revenue_date").createOrReplaceTempView("v_daily_revenue")
    one_row_per_key(activity, "customer_id").createOrReplaceTempView("v_customer_activity")


def create_views(spark: SparkSession, layers: Layers) -> None:
    """The same two views, kept in the catalog next to their tables."""
    for table, key, schema in (
        (layers.daily_revenue, "revenue_date", DAILY_REVENUE_SCHEMA),
        (layers.customer_activity, "customer_id", CUSTOMER_ACTIVITY_SCHEMA),
    ):
        home, name = table.rsplit(".", 1)
        columns = ", ".join(f"max({c}) AS {c}" for c in schema.fieldNames() if c != key)
        spark.sql(
            f"CREATE OR REPLACE VIEW {home}.v_{name} AS "
            f"SELECT {key}, {columns} FROM {table} WHERE {key} IS NOT NULL GROUP BY {key}"
        )


def revenue_of_days(silver: DataFrame, existing: DataFrame, days: Collection, *, order_ids_unique: bool = False) -> DataFrame:
    """``existing`` with the given days computed anew; days without orders go."""
    fresh = daily_revenue(silver.filter(F.col("created_date").isin(*days)), order_ids_unique=order_ids_unique)
    return existing.filter(~F.coalesce(F.col("revenue_date").isin(*days), F.lit(False))).unionByName(fresh)


def refresh_daily_revenue(
    spark: SparkSession,
    layers: Layers,
    *,
    full_refresh: bool = False,
    lookback_days: int | None = None,
    provider: str = "parquet",
    order_ids_unique: bool = False,
) -> None:
    """Incremental by default; builds the whole table on the first run and on ``full_refresh``.

    An increment computes exactly the days anew that batches, reviews and purges have touched since the last refresh, late
    ones included, so it ends as a full refresh would. ``lookback_days`` asks for the newest published day and so many days
    before it instead, whatever was touched; so does silver without a log of its days.

    ``order_ids_unique`` promises that silver holds each order once and saves the distinct count. A write that
    was interrupted can leave an order twice.
    """
    table = layers.daily_revenue
    log = TouchedDays.of(spark, layers.silver)
    # Read before silver is: what is done by now is in it.
    days, done = log.read() if log else ([], [])
    silver = current_table(spark, layers.silver)
    if full_refresh or not spark.catalog.tableExists(table):
        replace_table(daily_revenue(silver, order_ids_unique=order_ids_unique), table, provider)
    elif log is None or lookback_days is not None:
        increment = daily_revenue_increment(
            silver, current_table(spark, table), lookback_days=lookback_days or 0, order_ids_unique=order_ids_unique
        )
        upsert_table(increment, table, ["revenue_date"])
        return
    elif days:
        # One row for each day: the table is small whatever silver holds.
        existing = current_table(spark, table)
        replace_table(revenue_of_days(silver, existing, days, order_ids_unique=order_ids_unique), table, provider)
    if log:
        log.remove(done)


def refresh_customer_activity(spark: SparkSession, layers: Layers, *, provider: str = "parquet") -> None:
    replace_table(customer_activity(current_table(spark, layers.silver)), layers.customer_activity, provider)
