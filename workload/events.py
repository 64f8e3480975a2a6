"""Raw order events derived from the orders and lineitem tables.

Every order becomes one delivery, every seventh a second one with a later id and a higher amount
(every 21st also a day later). Faults are spread by order key. The CASE texts are valid in Spark
and in standard SQL, so that query and check read the same input.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.operators.ingest import join_payments
from tallywell.plans.ingest import priced_events

# Times of delivery of two publishing runs, in milliseconds.
FIRST_MS, SECOND_MS = 1_700_000_000_000, 1_700_000_060_000

DELIVERIES_CASE = "CASE WHEN o_orderkey % 7 = 0 THEN {two} ELSE {one} END"

FIELDS = {
    "ingest_id": "lpad(CAST(delivery * 1000000000000 + o_orderkey AS STRING), 16, '0')",
    "order_id": (
        "CASE WHEN o_orderkey % 101 = 0 THEN '' WHEN o_orderkey % 103 = 0 THEN NULL "
        "ELSE CAST(o_orderkey AS STRING) END"
    ),
    "customer_id": "CASE WHEN o_orderkey % 107 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END",
    "order_status": (
        "CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 97 = 0 THEN '   ' "
        "WHEN o_orderkey % 109 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'delivered' "
        "WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'processing' END"
    ),
    "order_purchase_timestamp": (
        "CASE WHEN o_orderkey % 71 = 0 THEN '' WHEN delivery = 2 AND o_orderkey % 21 = 0 "
        "THEN CAST(o_orderdate + INTERVAL '1' DAY AS STRING) ELSE CAST(o_orderdate AS STRING) END"
    ),
    "payment_value": (
        "CASE WHEN o_orderkey % 13 = 0 THEN concat('-', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)) "
        "WHEN o_orderkey % 83 = 0 THEN 'NaN' WHEN o_orderkey % 89 = 0 THEN 'abc' "
        "ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 10 * (delivery - 1) AS STRING) END"
    ),
}

# Payments: one line item, one payment; some are not readable, not finite, grouped, with exponents or very large.
PAYMENT_TEXT = (
    "CASE WHEN l_orderkey % 59 = 0 AND l_linenumber = 1 THEN 'n/a' "
    "WHEN l_orderkey % 601 = 0 AND l_linenumber = 2 THEN 'NaN' "
    "WHEN l_orderkey % 67 = 0 AND l_linenumber = 1 THEN '1_000.5' "
    "WHEN l_orderkey % 73 = 0 AND l_linenumber = 1 THEN '12.5e2' "
    "WHEN l_orderkey % 97 = 0 AND l_linenumber = 1 THEN '1e19' "
    "WHEN l_orderkey % 401 = 0 AND l_linenumber = 1 THEN '-1e40' "
    "ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_events(orders: DataFrame, delivery: int | None = None) -> DataFrame:
    """Deliveries of each order as event rows, all of them or one; works on streams as well.

    What all deliveries share is computed once per order, the rest inside the generator, whose
    output no later filter is rewritten into.
    """
    varying = {n: sql for n, sql in FIELDS.items() if "delivery" in sql}
    shared = [f"{sql} AS {n}" for n, sql in FIELDS.items() if n not in varying]

    def row(number: int) -> str:
        at = f"CAST({number} AS BIGINT)"
        return "struct(" + ", ".join(f"{sql.replace('delivery', at)} AS {n}" for n, sql in varying.items()) + ")"

    one, two = row(1), row(2)
    if delivery is None:
        rows = DELIVERIES_CASE.format(two=f"array({one}, {two})", one=f"array({one})")
    elif delivery == 1:
        rows = f"array({one})"
    else:
        rows = DELIVERIES_CASE.format(two=f"array({two})", one="NULL")
    return orders.selectExpr("*", *shared).selectExpr(*FIELDS.keys() - varying.keys(), f"inline({rows})").select(*FIELDS)


def raw_events(spark: SparkSession, sf_dir: str, delivery: int | None = None) -> DataFrame:
    return as_events(table(spark, sf_dir, "orders"), delivery)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS order_id",
        "CAST(o_custkey AS STRING) AS customer_id",
        "o_orderstatus AS order_status",
        "CAST(o_orderdate AS STRING) AS order_purchase_timestamp",
    )


def republished_events(spark: SparkSession, sf_dir: str, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Two publishes of all orders at one purchase time each: first as processing, later as they are.

    Who reads them more than once names a ``folder``, in which the orders and their payments are kept, so that they are joined once.
    """
    priced = join_payments(raw_orders(spark, sf_dir), raw_payments(spark, sf_dir))
    if folder is not None:
        priced.write.parquet(folder)
        priced = spark.read.schema(priced.schema).parquet(folder)
    early = priced_events(priced.withColumn("order_status", F.lit("processing")), delivered_at=F.lit(FIRST_MS))
    return early, priced_events(priced, delivered_at=F.lit(SECOND_MS))


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS order_id", f"{PAYMENT_TEXT} AS payment_value"
    )
