"""Inspection of all layers as one long table: layer, metric, key, value."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Layer order, the breakdown columns of each layer that has one, and the columns of its samples.
LAYERS = (
    "bronze_transactions",
    "silver_transactions",
    "silver_pending_review",
    "audit_log",
    "daily_revenue",
    "customer_activity",
)
BREAKDOWNS = {
    "silver_transactions": ("validation_status", "_is_remediated"),
    "silver_pending_review": ("_status",),
}
SAMPLE_COLUMNS = {
    "bronze_transactions": ("ingest_id", "order_id", "order_status", "payment_value", "ingested_at"),
    "silver_transactions": (
        "order_id",
        "parsed_payment_value",
        "validation_status",
        "_is_remediated",
        "_remediation_rule",
    ),
}


def breakdown(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count per combination of ``columns``."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))


def _long(layer: str, metric: str, df: DataFrame, key, value) -> DataFrame:
    return df.select(
        F.lit(layer).alias("layer"), F.lit(metric).alias("metric"), key.alias("key"), value.alias("value")
    )


def layer_report(layer: str, df: DataFrame) -> DataFrame:
    """Row count of a layer, and its breakdown where it has one, from one pass over its few columns."""
    columns = BREAKDOWNS.get(layer)
    if not columns:
        total = df.agg(F.count(F.lit(1)).alias("count"))
        return _long(layer, "rows", total, F.lit("all"), F.col("count"))
    label = F.concat_ws(
        "|", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("NULL"))) for c in columns]
    )
    # The total is summed from the breakdown, whose exchange is reused.
    counts = breakdown(df.select(label.alias("label")), ["label"])
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0).cast("bigint")).alias("count"))
    report = _long(layer, "rows", total, F.lit("all"), F.col("count"))
    return report.unionByName(_long(layer, "breakdown", counts, F.col("label"), F.col("count")))


def inspect_layers(spark: SparkSession, frames: Mapping[str, DataFrame | None]) -> DataFrame:
    """Report over the layers given. A layer that is None is reported as missing, not an error."""
    parts = []
    for layer in [*LAYERS, *[n for n in frames if n not in LAYERS]]:
        if layer not in frames:
            continue
        if frames[layer] is None:
            parts.append(_long(layer, "missing", spark.range(1), F.lit("all"), F.lit(None).cast("bigint")))
        else:
            parts.append(layer_report(layer, frames[layer]))
    return reduce(DataFrame.unionByName, parts)


def top_rows(df: DataFrame, by: str, n: int = 3) -> DataFrame:
    """The ``n`` rows greatest in ``by``; the other columns break ties."""
    rest = [c for c in df.columns if c != by]
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in rest]).limit(n)


def sample_rows(df: DataFrame, columns: Sequence[str], n: int = 3) -> DataFrame:
    """Any ``n`` rows; stops scanning as soon as it has them."""
    return df.select(*columns).limit(n)


def layer_sample(layer: str, df: DataFrame, n: int = 3) -> DataFrame:
    """A few rows of a layer, in the columns its report shows."""
    return sample_rows(df, SAMPLE_COLUMNS.get(layer, df.columns), n)
