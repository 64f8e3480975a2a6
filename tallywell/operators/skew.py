"""Left lookup join that no single key can overload."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on the text column ``key``, where ``right`` holds each key at most once.

    One join, and no job before it. Rows without a key match nothing: they are dealt out by their content instead of meeting in
    one task. A key of very many rows is split by adaptive execution, which measures the shuffled partitions and reads the
    other side's one row for each part. It does so only for a shuffle that stands right below the join; an aggregated ``right``
    is partitioned by its key already and would get none, so its key is written as an expression that hides that.
    """
    names = [c for c in right.columns if c != key]
    spread = F.when(F.col(key).isNull(), F.xxhash64(*left.columns)).otherwise(F.lit(0))
    own = left.withColumns({"__asked": F.coalesce(F.concat(F.lit("="), key), F.concat(F.lit("-"), spread.cast("string")))})
    other = right.filter(F.col(key).isNotNull()).select(F.concat(F.lit("="), key).alias("__held"), *names)
    return own.join(other, F.col("__asked") == F.col("__held"), "left").select(*left.columns, *names)
