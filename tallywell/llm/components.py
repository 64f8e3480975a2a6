"""Connected components by alternating large and small stars, over tables in the shared folder."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import keep, release


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node it is connected with) of each node of ``links`` (a, b) that is not its own root.

    Each round sends, for every node, its larger neighbours to its smallest one, and then its smaller neighbours
    likewise. Smallest neighbours are found by partial sums, and a node with very many neighbours meets them in a join
    that can be split, so no task needs a node's neighbours together. Rounds follow the logarithm of the longest path.
    """
    pairs = keep(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "stars"
    )
    before, now = None, _state(pairs)
    while now[0] and now != before:
        both = pairs.union(pairs.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, pairs = pairs, keep(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        release(last)
        before, now = now, _state(pairs)
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
