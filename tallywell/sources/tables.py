"""Catalog tables: current content, and tables that may not exist yet."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Tasks for each core that list the folders of a table.
LISTINGS_PER_CORE = 4


def list_in_few_tasks(spark: SparkSession) -> None:
    """Let a task list many folders. By default each partition of a file table is a task of its own, whenever its files are listed;
    those are thousands of tasks that do next to nothing. A session that asks for fewer keeps its setting."""
    enough = LISTINGS_PER_CORE * spark.sparkContext.defaultParallelism
    if int(spark.conf.get(_LISTING)) > enough:
        spark.conf.set(_LISTING, str(enough))


def current_table(spark: SparkSession, name: str) -> DataFrame:
    """The table as it is now.

    A session keeps the file list of a file table it has read. A stream writes from a session of
    its own, so the list is dropped first, or rows of later batches would be missed.
    """
    list_in_few_tasks(spark)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    return current_table(spark, name) if spark.catalog.tableExists(name) else None


def rows_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The table, or no rows of ``schema`` before its first write. Other failures surface."""
    found = table_or_none(spark, name)
    return spark.createDataFrame([], schema) if found is None else found
