"""Header CSV files as text columns."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.schemas import RAW_ORDER_FIELDS, RAW_PAYMENT_FIELDS

_BOM = "﻿"


def read_csv_text(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    *,
    multi_line: bool = False,
) -> DataFrame:
    """Columns by header name, all text; an empty cell is '' and not NULL.

    Only the header line is read to plan the scan, and only ``columns`` are parsed. All files of a scan need the
    same columns in the same order; a file with another header fails it. Set
    ``multi_line`` when quoted cells hold line breaks: files then cannot be split between tasks.
    """
    raw = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .csv(path)
    )
    raw = raw.toDF(*[name.removeprefix(_BOM) for name in raw.columns])
    names = list(columns) if columns is not None else raw.columns
    return raw.select(*[F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names])


def read_raw_orders(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv_text(spark, path, RAW_ORDER_FIELDS)


def read_raw_payments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv_text(spark, path, RAW_PAYMENT_FIELDS)
