"""Data-quality results as rows: expectations on a batch, contracts on tables."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _as_rows(totals: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One row of totals to one row per entry of ``rows``."""
    structs = [F.struct(*[c.alias(name) for name, c in row.items()]) for row in rows]
    return totals.select(F.inline(F.array(*structs)))


@dataclass(frozen=True)
class Expectation:
    name: str
    column: str
    failing: Column


def not_null(column: str) -> Expectation:
    return Expectation("not_null", column, F.col(column).isNull())


def at_least(column: str, minimum) -> Expectation:
    """NULL passes."""
    return Expectation(f"at_least_{minimum}", column, F.coalesce(F.col(column) < minimum, F.lit(False)))


def batch_expectations() -> list[Expectation]:
    """The advisory checks on rows about to enter the clean table."""
    return [not_null("order_id"), at_least("parsed_payment_value", 0)]


def expectation_results(df: DataFrame, expectations: Sequence[Expectation] | None = None) -> DataFrame:
    """One row per expectation: check, column, failed, total, success. A single aggregate pass."""
    checks = batch_expectations() if expectations is None else list(expectations)
    totals = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(e.failing).alias(f"f{i}") for i, e in enumerate(checks)],
    )
    return _as_rows(
        totals,
        [
            {
                "check": F.lit(e.name),
                "column": F.lit(e.column),
                "failed": F.col(f"f{i}"),
                "total": F.col("total"),
                "success": F.col(f"f{i}") == 0,
            }
            for i, e in enumerate(checks)
        ],
    )


def observed_expectations(
    df: DataFrame, expectations: Sequence[Expectation] | None = None
) -> tuple[DataFrame, Observation]:
    """The same rows, counted on their way to whatever reads them first; ``observed_results`` gives the outcome then."""
    checks = batch_expectations() if expectations is None else list(expectations)
    seen = Observation()
    counts = [F.count_if(e.failing).alias(f"f{i}") for i, e in enumerate(checks)]
    return df.observe(seen, F.count(F.lit(1)).alias("total"), *counts), seen


def observed_results(
    spark: SparkSession, seen: Observation, expectations: Sequence[Expectation] | None = None
) -> DataFrame:
    """What ``expectation_results`` gives, from the counts of a write that is done."""
    checks = batch_expectations() if expectations is None else list(expectations)
    got = seen.get
    rows = [(e.name, e.column, got[f"f{i}"], got["total"], got[f"f{i}"] == 0) for i, e in enumerate(checks)]
    return spark.createDataFrame(rows, "check string, column string, failed bigint, total bigint, success boolean")


def alert_messages(results: DataFrame) -> DataFrame:
    """One ``message`` per failed expectation; no rows when all is well."""
    text = F.format_string(
        "quality check %s(%s) failed for %d of %d rows", "check", "column", "failed", "total"
    )
    return results.filter(~F.col("success")).select(text.alias("message"))


@dataclass(frozen=True)
class Contract:
    """What a table promises: ``unique`` is its one key, ``not_null`` the columns always filled."""

    table: str
    unique: str
    not_null: tuple[str, ...]


# The contracts of the three published tables, 13 tests in all.
CONTRACTS = (
    Contract("silver_transactions", "order_id", ("order_id", "validation_status")),
    Contract(
        "daily_revenue",
        "revenue_date",
        ("revenue_date", "total_orders", "gross_revenue", "average_order_value"),
    ),
    Contract(
        "customer_activity",
        "customer_id",
        ("customer_id", "first_purchase_date", "last_purchase_date", "total_spent"),
    ),
)


def contract_failures(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows table, column, test, failures for one table, from one scan and one shuffle of its key.

    Grouping by the key serves the uniqueness test; the NULL counts ride along as partial sums. A
    ``unique`` failure is one duplicated value, a ``not_null`` failure one row.
    """
    per_key = df.groupBy(F.col(contract.unique).alias("key")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls{i}") for i, c in enumerate(contract.not_null)],
    )
    totals = per_key.agg(
        F.count_if(F.col("key").isNotNull() & (F.col("n") > 1)).alias("duplicates"),
        *[
            F.coalesce(F.sum(f"nulls{i}"), F.lit(0)).cast("bigint").alias(f"nulls{i}")
            for i in range(len(contract.not_null))
        ],
    )

    def row(column: str, test: str, failures: str) -> dict[str, Column]:
        return {
            "table": F.lit(contract.table),
            "column": F.lit(column),
            "test": F.lit(test),
            "failures": F.col(failures),
        }

    tests = [row(contract.unique, "unique", "duplicates")]
    tests += [row(c, "not_null", f"nulls{i}") for i, c in enumerate(contract.not_null)]
    return _as_rows(totals, tests)


def contract_results(
    frames: Mapping[str, DataFrame | None], contracts: Sequence[Contract] = CONTRACTS
) -> DataFrame:
    """Failures of every contract whose table is in ``frames``; a test passes at 0.

    Where the table is None, as it does not exist, all of its tests fail: ``failures`` is NULL, there is nothing to count.
    """
    there = [c for c in contracts if frames.get(c.table) is not None]
    if not there:
        raise ValueError(f"none of {[c.table for c in contracts]} is there")
    parts = [contract_failures(frames[c.table], c) for c in there]
    missing = [c for c in contracts if c.table in frames and frames[c.table] is None]
    if missing:
        rows = [(c.table, c.unique, "unique", None) for c in missing]
        rows += [(c.table, column, "not_null", None) for c in missing for column in c.not_null]
        parts.append(parts[0].sparkSession.createDataFrame(rows, "table string, column string, test string, failures bigint"))
    return reduce(DataFrame.unionByName, parts)
