"""Names and DDL of the medallion tables."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallywell import schemas
from tallywell.schemas import ddl
from tallywell.sinks.companions import Batches, KeyDays, TouchedDays
from tallywell.sources.tables import table_or_none

# Hash buckets of the orders' partitions; a batch reads those its orders fall into.
KEY_BUCKETS = 16

# Formats whose catalog has no MERGE/UPDATE/DELETE; the writes emulate them on partitions.
FILE_FORMATS = ("parquet", "orc", "avro", "csv", "json", "text")


@dataclass(frozen=True)
class Layers:
    """Qualified table names. ``prefix`` keeps several lakehouses apart in one catalog."""

    prefix: str = ""
    catalog: str | None = None

    def schema(self, name: str) -> str:
        own = f"{self.prefix}{name}"
        return f"{self.catalog}.{own}" if self.catalog else own

    @property
    def bronze(self) -> str:
        return f"{self.schema('bronze')}.bronze_transactions"

    @property
    def bronze_batches(self) -> str:
        return f"{self.schema('bronze')}.bronze_batches"

    @property
    def silver_keys(self) -> str:
        return f"{self.schema('silver')}.silver_key_days"

    @property
    def touched_days(self) -> str:
        return f"{self.schema('silver')}.silver_touched_days"

    @property
    def silver(self) -> str:
        return f"{self.schema('silver')}.silver_transactions"

    @property
    def pending(self) -> str:
        return f"{self.schema('silver')}.silver_pending_review"

    @property
    def audit(self) -> str:
        return f"{self.schema('silver')}.audit_log"

    @property
    def bad_decisions(self) -> str:
        return f"{self.schema('silver')}.bad_decisions"

    @property
    def daily_revenue(self) -> str:
        return f"{self.schema('gold_finance')}.daily_revenue"

    @property
    def customer_activity(self) -> str:
        return f"{self.schema('gold_marketing')}.customer_activity"

    def frames(self, spark: SparkSession) -> dict[str, DataFrame | None]:
        """Every table by its short name; None where it does not exist."""
        names = [self.bronze, self.silver, self.pending, self.audit, self.daily_revenue, self.customer_activity]
        return {n.rsplit(".", 1)[1]: table_or_none(spark, n) for n in names}


SCHEMA_NAMES = ("bronze", "silver", "gold_finance", "gold_marketing")


def create_table(spark: SparkSession, name: str, schema, provider: str, partitions: tuple[str, ...] = ()) -> None:
    """CREATE TABLE IF NOT EXISTS.

    File tables carry the dynamic-overwrite option themselves: replacing some partitions can then
    never empty the others, whatever the session is set to.
    """
    options = " OPTIONS (partitionOverwriteMode 'dynamic')" if provider in FILE_FORMATS and partitions else ""
    layout = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING {provider}{options}{layout}")


def create_layers(
    spark: SparkSession,
    layers: Layers | None = None,
    *,
    provider: str = "parquet",
    location: str | None = None,
    key_buckets: int = KEY_BUCKETS,
) -> Layers:
    """Create schemas and tables that do not exist yet; safe to repeat.

    ``provider`` is any installed table format. ``location`` places file tables under one folder,
    which must be on storage shared by the cluster. ``key_buckets`` deals out the orders of file tables; many orders want
    many, so that a small batch reads few.
    """
    layers = layers or Layers()
    for name in SCHEMA_NAMES:
        place = f" LOCATION '{location.rstrip('/')}/{layers.prefix}{name}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layers.schema(name)}{place}")
    for name, schema, partitions in (
        # By day of arrival: the number of partitions does not depend on that of batches.
        (layers.bronze, schemas.BRONZE_SCHEMA, ("arrived_on",)),
        (layers.silver, schemas.SILVER_SCHEMA, ("created_date",)),
        # By state, so that closing rows never rewrites closed ones, and by day of delivery, which a row's key fixes.
        (layers.pending, schemas.PENDING_SCHEMA, ("_status", "arrival")),
        (layers.audit, schemas.AUDIT_SCHEMA, ()),
        (layers.bad_decisions, schemas.BAD_DECISION_SCHEMA, ()),
    ):
        create_table(spark, name, schema, provider, partitions)
    TouchedDays.create(spark, layers.silver, layers.touched_days, "created_date", provider)
    if provider in FILE_FORMATS:
        Batches.create(spark, layers.bronze, layers.bronze_batches, provider)
        KeyDays.create(spark, layers.silver, layers.silver_keys, "order_id", key_buckets, provider)
    return layers
