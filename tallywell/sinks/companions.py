"""Small tables kept along with a large one, so that a write costs what the batch costs and not what history does.

- **Key days**: in which partitions rows of a key may lie, by hash bucket of the key. An upsert looks its keys up here, in the
  buckets they fall into, instead of searching the table. An entry is written before the row it stands for and never taken
  back, so a row without one does not exist; one too many only adds a partition to the search.
- **Touched days**: the partitions that writes changed since they were last read. A change is logged before it is made and
  marked as done after it; who reads the log works on all entries and removes only those done.
- **Batches**: the day under which a stream's batch was filed, so that a replay finds its own rows.

A table names its companions in its properties, so every write through this library keeps them.
"""

import datetime
import uuid
from collections.abc import Collection, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.sources.tables import current_table

_PROPERTY = "tallywell.{}"
KEY_DAYS, TOUCHED, BATCHES = "key_days", "touched_days", "batches"
#: Batches of a stream that share a folder of the ledger.
LEDGER_BLOCK = 1000


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    prefix = _PROPERTY.format("")
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r["key"].removeprefix(prefix): r["value"] for r in rows if r["key"].startswith(prefix)}


def link(spark: SparkSession, table: str, **named: str | int) -> None:
    pairs = ", ".join(f"'{_PROPERTY.format(k)}' = '{v}'" for k, v in named.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def _columns_like(spark: SparkSession, table: str, names: Sequence[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in spark.table(table).schema}
    return ", ".join(f"`{n}` {types[n]}" for n in names)


def _create(spark: SparkSession, name: str, columns: str, provider: str, partitions: Sequence[str]) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider} PARTITIONED BY ({', '.join(partitions)})")


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


@dataclass(frozen=True)
class KeyDays:
    """Partitions by key. Its table has the columns key, those of the partition, and bucket."""

    spark: SparkSession
    table: str
    name: str
    key: str
    buckets: int

    @staticmethod
    def create(spark: SparkSession, table: str, name: str, key: str, buckets: int, provider: str) -> None:
        """Link ``table`` to its key days, built from the rows it has. The link comes last: it vouches for completeness."""
        if KEY_DAYS in properties(spark, table):
            return
        places = _partitions(spark, table)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        _create(spark, name, f"key string, {_columns_like(spark, table, places)}, bucket int", provider, ["bucket"])
        made = KeyDays(spark, table, name, key, buckets)
        made._append(current_table(spark, table).select(*made._entry(places)).distinct())
        link(spark, table, key_days=name, key_days_key=key, key_days_buckets=buckets)

    @staticmethod
    def of(spark: SparkSession, table: str) -> "KeyDays | None":
        known = properties(spark, table)
        if KEY_DAYS not in known:
            return None
        return KeyDays(spark, table, known[KEY_DAYS], known["key_days_key"], int(known["key_days_buckets"]))

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def _entry(self, places: Sequence[str]) -> list[Column]:
        return [F.col(self.key).cast("string").alias("key"), *map(F.col, places), self.bucket().alias("bucket")]

    def _append(self, entries: DataFrame) -> None:
        rows = entries.select(*self.spark.table(self.name).columns)
        rows.hint("rebalance", "bucket").write.insertInto(self.name)

    def partitions_of(self, source: DataFrame, places: Sequence[str], buckets: Collection[int]) -> list[tuple]:
        """The partitions that may hold a key of ``source``, whose keys fall into ``buckets``."""
        held = current_table(self.spark, self.name).filter(F.col("bucket").isin(*buckets))
        keys = source.select(F.col(self.key).cast("string").alias("asked"))
        found = held.join(keys, F.col("key").eqNullSafe(F.col("asked")), "left_semi")
        return [tuple(r) for r in found.select(*places).distinct().collect()]

    def add(self, source: DataFrame, places: Sequence[str], buckets: Collection[int]) -> None:
        """Enter the keys of ``source`` with their partitions, unless they are entered already."""
        held = current_table(self.spark, self.name).filter(F.col("bucket").isin(*buckets))
        held = held.select(F.struct("key", *places).alias("held"))
        entries = source.select(*self._entry(places)).distinct()
        self._append(entries.join(held, F.struct("key", *places).eqNullSafe(F.col("held")), "left_anti"))


@dataclass(frozen=True)
class TouchedDays:
    """Log of the days, values of one column, whose rows were changed."""

    spark: SparkSession
    name: str
    day: str

    @staticmethod
    def create(spark: SparkSession, table: str, name: str, day: str, provider: str) -> None:
        if TOUCHED in properties(spark, table):
            return
        _create(spark, name, f"{_columns_like(spark, table, [day])}, entry string, done boolean", provider, ["entry", "done"])
        link(spark, table, touched_days=name, touched_days_day=day)

    @staticmethod
    def of(spark: SparkSession, table: str) -> "TouchedDays | None":
        known = properties(spark, table)
        return TouchedDays(spark, known[TOUCHED], known["touched_days_day"]) if TOUCHED in known else None

    @contextmanager
    def changing(self, days: Collection):
        """Around a write that changes ``days``. If it fails, the days stay in the log as not done."""
        days = [d for d in days if d is not None]
        if not days:
            yield
            return
        entry = uuid.uuid4().hex
        kind = self.spark.table(self.name).schema[self.day].dataType.simpleString()
        rows = self.spark.createDataFrame([(d,) for d in days], f"{self.day} {kind}").coalesce(1)
        rows = rows.withColumns({"entry": F.lit(entry), "done": F.lit(False)})
        rows.select(*self.spark.table(self.name).columns).write.insertInto(self.name)
        yield
        self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS PARTITION (entry = '{entry}', done = true)")

    def read(self) -> tuple[list, list[str]]:
        """All days in the log, and its entries whose writes are done. Read it before the table."""
        done = []
        for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect():  # two for each write since the last removal
            spec = dict(part.split("=", 1) for part in r["partition"].split("/"))
            if spec["done"] == "true":
                done.append(spec["entry"])
        days = current_table(self.spark, self.name).select(self.day).distinct().collect()
        return sorted(r[0] for r in days), done

    def remove(self, entries: Sequence[str]) -> None:
        for first in range(0, len(entries), 200):
            specs = [f"PARTITION (entry = '{e}', done = {d})" for e in entries[first : first + 200] for d in ("true", "false")]
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {', '.join(specs)}")


@dataclass(frozen=True)
class Batches:
    """Ledger of the batches of each stream."""

    spark: SparkSession
    name: str

    @staticmethod
    def create(spark: SparkSession, table: str, name: str, provider: str) -> None:
        if BATCHES in properties(spark, table):
            return
        _create(spark, name, "batch_id bigint, arrived_on date, stream_id string, block bigint", provider, ["stream_id", "block"])
        link(spark, table, batches=name)

    @staticmethod
    def of(spark: SparkSession, table: str) -> "Batches | None":
        known = properties(spark, table)
        return Batches(spark, known[BATCHES]) if BATCHES in known else None

    def day_of(self, stream_id: str, batch_id: int) -> datetime.date | None:
        """The day the batch was filed under; None if it is new."""
        block = (F.col("stream_id") == stream_id) & (F.col("block") == batch_id // LEDGER_BLOCK)
        own = current_table(self.spark, self.name).filter(block).filter(F.col("batch_id") == batch_id)
        return own.agg(F.min("arrived_on").alias("day")).first()["day"]

    def enter(self, stream_id: str, batch_id: int, day: datetime.date) -> None:
        row = (batch_id, day, stream_id, batch_id // LEDGER_BLOCK)
        columns = "batch_id bigint, arrived_on date, stream_id string, block bigint"
        self.spark.createDataFrame([row], columns).coalesce(1).write.insertInto(self.name)
