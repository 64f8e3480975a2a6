"""Row-level writes.

On a table format with row-level operations these are MERGE and DELETE. On plain file tables they
rewrite exactly the partitions that hold an affected row, and append everything else:

1. the partitions that can hold a match are looked up by key (``KeyDays``), or else all are searched; their number bounds
   what the driver sees,
2. rows for partitions without a match are appended,
3. partitions with a match are overwritten, emptied ones dropped.

Appending first means an interrupted write can leave a row twice, never lose it, and repeating the
write settles it. File tables replace a partition by delete and rename, so a driver that dies in
that step needs the format with row-level operations to be safe.
"""

import datetime
import re
from collections.abc import Collection, Mapping, Sequence
from contextlib import nullcontext

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.operators.keyed import accepted_rows, delete_rows, join_on_keys, rows_absent_from, upsert
from tallywell.sinks.companions import Batches, KeyDays, TouchedDays
from tallywell.sinks.layers import FILE_FORMATS
from tallywell.sources.codec import with_origin
from tallywell.sources.tables import current_table

#: What one task of a write that makes many files should write.
FILES_PER_TASK, ROWS_PER_TASK = 64, 2_000_000


def provider_of(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Provider'").collect()
    return rows[0]["data_type"].lower() if rows else "parquet"


def supports_row_level(spark: SparkSession, table: str) -> bool:
    return provider_of(spark, table) not in FILE_FORMATS


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _clustered(df: DataFrame, partitions: Sequence[str], sizes: Mapping[tuple, int] | None = None) -> DataFrame:
    """Bring rows of one partition together, so that a write makes few files.

    REBALANCE lets adaptive execution split a partition that is too big for one task and merge small
    ones, by measured size. That counts bytes only: thousands of small partitions would all be written, file by file, by one
    task. So where ``sizes``, the rows of each partition, has more of them than a task should write, they are dealt out to as
    many tasks as the files and rows ask for, and a partition with more rows than a task should write goes to several.
    """
    if sizes is None or len(sizes) <= FILES_PER_TASK:
        return df.hint("rebalance", *[F.col(p) for p in partitions])
    tasks = max(-(-len(sizes) // FILES_PER_TASK), -(-sum(sizes.values()) // ROWS_PER_TASK))
    # No more of them than rows make up tasks.
    large = {value: -(-n // ROWS_PER_TASK) for value, n in sizes.items() if n > ROWS_PER_TASK}
    part = F.lit(0).cast("long")
    by_parts: dict[int, list[tuple]] = {}
    for value, parts in large.items():
        by_parts.setdefault(parts, []).append(value)
    for parts, values in by_parts.items():
        here = F.coalesce(F.expr(_among(df, partitions, values)), F.lit(False))
        part = F.when(here, F.pmod(F.xxhash64(*df.columns), F.lit(parts))).otherwise(part)
    return df.repartition(tasks, *[F.col(p) for p in partitions], part)


def _insert(df: DataFrame, table: str, *, overwrite: bool = False, sizes: Mapping[tuple, int] | None = None) -> None:
    spark = df.sparkSession
    if overwrite:
        require_dynamic_overwrite(spark, table)
    rows = df.select(*spark.table(table).columns)
    _clustered(rows, partition_columns(spark, table), sizes).write.insertInto(table, overwrite=overwrite)


def require_dynamic_overwrite(spark: SparkSession, table: str) -> None:
    """Fail if overwriting some partitions of ``table`` would empty the others."""
    if spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic":
        return
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Storage Properties'").collect()
    if not any("partitionoverwritemode=dynamic" in r["data_type"].lower() for r in about):
        raise ValueError(
            f"{table} has neither the option partitionOverwriteMode=dynamic nor does the session: an overwrite would "
            "remove all other partitions"
        )


def append_batch(events: DataFrame, table: str, stream_id: str, batch_id: int) -> None:
    """Append a micro-batch with its time and day of arrival; appending the same batch again replaces it.

    The ledger of batches says under which day a batch was filed. A new one is a plain append. A replayed one goes to the same
    day, whose partition is rewritten without the batch's earlier rows, if there are any.
    """
    stamped = with_origin(events).withColumns(
        {
            "ingested_at": F.current_timestamp(),
            "stream_id": F.lit(stream_id),
            "batch_id": F.lit(batch_id).cast("bigint"),
        }
    )
    spark = events.sparkSession
    same = (F.col("stream_id") == stream_id) & (F.col("batch_id") == batch_id)
    ledger = Batches.of(spark, table)
    known = ledger.day_of(stream_id, batch_id) if ledger else None
    day = known or datetime.datetime.now(datetime.UTC).date()
    columns = spark.table(table).columns
    if "arrived_on" in columns:
        stamped = stamped.withColumn("arrived_on", F.lit(day))
    if supports_row_level(spark, table):
        stamped.select(*columns).writeTo(table).overwrite(same)
        return
    # All rows fall into one partition: nothing to cluster, and no shuffle.
    rows = stamped.select(*columns)
    if ledger is None:
        require_dynamic_overwrite(spark, table)
        rows.write.insertInto(table, overwrite=True)
        return
    if known is None:
        ledger.enter(stream_id, batch_id, day)
        rows.write.insertInto(table)
        return
    filed = current_table(spark, table).filter(F.col("arrived_on") == F.lit(day))
    if filed.filter(same).isEmpty():
        rows.write.insertInto(table)
        return
    require_dynamic_overwrite(spark, table)
    rows.unionByName(filed.filter(~same)).write.insertInto(table, overwrite=True)


def append_rows(rows: DataFrame, table: str) -> None:
    """Plain append in table layout; ``rows`` may read ``table``."""
    _insert(rows, table)


def append_absent(rows: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Append the rows whose key the table does not hold; repeating it adds nothing."""
    append_rows(rows_absent_from(rows, current_table(rows.sparkSession, table), keys), table)


def replace_table(df: DataFrame, table: str, provider: str = "parquet") -> None:
    """Full refresh: write a sibling table, then swap the names.

    ``df`` may read ``table``. Readers see the old table until the swap; a failed write leaves it
    untouched.
    """
    spark = df.sparkSession
    if provider not in FILE_FORMATS:
        df.writeTo(table).using(provider).createOrReplace()
        return
    fresh, old = f"{table}__next", f"{table}__old"
    _recover(spark, table, old)
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    df.write.saveAsTable(fresh, format=provider)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def _recover(spark: SparkSession, table: str, old: str) -> None:
    # An earlier swap stopped half way: put the old table back, or finish dropping it.
    if not spark.catalog.tableExists(old):
        return
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE {old}")
    else:
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")


def upsert_table(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    *,
    insert_only: bool = False,
    protect: str | None = None,
    newer_by: str | None = None,
    null_safe: bool = True,
    key_fixes_partition: bool = False,
    key_fixes: Sequence[str] = (),
) -> None:
    """Merge ``source``, which must hold each key once, into ``table``.

    A matching row may lie in another partition than its source row. It is looked up in the table's ``KeyDays`` if it has
    them for this key, else searched in the whole table. ``key_fixes`` names partition columns that the key determines, and
    limits the search to their values in ``source``; ``key_fixes_partition`` says so of all of them.
    """
    spark = source.sparkSession
    if insert_only:
        append_absent(source, table, keys)
        return
    if key_fixes_partition:
        key_fixes = partition_columns(spark, table)
    if supports_row_level(spark, table):
        _merge(source, table, keys, protect, newer_by, null_safe)
    else:
        _rewrite_partitions(source, table, keys, protect, newer_by, null_safe, key_fixes)


def _merge(source, table, keys, protect, newer_by, null_safe) -> None:
    same = "<=>" if null_safe else "="
    names = "|".join(re.escape(c) for c in source.columns)

    def of(side: str, key: str) -> str:
        return "(" + re.sub(rf"\b({names})\b", rf"{side}.\1", key) + ")"

    on = F.expr(" AND ".join(f"{of(table, k)} {same} {of('source', k)}" for k in keys))
    allowed = F.lit(True)
    if protect:
        held = current_table(source.sparkSession, table).filter(F.expr(protect))
        source = rows_absent_from(source, held, keys, null_safe=null_safe)
    if newer_by:
        behind = F.expr(f"source.{newer_by} >= {table}.{newer_by}")
        allowed = F.coalesce(behind, F.lit(True))
    merge = source.alias("source").mergeInto(table, on)
    log = TouchedDays.of(source.sparkSession, table)
    days: list = []
    if log is not None:
        target = current_table(source.sparkSession, table)
        replaced = join_on_keys(target, source, keys, "left_semi", null_safe=null_safe).select(log.day)
        days = [r[0] for r in replaced.unionByName(source.select(log.day)).distinct().collect()]
    with log.changing(days) if log else nullcontext():
        merge.whenMatched(allowed).updateAll().whenNotMatched().insertAll().merge()


def _literal(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _among(table: DataFrame, partitions: Sequence[str], values: Collection[tuple]) -> str:
    """SQL filter for "in one of these partitions", in a form that prunes the scan."""
    types = [table.schema[p].dataType.simpleString() for p in partitions]
    if len(partitions) == 1:
        known = ", ".join(f"CAST({_literal(v)} AS {types[0]})" for (v,) in values if v is not None)
        tests = [f"`{partitions[0]}` IN ({known})"] if known else []
        tests += [f"`{partitions[0]}` IS NULL"] if (None,) in values else []
    else:
        tests = [
            " AND ".join(f"`{p}` <=> CAST({_literal(v)} AS {t})" for p, v, t in zip(partitions, value, types))
            for value in values
        ]
    return "(" + (" OR ".join(f"({t})" for t in tests) or "false") + ")"


def _drop_partitions(spark: SparkSession, table: str, partitions: Sequence[str], values: Sequence[tuple]) -> None:
    specs = [
        "PARTITION (" + ", ".join(f"`{c}` = {_literal(v)}" for c, v in zip(partitions, value)) + ")"
        for value in values
    ]
    for first in range(0, len(specs), 500):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs[first : first + 500])}")


def _rewrite_partitions(source, table, keys, protect, newer_by, null_safe, key_fixes) -> None:
    spark = source.sparkSession
    target = current_table(spark, table)
    partitions = partition_columns(spark, table)
    # The source is read several times; a caller that keeps it already is not made to keep it twice.
    given, own = source, not source.is_cached
    if own:
        given.persist(StorageLevel.MEMORY_AND_DISK)
    accepted = source = given.select(*target.columns)
    try:
        if not partitions:
            merged = upsert(target, source, keys, protect=protect, newer_by=newer_by, null_safe=null_safe)
            replace_table(merged, table, provider_of(spark, table))
            return
        index = KeyDays.of(spark, table)
        width = len(partitions)
        # One row for each partition that the batch has rows for.
        bucket = index.bucket() if index else F.lit(0)
        rows = source.groupBy(*partitions).agg(F.count(F.lit(1)).alias("n"), F.collect_set(bucket).alias("buckets")).collect()
        if not rows:
            return
        arriving = {tuple(r[:width]): r["n"] for r in rows}
        buckets = sorted({b for r in rows for b in r["buckets"]})
        searched = target
        if key_fixes:
            fixed = {tuple(value[partitions.index(c)] for c in key_fixes) for value in arriving}
            searched = target.filter(_among(target, key_fixes, fixed))
        if index and list(keys) == [index.key]:
            places = index.partitions_of(source, partitions, buckets)
            searched = searched.filter(_among(target, partitions, places)) if places else None
        if searched is not None and (protect or newer_by):
            accepted = accepted_rows(
                searched, source, keys, protect=protect, newer_by=newer_by, null_safe=null_safe
            ).persist(StorageLevel.MEMORY_AND_DISK)
            counts = accepted.groupBy(*partitions).agg(F.count(F.lit(1)).alias("n")).collect()
            arriving = {tuple(r[:width]): r["n"] for r in counts}
        left_over = _left_over(searched, accepted, keys, partitions, null_safe) if searched is not None else {}
        inside = f"coalesce({_among(target, partitions, left_over)}, false)"

        log = TouchedDays.of(spark, table)
        changed = {value[partitions.index(log.day)] for value in {**arriving, **left_over}} if log else ()
        if index:
            index.add(accepted, partitions, buckets)
        with log.changing(changed) if log else nullcontext():
            added = {p: n for p, n in arriving.items() if p not in left_over}
            if added:
                _insert(accepted.filter(f"NOT {inside}"), table, sizes=added)
            rewritten = {p: n + arriving.get(p, 0) for p, n in left_over.items() if n + arriving.get(p, 0)}
            if rewritten:
                kept = target.filter(_among(target, partitions, rewritten))
                kept = rows_absent_from(kept, accepted, keys, null_safe=null_safe)
                _insert(kept.unionByName(accepted.filter(inside)), table, overwrite=True, sizes=rewritten)
            _drop_partitions(spark, table, partitions, [p for p in left_over if p not in rewritten])
    finally:
        if accepted is not source:
            accepted.unpersist()
        if own:
            given.unpersist()


def _left_over(searched, accepted, keys, partitions, null_safe) -> dict[tuple, int]:
    """The partitions that hold a row to be replaced, with the number of their other rows."""
    marked = join_on_keys(searched, accepted, keys, "left", keep=[F.lit(True).alias("__hit")], null_safe=null_safe)
    touched = (
        marked.groupBy(*partitions)
        .agg(F.count(F.lit(1)).alias("total"), F.count("__hit").alias("hits"))
        .filter("hits > 0")
        .collect()
    )
    return {tuple(r[: len(partitions)]): r["total"] - r["hits"] for r in touched}


def delete_from_table(spark: SparkSession, table: str, where: str) -> int:
    """Delete the rows for which ``where`` is TRUE; returns their number."""
    target = current_table(spark, table)
    hit = F.coalesce(F.expr(where), F.lit(False))
    partitions = partition_columns(spark, table)
    row_level = supports_row_level(spark, table)
    log = TouchedDays.of(spark, table)
    if not partitions:
        doomed = target.filter(hit).count()
        days = [r[0] for r in target.filter(hit).select(log.day).distinct().collect()] if log and doomed else []
        with log.changing(days) if log else nullcontext():
            if doomed and row_level:
                spark.sql(f"DELETE FROM {table} WHERE {where}")
            elif doomed:
                replace_table(delete_rows(target, where), table, provider_of(spark, table))
        return doomed
    touched = (
        target.groupBy(*partitions)
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(hit).alias("hits"))
        .filter("hits > 0")
        .collect()
    )
    width = len(partitions)
    left_over = {tuple(r[:width]): r["total"] - r["hits"] for r in touched}
    changed = {value[partitions.index(log.day)] for value in left_over} if log else ()
    with log.changing(changed) if log else nullcontext():
        if row_level:
            if touched:
                spark.sql(f"DELETE FROM {table} WHERE {where}")
            return sum(r["hits"] for r in touched)
        rewritten = {p: n for p, n in left_over.items() if n}
        if rewritten:
            kept = delete_rows(target.filter(_among(target, partitions, rewritten)), where)
            _insert(kept, table, overwrite=True, sizes=rewritten)
        _drop_partitions(spark, table, partitions, [p for p in left_over if p not in rewritten])
    return sum(r["hits"] for r in touched)
