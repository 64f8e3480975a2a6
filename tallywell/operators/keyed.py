"""Operators on a business key: newest row, upsert, update and delete as plain DataFrames.

Keys are SQL expressions, evaluated on both sides, so a computed key needs no extra column.
Joins here leave the strategy to the optimizer: it broadcasts a side only after measuring it.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def content_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of the columns; as hashing passes over NULLs, which are NULL is hashed as well."""
    return F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str], content: Sequence[str] | None = None
) -> DataFrame:
    """The row with the greatest ``newest`` per key.

    A hash of ``content`` (all columns by default) breaks ties, so a recomputed task picks the same
    survivor, and columns nobody reads later stay out of the shuffle. The ``= 1`` filter lets the
    planner keep one row per key in each map task already: a hot key costs no more than any other.
    """
    order = [F.col(c).desc_nulls_last() for c in newest]
    window = Window.partitionBy(*[F.expr(k) for k in keys]).orderBy(*order, F.col("__tie"))
    return (
        df.withColumn("__tie", content_hash(content or df.columns))
        .withColumn("__rank", F.row_number().over(window))
        .filter("__rank = 1")
        .drop("__rank", "__tie")
    )


def _key_columns(keys: Sequence[str], side: str) -> list[Column]:
    return [F.expr(k).alias(f"__{side}{i}") for i, k in enumerate(keys)]


def _keys_match(keys: Sequence[str], null_safe: bool) -> Column:
    pairs = [(F.col(f"__a{i}"), F.col(f"__b{i}")) for i in range(len(keys))]
    tests = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return reduce(lambda x, y: x & y, tests)


def join_on_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    *,
    keep: Sequence[Column] = (),
    unless: Column | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Join ``left`` with the columns ``keep`` of ``right``; ``unless`` narrows the match further."""
    a = left.select("*", *_key_columns(keys, "a"))
    b = right.select(*_key_columns(keys, "b"), *keep)
    match = _keys_match(keys, null_safe)
    joined = a.join(b, match if unless is None else match & unless, how)
    helpers = [f"__{side}{i}" for side in "ab" for i in range(len(keys))]
    return joined.drop(*helpers)


def rows_absent_from(left: DataFrame, right: DataFrame, keys: Sequence[str], *, null_safe: bool = True) -> DataFrame:
    return join_on_keys(left, right, keys, "left_anti", null_safe=null_safe)


def accepted_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    protect: str | None = None,
    newer_by: str | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Source rows allowed to replace their target row.

    ``protect`` is a predicate on target rows that must stay as they are. ``newer_by`` names a
    column by which a target row that is ahead of its source row stays. A source row without a
    match is always allowed.
    """
    if protect is None and newer_by is None:
        return source
    target_wins = F.lit(False)
    keep = []
    if protect is not None:
        keep.append(F.coalesce(F.expr(protect), F.lit(False)).alias("__protected"))
        target_wins = target_wins | F.col("__protected")
    if newer_by is not None:
        keep.append(F.col(newer_by).alias("__seen"))
        target_wins = target_wins | (F.col("__seen") > F.col(newer_by))
    if newer_by is None:
        target = target.filter(F.expr(protect))
    return join_on_keys(source, target, keys, "left_anti", keep=keep, unless=target_wins, null_safe=null_safe)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    insert_only: bool = False,
    protect: str | None = None,
    newer_by: str | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Target after merging ``source``, which must hold each key once."""
    if insert_only:
        return target.unionByName(rows_absent_from(source, target, keys, null_safe=null_safe))
    accepted = accepted_rows(
        target, source, keys, protect=protect, newer_by=newer_by, null_safe=null_safe
    )
    return rows_absent_from(target, accepted, keys, null_safe=null_safe).unionByName(accepted)


def update_columns(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str], where: str = "true"
) -> DataFrame:
    """Overwrite ``columns`` of the rows passing ``where`` whose key is in ``changes`` (each key once)."""
    keep = [F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in columns]]
    joined = join_on_keys(target, changes, keys, "left", keep=keep)
    hit = F.col("__hit") & F.expr(where)
    updated = {c: F.when(hit, F.col(f"__new_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(updated).select(*target.columns)


def delete_rows(df: DataFrame, where: str) -> DataFrame:
    """Rows for which ``where`` is not TRUE; NULL keeps the row, as in SQL DELETE."""
    return df.filter(~F.coalesce(F.expr(where), F.lit(False)))
