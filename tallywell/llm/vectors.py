"""Vectors of whole numbers, and inner products that are exact at any size."""

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import keep

#: Products of norms below this give sums that float64 holds exactly.
EXACT = float(1 << 52)
LEAST, LARGEST = -(1 << 63), (1 << 63) - 1


def whole_vectors(vectors: DataFrame, *columns: Column, scale: int = 256) -> DataFrame:
    """row, vec_id, v and ``columns``, kept: v is floor(scale * x) of each component of ``embedding``.

    ``row`` tells rows apart, also those that share a vec_id. Vectors that are null, or have a component that is null or not
    finite, also after scaling, are left out.
    """
    x = F.transform(F.col("embedding").cast("array<double>"), lambda c: c * scale)
    finite = x.isNotNull() & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    # A floor beyond a long is the number itself: a double of that size is whole.
    whole = F.transform(x, lambda c: F.when(F.abs(c) < EXACT, F.floor(c).cast("double")).otherwise(c))
    rows = vectors.filter(finite).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"), *columns)
    return keep(rows.select(F.monotonically_increasing_id().alias("row"), "*"), "vectors")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), width)


def norms(points: np.ndarray) -> np.ndarray:
    """Lengths; no vector's is lost to an overflow of its square."""
    largest = np.abs(points).max(axis=1, initial=0)
    safe = np.where(largest > 0, largest, 1)
    return largest * np.sqrt(((points / safe[:, None]) ** 2).sum(axis=1))


def exact_products(points: np.ndarray, query: np.ndarray) -> list[int]:
    """Inner products as Python integers."""
    q = [int(x) for x in query]
    return [sum(int(a) * b for a, b in zip(p, q)) for p in points]


def held(score: int) -> int:
    """The score as a long; what does not fit becomes the nearest long."""
    return min(max(score, LEAST), LARGEST)


def beyond(score: int) -> bytes | None:
    """What orders scores that are no longs, as bytes; None for a long."""
    if LEAST < score < LARGEST:
        return None
    size = (abs(score).bit_length() + 7) // 8
    key = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return key if score > 0 else bytes(255 - b for b in key)


def value(score: int, key: bytes | None) -> int:
    """The score that ``held`` and ``beyond`` stand for."""
    if key is None:
        return score
    return int.from_bytes(key[4:], "big") if score > 0 else -int.from_bytes(bytes(255 - b for b in key[4:]), "big")


def best_first() -> list[Column]:
    """Rows by falling score, then by vec_id, rows without one last."""
    return [F.desc("score"), F.desc("beyond"), F.asc_nulls_last("vec_id"), F.asc("row")]


def top(scores: Sequence[int] | np.ndarray, ids: np.ndarray, missing: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: by falling score, then by id, missing ids last."""
    if isinstance(scores, np.ndarray):
        return np.lexsort([ids, missing, -scores])[:k]
    return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], missing[i], ids[i]))[:k], np.int64)
