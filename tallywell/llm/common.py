"""What several operators share: reading, results kept between steps, and texts as byte arrays.

Texts reach the tasks as Arrow batches. They are worked on in chunks of a few MB, so that the arrays
made on the way stay small whatever a batch holds; a single longer text is a chunk of its own.
"""

import ctypes
import gc
import os
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.sinks.workspace import shared_folder

CHUNK_BYTES = 1 << 20

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Odd multipliers of the hashes below; any odd 64-bit numbers do, but they have to stay the same.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import the library from where the driver has it, wherever they are started."""
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    root = str(Path(__file__).resolve().parents[2])
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str, by: str | None = None, **options) -> DataFrame:
    """The rows, written to the shared folder and read again: later steps neither repeat nor lose the work. ``options`` are
    those of the file format; rows of each value of ``by`` get a folder of their own.

    Shuffle files of the write are removed once it is done, as nothing reads them again.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path, partitionBy=by)
    finally:
        spark.conf.set(_CLEANUP, before)
    rows = spark.read.schema(df.schema).parquet(path)
    rows._kept_in = path
    return rows


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Rows go to Python workers at most so many at a time in what is written inside."""
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def release(*kept: DataFrame, part: str = "") -> None:
    """Remove what ``keep`` wrote, once nothing reads it any more, or only the folder ``part`` of it."""
    for rows in kept:
        spark = rows.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{rows._kept_in}/{part}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Return memory that Python, Arrow and the C library keep for later to the system, after a step that took much of it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text alone, typed; a null text counts as empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more
    )


def byte_array(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column's values, one after the other, and where each begins (one more at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def text_chunks(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of at most ``limit`` bytes of text (or one row), with their bytes and bounds."""
    for batch in batches:
        data, bounds = byte_array(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
            yield batch.slice(at, end - at), data[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at]
            at = end


def strings(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Values that lie in ``data`` one after the other, as an Arrow column; nothing is copied."""
    return pa.Array.from_buffers(
        kind or pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)]
    )


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... (lengths[0] of them), then those of the next, and so on."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def least_count(counts: DataFrame, most: int) -> int:
    """The least n so that at most ``most`` words have n or more. The driver gets a row for each power of two of n
    first, then those of one such range: a few thousand rows whatever the corpus."""
    sizes = {r.p: r["count"] for r in counts.groupBy(F.floor(F.log2("n")).alias("p")).count().collect()}
    held = 0
    for p in sorted(sizes, reverse=True):
        if held + sizes[p] > most:
            low, high = 1 << p, 1 << (p + 1)
            step = max(1, (high - low) // 1024)
            inside = counts.filter(F.col("n").between(low, high - 1)).groupBy(F.floor((F.col("n") - low) / step).alias("b")).count()
            for r in sorted(inside.collect(), key=lambda r: -r.b):
                if held + r["count"] > most:
                    return low + (r.b + 1) * step
                held += r["count"]
        held += sizes[p]
    return 2


# words -----------------------------------------------------------------------------------------

#: Space and \t \n \v \f \r, the white space that ends a word here.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of each text, and the number of the first word of each text (one more at the end)."""
    inside = ~SPACES[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    first[inner] = inside[inner]
    last[inner - 1] = inside[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def counted(parts: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of all parts and how often each occurs, counted part by part."""
    found = [np.unique(p, return_counts=True) for p in parts if len(p)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    values, place = np.unique(np.concatenate([v for v, _ in found]), return_inverse=True)
    return values, np.bincount(place, weights=np.concatenate([n for _, n in found])).astype(np.int64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the outcome depends on every bit of ``h`` (uint64)."""
    h = h ^ (h >> np.uint64(30))
    h *= _MIX_A
    h ^= h >> np.uint64(27)
    h *= _MIX_B
    h ^= h >> np.uint64(31)
    return h


_INVERSE = np.uint64(pow(int(_STEP), -1, 1 << 64))
_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * _STEP)
_powers: dict[np.uint64, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base^2, ... (n of them) modulo 2^64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(n + (n >> 1) + 16, base, np.uint64)
        known[0] = 1
        known = _powers[base] = np.multiply.accumulate(known)
    return known[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers(_STEP, len(data)), out=sums[1:])
    back = powers(_INVERSE, len(data) + 1)
    return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def run_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_STEP, len(values)), out=sums[1:])
    return mixed((sums[width:] - sums[:n]) * powers(_INVERSE, n))


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return h.view(np.int64)
