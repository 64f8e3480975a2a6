"""Sharding of documents by vector bin packing: bytes, tokens and rows of all shards are balanced together.

Equal texts are a group and stay in one shard. Groups are placed by falling size, each where the dot product of its vector with
the shard's residual capacity is highest, among the shards whose bytes it does not overfill; where none has room, the emptiest
takes it. So all shards end with as many bytes as each other, but for the last small items, and tokens and rows follow as far as
the groups allow. Bytes weigh most, or what is left in the end would suit the wrong shards.

What the driver places is bounded whatever the corpus. A group that makes up a good part of a shard is an item of its own, of
which there can be only so many; all others are bundled by hash, into bundles of four widths, so that the last ones are fine.
A group larger than a shard has to be split and becomes several items.

Rows are numbered within their task, and a running sum over tasks makes that a gapless slot. Texts are not shuffled.
"""

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywell.llm.common import keep, release

SHARDS = 16
#: A group with such a part of a shard's capacity, in bytes, tokens or rows, is placed by itself.
OWN_PART = 256
#: Bundles of each width; each width takes three quarters of what the wider ones left, the last all.
BUNDLES, WIDTHS = 1024, 4
#: A group beyond a shard's capacity is split into items of such a part of it.
PIECES = 4

#: Weights of bytes, tokens and rows in the dot product: bytes are what has to be equal in the end.
WEIGHTS = np.array([16.0, 1.0, 1.0])

WORD = r"[^\x20\x09-\x0D]+"
MEASURES = ("bytes", "tokens", "rows")


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item (rows of bytes, tokens and rows)."""
    total = items.sum(axis=0)
    share = items / np.where(total > 0, total, 1)
    left = np.full((shards, items.shape[1]), 1 / shards)
    out = np.zeros(len(items), np.int64)
    for i in np.lexsort([np.arange(len(items)), -share[:, 0], -share.max(axis=1)]):
        fits = left[:, 0] >= share[i, 0]
        best = np.where(fits, left @ (WEIGHTS * share[i]), -np.inf) if fits.any() else left[:, 0]
        out[i] = best.argmax()
        left[out[i]] -= share[i]
    return out


def bundle_of(digest: Column) -> Column:
    """The bundle of a group, by a hash of its digest."""
    h = F.xxhash64(F.lit("bundle"), digest)
    at = F.pmod(h, F.lit(4**WIDTHS))
    width = sum(((at < 4 ** (WIDTHS - k)).cast("int") for k in range(1, WIDTHS)), F.lit(0))
    return (width * BUNDLES + F.pmod(F.shiftright(h, 2 * WIDTHS), F.lit(BUNDLES))).cast("int")


@dataclass(frozen=True)
class Plan:
    """``whole``: digest and shard of groups placed by themselves. ``split``: digest and the pieces (shard, first row, rows)
    of split ones. ``bundles``: the shard of each bundle. ``rows``: rows of each shard that are not of split groups."""

    whole: list[tuple[bytearray, int]]
    split: list[tuple[bytearray, list[tuple[int, int, int]]]]
    bundles: list[tuple[int, int]]
    rows: list[int]


def plan(groups: DataFrame, shards: int = SHARDS) -> Plan:
    """Places groups (digest, bytes, tokens, rows; each group once).

    The driver gets at most 3 * OWN_PART * shards groups, as no more can have that part of a shard, and WIDTHS * BUNDLES sums.
    """
    widest = [F.coalesce(F.max(F.col(m) / F.col("rows")), F.lit(0)).alias(f"{m}_of_one") for m in ("bytes", "tokens")]
    totals = groups.agg(*(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in MEASURES), *widest).first()
    capacity = [totals[m] / shards for m in MEASURES]
    # Shards cannot differ by less than one row: a group no larger than the largest row, or a handful, is not split.
    most = [max(c, least) for c, least in zip(capacity, (totals.bytes_of_one, totals.tokens_of_one, PIECES))]
    parts = [F.col(m) * OWN_PART >= F.lit(c) for m, c in zip(MEASURES, capacity) if c > 0]
    large = F.lit(False)
    for part in parts:
        large = large | part
    own = groups.filter(large).select("digest", *MEASURES).orderBy("digest").collect()
    bundled = groups.filter(~large).groupBy(bundle_of(F.col("digest")).alias("bundle")).agg(*(F.sum(m).alias(m) for m in MEASURES))
    bundles = bundled.orderBy("bundle").collect()

    items: list[tuple] = []
    names: list[tuple] = []
    for r in own:
        vector = [r[m] for m in MEASURES]
        if r.rows > 1 and any(v > m for v, m in zip(vector, most)):
            each = max(1, min(int(c * r.rows / v) for v, c in zip(vector, capacity) if v > 0) // PIECES)
            for first in range(0, r.rows, each):
                n = min(each, r.rows - first)
                items.append(tuple(v * n / r.rows for v in vector))
                names.append(("piece", r.digest, first, n))
        else:
            items.append(tuple(vector))
            names.append(("group", r.digest, 0, r.rows))
    for r in bundles:
        items.append(tuple(r[m] for m in MEASURES))
        names.append(("bundle", r.bundle, 0, r.rows))
    shard_of = place(np.array(items, np.float64).reshape(len(items), len(MEASURES)), shards).tolist()

    whole, split, of_bundle, rows = [], {}, [], [0] * shards
    for (kind, name, first, n), shard in zip(names, shard_of):
        if kind == "piece":
            split.setdefault(bytes(name), []).append((shard, first, n))
            continue
        rows[shard] += n
        (whole if kind == "group" else of_bundle).append((name, shard))
    return Plan(whole, [(bytearray(d), p) for d, p in split.items()], of_bundle, rows)


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds ``part``, the task, and ``at``, the row's number among those of its unit in the task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            units = batch.column("__unit").to_numpy()
            at = np.zeros(len(units), np.int64)
            for unit in np.unique(units).tolist():
                own = units == unit
                n = int(own.sum())
                at[own] = np.arange(n) + seen.get(unit, 0)
                seen[unit] = seen.get(unit, 0) + n
            columns = [*batch.columns, pa.array(np.full(len(at), part, np.int32)), pa.array(at)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "__part", "__at"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{kinds}, __part int, __at long")


def sharded(docs: DataFrame, shards: int = SHARDS, *, columns: Sequence[str] = ("doc_id",), tokens: Column | None = None) -> DataFrame:
    """``columns`` of all rows of ``docs``, with size, text_crc32, shard (from 0) and slot (from 0, without gaps in a shard).

    ``size`` is the text's bytes plus one, ``text_crc32`` its unsigned checksum; a null text counts as an empty one.
    ``tokens`` counts a row's tokens and must be a function of the text; by default its words. Rows with equal texts are in one
    shard, unless they are more than a shard holds (and more than the largest row, and than PIECES rows). Repeated rows, and rows that share or lack a doc_id, all get slots of their
    own. A single text larger than a shard fills it alone, and the others share the rest. Without rows there are none.
    Columns of ``docs`` that are not named are not looked at; named ones must not start with two underscores.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counted = F.regexp_count(text, F.lit(WORD)) if tokens is None else F.coalesce(tokens, F.lit(0))
    measured = docs.select(
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        (F.octet_length(text) + 1).cast("long").alias("bytes"),
        counted.cast("long").alias("tokens"),
    )
    groups = measured.groupBy("digest").agg(
        F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")
    )
    groups = keep(groups, "groups")
    done = plan(groups, shards)
    release(groups)

    # A unit is numbered through: the rows of a shard, or a split group, whose pieces then go to their shards.
    units = [(d, s) for d, s in done.whole] + [(d, shards + k) for k, (d, _) in enumerate(done.split)]
    own = spark.createDataFrame(units, "__digest binary, __own int")
    bundles = spark.createDataFrame(done.bundles, "__bundle int, __shared int")
    digest = F.unhex(F.sha2(text.cast("binary"), 256))
    rows = docs.select(
        *columns,
        (F.octet_length(text) + 1).cast("long").alias("__size"),
        F.crc32(text.cast("binary")).alias("__crc"),
        digest.alias("__digest"),
    )
    # Both sides are bounded, see ``plan``.
    rows = rows.join(F.broadcast(own), "__digest", "left").withColumn("__bundle", bundle_of(F.col("__digest")))
    rows = rows.join(F.broadcast(bundles), "__bundle", "left")
    unit = F.coalesce("__own", "__shared").alias("__unit")
    numbered = keep(_numbered(rows.select(*columns, "__size", "__crc", unit)), "numbered")

    counts = numbered.groupBy("__unit", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__unit").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("__unit", "__part", F.coalesce(before, F.lit(0)).alias("__before"))
    at = F.col("__at") + F.col("__before")
    placed = numbered.join(starts, ["__unit", "__part"]).withColumn("__row", at)

    held, pieces = list(done.rows), []
    for k, (_, own_pieces) in enumerate(done.split):
        for shard, first, n in own_pieces:
            pieces.append((shards + k, first, first + n, shard, held[shard]))
            held[shard] += n
    schema = "__unit int, __first long, __end long, __shard int, __base long"
    inside = (F.col("r.__unit") == F.col("p.__unit")) & (F.col("__row") >= F.col("__first")) & (F.col("__row") < F.col("__end"))
    # At most PIECES * 3 * shards pieces and as many rests.
    found = placed.alias("r").join(F.broadcast(spark.createDataFrame(pieces, schema)).alias("p"), inside, "left")
    return found.select(
        *(F.col(f"r.`{c}`") for c in columns),
        F.col("__size").alias("size"),
        F.col("__crc").alias("text_crc32"),
        F.coalesce("__shard", "r.__unit").cast("int").alias("shard"),
        F.coalesce(F.col("__row") - F.col("__first") + F.col("__base"), F.col("__row")).alias("slot"),
    )


def write_shards(rows: DataFrame, path: str) -> None:
    """Writes sharded rows as one folder for each shard, in the order of their slots within each file."""
    spread = rows.hint("rebalance", "shard").sortWithinPartitions("shard", "slot")
    spread.write.partitionBy("shard").parquet(path)
