"""SimHash near-duplicates by the generalised pigeonhole principle.

Two fingerprints within D bits, cut into m groups of bits, are within t_i bits in some group i whenever the thresholds add
up to D - m + 1; a threshold of -1 leaves a group out. Correlated bits are put into one group. For each m the thresholds
are allocated by dynamic programming on estimated costs: probes written, and candidates met, from the agreement of
each bit over all fingerprints. The cheapest m and allocation are used, so a larger corpus gets wider groups.

Fingerprints are probed by a group's bits, with up to t_i of them flipped, and pairs that meet are verified over all
bits inside the join, so only links leave it. A crowded bucket is split by the same principle on its other bits. Rows
with one fingerprint are one node, however many they are.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import keep, signed, text_chunks, texts_of
from tallywell.llm.components import components

BITS = 64
SEED = 42
WIDTH = 3
DISTANCE = 2

#: A probe is written, dealt out and sorted; a candidate is one comparison of two longs.
PROBE_COST = 8.0
#: Buckets of more fingerprints are split further.
CROWDED = 500


def _shingle_hashes(words: bytes, width: int) -> list[int]:
    """XXH64 of each run of ``width`` words; ``words`` are joined by single spaces and not empty."""
    gaps = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    h = xxhash.xxh64_intdigest
    if len(gaps) < width:
        return [h(words, SEED)]
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(words)]
    return [h(words[a:b], SEED) for a, b in zip(starts[: len(ends) - width + 1], ends[width - 1 :], strict=True)]


def fingerprint_array(data: np.ndarray, bounds: np.ndarray, width: int) -> np.ndarray:
    raw = data.tobytes()
    n = len(bounds) - 1
    hashes: list[int] = []
    counts = np.zeros(n, np.int64)
    for i in range(n):
        words = b" ".join(raw[bounds[i] : bounds[i + 1]].lower().split())  # bytes: A-Z and ASCII white space only
        if words:
            found = _shingle_hashes(words, width)
            counts[i] = len(found)
            hashes += found
    out = np.zeros(n, np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = (np.cumsum(counts) - counts)[some]
        sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        set_ = 2 * sums > counts[some, None]
        out[some] = np.packbits(set_, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, width: int = WIDTH, *, hashes: bool = False) -> DataFrame:
    """doc_id and fingerprint (64 bits in a long) of every row; with ``hashes`` also t, a hash of the text."""
    own = ["doc_id", "t"] if hashes else ["doc_id"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in text_chunks(batches):
            found = pa.array(signed(fingerprint_array(data, bounds, width)))
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in own), found], [*own, "fingerprint"])

    rows = texts_of(docs).withColumn("t", F.xxhash64("text")) if hashes else texts_of(docs)
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in (*own, "fingerprint")))


# grouping bits and allocating thresholds -----------------------------------------------------------


@dataclass(frozen=True)
class Part:
    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return _long(sum(1 << b for b in self.bits))

    def flips(self) -> list[int]:
        """What to flip of the group's bits, up to the threshold of them."""
        return [_long(sum(1 << b for b in c)) for k in range(self.threshold + 1) for c in combinations(self.bits, k)]


def _long(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and the sum of the product of each two bits as +1 and -1 (last row: of each bit).

    Summed over all fingerprints; the driver gets 65 x 65 sums.
    """

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS + 1, BITS + 1))
        for batch in batches:
            values = batch.column("fingerprint").to_numpy().view(np.uint8).reshape(-1, 8)
            signs = np.unpackbits(values, axis=1, bitorder="little").astype(np.float32) * 2 - 1
            signs = np.column_stack([signs, np.ones(len(signs), np.float32)])
            total += signs.T @ signs
        places = np.arange(total.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(total.ravel())], ["place", "total"])

    rows = nodes.select("fingerprint").mapInArrow(partial, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
    sums = np.zeros((BITS + 1) ** 2)
    for r in rows.collect():
        sums[r.place] = r.total
    sums = sums.reshape(BITS + 1, BITS + 1)
    return int(sums[BITS, BITS]), sums[:, :BITS]


def group_bits(n: int, sums: np.ndarray, parts: int) -> list[list[int]]:
    """All bits in groups of nearly one size, each grown by the bit most correlated with it."""
    means = sums[BITS] / max(n, 1)
    spread = np.sqrt(np.maximum(1 - means**2, 1e-9))
    close = np.abs((sums[:BITS] / max(n, 1) - np.outer(means, means)) / np.outer(spread, spread))
    np.fill_diagonal(close, 0)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(left, key=lambda b: (close[b, left].max(), -b))]
        while len(group) < size:
            rest = [b for b in left if b not in group]
            group.append(max(rest, key=lambda b: (close[b, group].sum(), -b)))
        left = [b for b in left if b not in group]
        groups.append(sorted(group))
    return groups


def _costs(n: int, sums: np.ndarray, bits: list[int], most: int) -> list[float]:
    """The cost of a group at thresholds -1, 0, ..., most."""
    agree = (1 + (sums[BITS, bits] / max(n, 1)) ** 2) / 2  # two fingerprints have one value in a bit
    chance = np.zeros(most + 1)
    chance[0] = 1
    for a in agree:
        chance[1:] = chance[1:] * a + chance[:-1] * (1 - a)
        chance[0] *= a
    out, probes = [0.0], 0
    for t in range(most + 1):
        probes += comb(len(bits), t)
        out.append(PROBE_COST * n * (1 + probes) + n * (n - 1) / 2 * float(chance[: t + 1].sum()))
    return out


def allocate(n: int, sums: np.ndarray, distance: int) -> list[Part]:
    """The groups and thresholds of least estimated cost."""
    best: tuple[float, list[Part]] | None = None
    for m in range(1, distance + 4):
        groups = group_bits(n, sums, m)
        # By the sum of the thresholds so far: the least cost, and the thresholds.
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for bits in groups:
            costs = _costs(n, sums, bits, min(distance, len(bits)))
            step: dict[int, tuple[float, list[int]]] = {}
            for total, (cost, chosen) in table.items():
                for t, more in enumerate(costs, start=-1):
                    found = (cost + more, [*chosen, t])
                    if total + t not in step or found < step[total + t]:
                        step[total + t] = found
            table = step
        found = table.get(distance - m + 1)
        if found and (best is None or found[0] < best[0]):
            best = found[0], [Part(tuple(b), t) for b, t in zip(groups, found[1], strict=True) if t >= 0]
    return best[1]


# probing and verifying -------------------------------------------------------------------------------


def _exploded(nodes: DataFrame, parts: list[Part], flipped: bool) -> DataFrame:
    """A row for each group and, if ``flipped``, each way to flip its bits."""
    own = F.array(
        *(
            F.struct(F.lit(k).alias("part"), F.col("fingerprint").bitwiseAND(F.lit(p.mask)).bitwiseXOR(F.lit(x)).alias("bucket"))
            for k, p in enumerate(parts)
            for x in (p.flips() if flipped else [0])
        )
    )
    return nodes.select("fingerprint", F.explode(own).alias("at")).select("fingerprint", "at.part", "at.bucket")


def _split(rows: DataFrame, crowded: DataFrame, parts: list[Part], distance: int) -> DataFrame:
    """Adds ``cell``: one for a bucket; for each crowded bucket the value of every slice of its other bits.

    Two fingerprints within the distance agree in one of distance + 1 slices of the other bits at least.
    """
    cells = []
    for part in parts:
        rest = [b for b in range(BITS) if b not in part.bits]
        slices = [rest[k :: distance + 1] for k in range(distance + 1)]
        masks = [_long(sum(1 << b for b in s)) for s in slices if s] or [0]
        cells.append(
            F.array(*(F.struct(F.lit(k).alias("slice"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("value")) for k, m in enumerate(masks)))
        )
    chosen = F.coalesce(*(F.when(F.col("part") == k, c) for k, c in enumerate(cells)))
    whole = F.array(F.struct(F.lit(-1).alias("slice"), F.lit(0).cast("long").alias("value")))
    marked = rows.join(crowded.withColumn("crowd", F.lit(True)), ["part", "bucket"], "left")
    return marked.select("fingerprint", "part", "bucket", F.explode(F.when(F.col("crowd"), chosen).otherwise(whole)).alias("cell")).select(
        "fingerprint", "part", "bucket", "cell.slice", "cell.value"
    )


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """a < b: all pairs of the distinct ``fingerprint`` values of ``nodes`` that differ in at most ``distance`` bits."""
    n, sums = bit_statistics(nodes)
    parts = allocate(n, sums, distance)
    held, probes = _exploded(nodes, parts, False), _exploded(nodes, parts, True)
    crowded = keep(held.groupBy("part", "bucket").count().filter(F.col("count") > CROWDED).drop("count"), "crowded")
    a = _split(probes, crowded, parts, distance).withColumnRenamed("fingerprint", "a").alias("a")
    b = _split(held, crowded, parts, distance).withColumnRenamed("fingerprint", "b").alias("b")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    at = ["part", "bucket", "slice", "value"]
    same = F.lit(True)
    for c in at:
        same &= F.col(f"a.{c}") == F.col(f"b.{c}")
    return a.join(b, same & near).select("a", "b").distinct()


def _rooted(nodes: DataFrame, distance: int) -> DataFrame:
    """fingerprint, first and root, the same for all fingerprints that are linked."""
    linked = components(links(nodes, distance))
    return nodes.join(linked.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )


def representatives(docs: DataFrame, width: int = WIDTH, distance: int = DISTANCE) -> DataFrame:
    """doc_id and t (XXH64 of the text, null as empty) of one row of each group of near duplicates.

    That with the smallest doc_id, nulls last, and of several such texts the one with the smallest hash.
    """
    rows = fingerprints(docs, width, hashes=True)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("first")
    rooted = _rooted(keep(rows.groupBy("fingerprint").agg(first), "nodes"), distance)
    return rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.t")


def near_duplicates(docs: DataFrame, width: int = WIDTH, distance: int = DISTANCE) -> DataFrame:
    """Every row's doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id it is linked with.

    Texts without words (null, empty, white space) have fingerprint zero and are linked like any other. Rows with one
    fingerprint are linked; a null doc_id is never a component_id unless all of a component's are null. Repeated rows
    are rows of their own. No rows give no rows. Other columns are not read.
    """
    rows = keep(fingerprints(docs, width), "fingerprints")
    nodes = keep(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "nodes")
    rooted = _rooted(nodes, distance)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(least, "root").select("fingerprint", "component_id")
    return rows.join(classes, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )
