"""Hard negatives by threshold joins over an inverted index with suffix-norm bounds.

Components are ordered by weight, and groups of them have a list each. The lists hold the candidates by falling norm: for a
threshold t they are read only as far as that norm times the anchor's reaches t, as all other candidates' products stay below
it, so the rest of a list counts as not indexed. Partial scores are accumulated list by list, and a candidate goes once its score
and the product of the norms of what remains of both stay below t. Who is left has its full score then. Each anchor starts at a
high threshold, which is lowered until its windows are full or nothing lower can enter. Some anchors are looked up together, each
with a threshold of its own; a candidate goes when it does for all of them.

Anchors and candidates are dealt into a grid of cells of bounded size; where only rows of one label are asked for, each label has
a grid of its own. A cell reads its candidates part by part and carries each window on: once it is full, later parts are asked
only for what its last row does not keep out.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywell.llm.common import keep, release
from tallywell.llm.vectors import EXACT, beyond, best_first, exact_products, held, matrix, norms, top, value, whole_vectors

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between so many hundredths of the positive's.
LOW, HIGH = 30, 90
#: Anchors and candidates of a cell, and candidates indexed at a time.
ANCHOR_BLOCK, CANDIDATE_BLOCK, PART = 512, 32768, 4096
#: Components that share a list.
GROUP = 8
#: Anchors looked up together.
TOGETHER = 64
#: By what a threshold is lowered, and how many times before the lowest is taken.
STEP, STEPS = 0.7, 8


class Index:
    """A list for each group of components, with what each candidate has there, by falling norm of candidates."""

    def __init__(self, points: np.ndarray):
        self.weight = np.argsort(-(points**2).sum(axis=0), kind="stable")
        self.starts = list(range(0, points.shape[1], GROUP))
        lengths = np.sqrt((points**2).sum(axis=1))
        self.places = np.argsort(-lengths, kind="stable")
        self.falling = lengths[self.places]
        own = points[np.ix_(self.places, self.weight)]
        self.lists = [np.ascontiguousarray(own[:, s : s + GROUP]) for s in self.starts]
        # remaining[j]: the norm of components behind the j-th group
        self.remaining = [np.sqrt((own[:, s + GROUP :] ** 2).sum(axis=1)) for s in self.starts]
        self.largest = float(self.falling[0]) if self.lists and len(points) else 0.0

    def reaching(self, anchor: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all candidates with a score of ``threshold`` or more (others may be among them)."""
        places, scores = self.reaching_any(anchor[None], np.array([threshold]))
        return places, scores[0]

    def reaching_any(self, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all candidates that reach the threshold of an anchor (others may be among them), and for each anchor their
        scores."""
        q = anchors[:, self.weight]
        left = [np.sqrt((q[:, s:] ** 2).sum(axis=1)) for s in self.starts] + [np.zeros(len(q))]
        n, whole = len(self.places), left[0]
        t = thresholds - (1e-9 * whole * self.largest + 1e-6)
        some = (t > 0) & (whole > 0)
        # All that the rest of a list could add up to, with every component of the anchor, is below t.
        ends = np.where(t > 0, 0, n)
        ends[some] = np.searchsorted(-self.falling, -t[some] / whole[some], "right")
        end = int(ends.max(initial=0))
        scores, own = np.zeros((len(q), end)), np.arange(end)
        for start, behind, remaining, values in zip(self.starts, left[1:], self.remaining, self.lists):
            scores += q[:, start : start + GROUP] @ values[own].T
            able = (scores + behind[:, None] * remaining[own] >= t[:, None]).any(axis=0)
            if not able.all():
                scores, own = scores[:, able], own[able]
        return self.places[own], scores


@dataclass
class Best:
    """The first k rows of one window so far."""

    low: float
    high: float
    k: int
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0))
    at: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def with_rows(self, scores: np.ndarray, at: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> "Best":
        inside = (scores >= self.low) & (scores <= self.high)
        scores, at = np.concatenate([self.scores, scores[inside]]), np.concatenate([self.at, at[inside]])
        first = top(scores, ids[at], missing[at], self.k)
        return Best(self.low, self.high, self.k, scores[first], at[first])

    def settled(self, threshold: float) -> bool:
        """No row with a score below ``threshold`` can enter."""
        full = len(self.scores) == self.k and self.scores[-1] >= threshold
        return full or threshold <= self.low or not self.k or self.low > self.high


def _start(windows: list[Best], reach: float) -> float:
    """The threshold to begin with: what can still enter, if all windows are full already."""
    able = [w for w in windows if w.k and w.low <= w.high]
    if able and all(len(w.scores) == w.k for w in able):
        return min(float(w.scores[-1]) for w in able)
    return min(max((w.high for w in windows), default=0.0), reach) * STEP


def _filled(
    windows: list[list[Best]], index: Index, at: np.ndarray, anchors: np.ndarray, fits: Callable[[np.ndarray, np.ndarray], np.ndarray], ids, missing
) -> list[list[Best]]:
    """The windows of each anchor after the candidates of one index, whose places are ``at``.

    ``fits`` tells for pairs of anchor and candidate whether the latter may enter.
    """
    reach = np.sqrt((anchors**2).sum(axis=1)) * index.largest
    t = np.array([_start(w, float(r)) for w, r in zip(windows, reach)])
    out, asked, lowered = list(windows), np.arange(len(windows)), 0
    while len(asked):
        places, scores = index.reaching_any(anchors[asked], t[asked])
        which, column = np.nonzero(scores >= t[asked, None])
        scores, found = scores[which, column], at[places[column]]
        own = fits(asked[which], found)
        which, scores, found = which[own], scores[own], found[own]
        cuts = np.searchsorted(which, np.arange(len(asked) + 1))
        lowered, again = lowered + 1, []
        for i, first, last in zip(asked, cuts, cuts[1:]):
            if last > first:
                out[i] = [w.with_rows(scores[first:last], found[first:last], ids, missing) for w in windows[i]]
            lows = [w.low for w in out[i] if not w.settled(t[i])]
            if lows:
                again.append(i)
                t[i] = max(t[i] * STEP, min(lows)) if t[i] > 0 and lowered < STEPS else min(lows)
        asked = np.array(again, np.int64)
    return out


def _wide(windows: list[tuple[int, int, int]], anchor, points, at, ids, missing) -> list[list[tuple[int, int]]]:
    """Score and place of the first rows of each window, for products beyond float64, as Python integers."""
    scores = exact_products(points, anchor)
    out = []
    for low, high, k in windows:
        inside = [(s, a) for s, a in zip(scores, at.tolist()) if (low is None or s >= low) and (high is None or s <= high)]
        out.append(sorted(inside, key=lambda x: (-x[0], missing[x[1]], ids[x[1]]))[:k])
    return out


def _cell(cell: pa.Table, same_label: bool) -> pa.Table:
    """The first rows of each window of each anchor among the cell's candidates."""
    asks = cell.column("asks").to_numpy(zero_copy_only=False)
    anchors, others = cell.filter(pa.array(asks)), cell.filter(pa.array(~asks))
    out: list[tuple] = []
    if anchors.num_rows and others.num_rows:
        width = len(anchors.column("v")[0])
        q, c = matrix(anchors.column("v"), width), matrix(others.column("v"), width)
        rows = others.column("row").to_numpy()
        missing = others.column("vec_id").is_null().to_numpy(zero_copy_only=False)
        ids = others.column("vec_id").fill_null(0).to_numpy()
        labels, own_labels = others.column("label").to_numpy(), anchors.column("label").to_numpy()
        q_rows, q_norms, c_norms = anchors.column("row").to_numpy(), norms(q), norms(c)
        windows = anchors.column("windows").to_pylist()
        asked = [[_bounds(w) for w in own] for own in windows]
        best = [[Best(_real(low, -np.inf), _real(high, np.inf), k) for low, high, k in own] for own in asked]
        plain = np.flatnonzero(c_norms * max(1.0, float(np.min(q_norms, initial=np.inf))) < EXACT)
        indexes = [(plain[a : a + PART], Index(c[plain[a : a + PART]])) for a in range(0, len(plain), PART)]
        narrow = np.flatnonzero(q_norms < EXACT)
        largest = float(c_norms.max(initial=0))

        def others_of(i: np.ndarray | int, at: np.ndarray) -> np.ndarray:
            fits = (labels[at] == own_labels[i]) if same_label else (labels[at] != own_labels[i])
            return fits & (rows[at] != q_rows[i])

        for a in range(0, len(narrow), TOGETHER):
            own = narrow[a : a + TOGETHER]

            def fits(i: np.ndarray, at: np.ndarray, own: np.ndarray = own) -> np.ndarray:
                return others_of(own[i], at) & (c_norms[at] * q_norms[own[i]] < EXACT)

            found = [best[i] for i in own]
            for at, index in indexes:
                found = _filled(found, index, at, q[own], fits, ids, missing)
            for i, full in zip(own, found):
                best[i] = full
        for i in range(len(q)):
            found = [[(int(s), int(a)) for s, a in zip(b.scores, b.at)] for b in best[i]]
            if q_norms[i] >= EXACT or largest * q_norms[i] >= EXACT:
                far = c_norms * q_norms[i] >= EXACT if q_norms[i] < EXACT else np.ones(len(c), bool)
                far = np.flatnonzero(far & others_of(i, np.arange(len(c))))
                more = _wide(asked[i], q[i], c[far], far, ids, missing)
                order = [sorted(a + b, key=lambda x: (-x[0], missing[x[1]], ids[x[1]])) for a, b in zip(found, more)]
                found = [rows_[:k] for rows_, (_, _, k) in zip(order, asked[i])]
            for w, best_rows in zip(windows[i], found):
                out += [(q_rows[i], w["place"], rows[a], None if missing[a] else ids[a], held(s), beyond(s)) for s, a in best_rows]
    columns = list(zip(*out)) if out else [[]] * 6
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = ("anchor", "place", "row", "vec_id", "score", "beyond")
    return pa.table({n: pa.array([x if x is None or isinstance(x, bytes) else int(x) for x in col], k) for n, col, k in zip(names, columns, kinds)})


def _bounds(window: dict) -> tuple[int | None, int | None, int]:
    """Least and greatest score of a window and the number of its rows; without a positive's score all scores are in it."""
    if window["score"] is None:
        return None, None, window["k"]
    positive = value(window["score"], window["beyond"])
    return -(-window["low"] * positive // 100), window["high"] * positive // 100, window["k"]


def _real(bound: int | None, missing: float) -> float:
    # Scores compared with it are below 2^53: a bound beyond that need not be exact.
    return missing if bound is None else float(min(max(bound, -(1 << 60)), 1 << 60))


def _searched(rows: DataFrame, anchors: DataFrame, same_label: bool) -> DataFrame:
    """anchor, place, row, vec_id, score and beyond: for each window of each anchor its first rows of each cell."""

    keys = ["w", "label"] if same_label else ["w"]

    def blocks(df: DataFrame, size: int) -> DataFrame:
        return df.withColumn("w", F.size("v")).groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / size).alias("blocks"))

    # One row for each length of vectors, and label of anchors.
    sizes = blocks(rows, CANDIDATE_BLOCK).withColumnRenamed("blocks", "cs").join(blocks(anchors, ANCHOR_BLOCK).withColumnRenamed("blocks", "qs"), keys)

    def dealt(df: DataFrame, windows: Column, asks: bool) -> DataFrame:
        own, other, names = ("qs", "cs", ("qb", "cb")) if asks else ("cs", "qs", ("cb", "qb"))
        return df.withColumn("w", F.size("v")).join(sizes, keys).select(
            "row",
            "vec_id",
            "label",
            "v",
            windows.alias("windows"),
            F.lit(asks).alias("asks"),
            "w",
            F.pmod(F.xxhash64("row"), F.col(own)).alias(names[0]),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(names[1]),
        )

    kind = anchors.schema["windows"].dataType
    grid = dealt(rows, F.lit(None).cast(kind), False).unionByName(dealt(anchors, F.col("windows"), True))
    return grid.groupBy(*keys, "qb", "cb").applyInArrow(
        lambda t: _cell(t, same_label), "anchor long, place int, row long, vec_id long, score long, beyond binary"
    )


def _first(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(*best_first()))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def mined_negatives(
    vectors: DataFrame,
    anchors: Column,
    label: Column,
    *,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score.

    Vectors are rounded (``whole_vectors``); a score is the inner product, higher ones come first, then smaller vec_ids. Rows
    for which ``anchors`` is true are anchors. An anchor's positives are its first other rows of the same label; for each the
    first ``negatives`` rows of other labels follow whose score is between ``low`` and ``high`` hundredths of the positive's.

    Rows with a null label or a vector that is null or has a null or non-finite component take no part. Rows that share a
    vec_id, or are equal, are rows of their own; rows without one come last among equals and are named by null. Only vectors
    of one length are compared; empty ones have scores of 0. Scores that are no long are ordered exactly and shown as the
    nearest long. Without anchors, positives or negatives in range there are no rows.
    """
    rows = whole_vectors(vectors.filter(label.isNotNull()), label.cast("long").alias("label"), anchors.alias("is_anchor"))
    asked = rows.filter("is_anchor")
    window = F.struct(
        F.lit(0).alias("place"),
        F.lit(None).cast("long").alias("score"),
        F.lit(None).cast("binary").alias("beyond"),
        F.lit(low).alias("low"),
        F.lit(high).alias("high"),
        F.lit(positives).alias("k"),
    )
    found = _searched(rows, asked.withColumn("windows", F.array(window)), True)
    chosen = keep(_first(found, positives), "positives")
    each = F.struct(
        F.col("rank").alias("place"), "score", "beyond", F.lit(low).alias("low"), F.lit(high).alias("high"), F.lit(negatives).alias("k")
    )
    # At most ``positives`` entries for each anchor.
    windows = chosen.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(each).alias("windows"))
    ranked = _first(_searched(rows, asked.join(windows, "row"), False), negatives)
    pairs = chosen.select("anchor", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = asked.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    out = ranked.join(pairs, ["anchor", "place"]).join(names, "anchor").select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
    result = keep(out, "negatives")
    release(rows, chosen)
    return result
