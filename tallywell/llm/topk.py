"""Exact top-k by inner product with a pivot table.

For vectors of whole numbers |q-c|^2 = |q|^2 + |c|^2 - 2 q.c, so a lower bound on the distance is an upper bound on the score.
Distances of all vectors to a fixed number of pivots are computed once; by the triangle inequality the largest difference
of two vectors' distances to a pivot bounds their distance from below. Within a block, candidates that are near the same
pivot at a like distance form steps; the range of their distances to each pivot bounds all of a step at once. Steps go by
falling bound, and each is multiplied with those queries whose k-th score the bound reaches, all at once, which leaves out
only what cannot enter. What is left of a query's candidates is ordered by itself.

Vectors whose squared length float64 does not hold exactly have no distances in the table. Products with them are bounded by their
rounding error, and those that may be among the k best are computed as Python integers.

Queries and candidates are dealt into a grid of blocks of bounded size; a task holds one cell of it. The number of tasks
follows that of cells: a cell is few bytes and much work, so adaptive execution, which goes by bytes, must not join them.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywell.llm.common import keep, release
from tallywell.llm.vectors import EXACT, best_first, beyond, exact_products, held, matrix, top, whole_vectors

K = 5
PIVOTS = 24
#: Pivots are chosen among so many vectors of each length.
PIVOT_SAMPLE = 512
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 8192
#: Candidates evaluated at a time, before the bound is looked at again.
STEP = 128
#: Queries evaluated at a time.
BATCH = 1024
#: Scores held for a batch before those beyond the k best of each query are dropped; equal scores can be very many.
HELD = 1 << 20
#: Tasks of the grid for each core at most; beyond that a task takes several cells.
CELLS_PER_CORE = 64
#: float32 holds products of norms up to this exactly, with all sums on the way.
EXACT_SINGLE = float(1 << 24)


def _far_apart(points: np.ndarray, count: int) -> np.ndarray:
    chosen, away = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(points)) and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def chosen_pivots(rows: DataFrame, count: int) -> dict[int, np.ndarray]:
    """For each length of narrow vectors at most ``count`` of them, far apart, out of PIVOT_SAMPLE in the order of a hash.

    The driver gets these alone.
    """

    def choose(key: tuple, sample: pa.Table) -> pa.Table:
        width = key[0].as_py()
        points = _far_apart(matrix(sample.column("v"), width), count)
        return pa.table({"w": pa.array([width] * len(points), pa.int32()), "v": pa.array(points.tolist(), pa.list_(pa.float64()))})

    place = F.row_number().over(Window.partitionBy("w").orderBy(F.xxhash64("row"), "row"))
    sample = rows.filter("narrow").select("w", "v", place.alias("place")).filter(F.col("place") <= PIVOT_SAMPLE)
    found: dict[int, list] = {}
    for r in sample.groupBy("w").applyInArrow(choose, "w int, v array<double>").collect():
        found.setdefault(r.w, []).append(r.v)
    return {w: np.array(points, np.float64).reshape(len(points), w) for w, points in found.items()}


def pivot_table(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds ``to_pivots``, each narrow vector's distances to the pivots of its length; null for others."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = np.where(batch.column("narrow").to_numpy(zero_copy_only=False), batch.column("w").to_numpy(), -1)
            for width in np.unique(kinds).tolist():
                part = batch.filter(pa.array(kinds == width))
                if width < 0:
                    lists = pa.nulls(len(part), pa.list_(pa.float64()))
                else:
                    points, own = matrix(part.column("v"), width), pivots[width]
                    squares = (points**2).sum(1)[:, None] + (own**2).sum(1) - 2 * points @ own.T
                    away = np.sqrt(np.maximum(squares, 0))
                    at = np.arange(len(points) + 1, dtype=np.int32) * len(own)
                    lists = pa.ListArray.from_arrays(pa.array(at), pa.array(away.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, "to_pivots"])

    return rows.mapInArrow(run, "row long, vec_id long, v array<double>, asks boolean, w int, narrow boolean, to_pivots array<double>")


def _best(query, points, ids, missing, bounds, able, k) -> tuple[np.ndarray, np.ndarray]:
    """Scores and places of the query's k best among the points at ``able``: by falling score, then by id."""
    order = able[np.argsort(-bounds[able], kind="stable")]
    scores, found = np.zeros(0), np.zeros(0, np.int64)
    for at in range(0, len(order), STEP):
        part = order[at : at + STEP]
        if len(scores) == k and bounds[part[0]] < scores[-1]:
            break
        scores = np.concatenate([scores, points[part] @ query])
        found = np.concatenate([found, part])
        first = top(scores, ids[found], missing[found], k)
        scores, found = scores[first], found[first]
    return scores, found


def _steps(away: np.ndarray) -> list[np.ndarray]:
    """Places of candidates, STEP at a time, those near the same pivot at a like distance together."""
    nearest = away.argmin(axis=1)
    order = np.lexsort([away[np.arange(len(away)), nearest], nearest])
    return [order[at : at + STEP] for at in range(0, len(order), STEP)]


def _step_bounds(q_sq: np.ndarray, q_away: np.ndarray, c_sq: np.ndarray, c_away: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """For each query and step no less than the score of any of the step's candidates."""
    out = np.empty((len(q_sq), len(steps)))
    for j, step in enumerate(steps):
        own = c_away[step]
        low = np.maximum(own.min(axis=0) - q_away, q_away - own.max(axis=0)).max(axis=1)
        both = q_sq + c_sq[step].max()
        # Distances are rounded: the bound is raised by far more than that can be.
        out[:, j] = (both - np.maximum(low, 0) ** 2) / 2 + both * 1e-9 + 1e-3
    return out


def _first(query, place, score, ids, missing, k) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those that are among the k best of their query: by falling score, then by id."""
    order = np.lexsort([ids[place], missing[place], -score, query])
    query, place, score = query[order], place[order], score[order]
    early = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[early], place[early], score[early]


def _reached(queries, points, ids, missing, own, steps, bounds, k) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, place and score of the points that are among the k best of a query, ordered by query, and maybe of some that are
    as good as the last of these.

    ``own`` is the place of a query's own row among the points, -1 if it is not there; it takes no part. ``bounds`` is as
    ``_step_bounds`` gives it.
    """
    best = np.full((len(queries), k), -np.inf, queries.dtype)  # scores, the least first
    of, at = np.full(len(points), -1), np.zeros(len(points), np.int64)
    found, held = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, queries.dtype))], 0
    for j, step in enumerate(steps):
        of[step], at[step] = j, np.arange(len(step))
    own_step = np.where(own >= 0, of[own], -1)
    for j in np.argsort(-bounds.max(axis=0), kind="stable").tolist():
        asks = np.flatnonzero(bounds[:, j] >= best[:, 0])
        if not len(asks):
            continue
        scores = (queries if len(asks) == len(queries) else queries[asks]) @ points[steps[j]].T
        here = np.flatnonzero(own_step[asks] == j)
        scores[here, at[own[asks[here]]]] = -np.inf
        better = scores.max(axis=1) >= best[asks, 0]
        asks, scores = asks[better], scores[better]
        best[asks] = np.partition(np.concatenate([best[asks], scores], axis=1), -k, axis=1)[:, -k:]
        best[asks] = np.sort(best[asks], axis=1)
        a, b = np.nonzero((scores >= best[asks, :1]) & (scores > -np.inf))
        found.append((asks[a], steps[j][b], scores[a, b]))
        held += len(a)
        if held > HELD:
            found = [_first(*(np.concatenate(x) for x in zip(*found)), ids, missing, k)]
            held = len(found[0][0])
    query, place, score = (np.concatenate(x) for x in zip(*found))
    left = score >= best[query, 0]
    order = np.flatnonzero(left)[np.argsort(query[left], kind="stable")]
    return query[order], place[order], score[order]


def _narrow_best(queries: pa.Table, others: pa.Table, k: int) -> dict[int, list[tuple[int, int]]]:
    """By row of a narrow query: score and place of the k best among the narrow candidates."""
    width = len(others.column("v")[0])
    q, c = matrix(queries.column("v"), width), matrix(others.column("v"), width)
    pivots = len(others.column("to_pivots")[0])
    q_away, c_away = matrix(queries.column("to_pivots"), pivots), matrix(others.column("to_pivots"), pivots)
    q_rows, rows = queries.column("row").to_numpy(), others.column("row").to_numpy()
    missing = others.column("vec_id").is_null().to_numpy()
    ids = others.column("vec_id").fill_null(0).to_numpy()
    q_sq, c_sq = (q**2).sum(1), (c**2).sum(1)
    by_row = np.argsort(rows)
    own = by_row[np.minimum(np.searchsorted(rows, q_rows, sorter=by_row), len(rows) - 1)]
    own = np.where(rows[own] == q_rows, own, -1)
    kind = np.float32 if np.sqrt(q_sq.max() * c_sq.max()) < EXACT_SINGLE else np.float64
    points, steps = c.astype(kind), _steps(c_away)
    # Queries near the same pivot go together, so that they have steps in common.
    order, out = np.argsort(q_away.argmin(axis=1), kind="stable"), {}
    for start in range(0, len(order), BATCH):
        batch = order[start : start + BATCH]
        bounds = _step_bounds(q_sq[batch], q_away[batch], c_sq, c_away, steps)
        number, place, score = _reached(q[batch].astype(kind), points, ids, missing, own[batch], steps, bounds, k)
        edge = np.searchsorted(number, np.arange(len(batch) + 1))
        for i, a, b in zip(batch.tolist(), edge[:-1].tolist(), edge[1:].tolist()):
            near = place[a:b]
            scores, places = _best(q[i], c[near], ids[near], missing[near], score[a:b], np.arange(b - a), k)
            out[int(q_rows[i])] = [(int(s), int(p)) for s, p in zip(scores, near[places])]
    return out


def _possible(query: np.ndarray, points: np.ndarray, k: int) -> np.ndarray:
    """Places of all points that may be among the k best, as far as products rounded in float64 tell."""
    with np.errstate(over="ignore", invalid="ignore"):
        near = points @ query
        doubt = (np.abs(points) @ np.abs(query)) * ((len(query) + 2) * 2.0**-52)
        least, most = near - doubt, near + doubt
    least = np.where(np.isfinite(least), least, -np.inf)
    most = np.where(np.isfinite(most), most, np.inf)
    if len(points) <= k:
        return np.arange(len(points))
    return np.flatnonzero(most >= np.partition(least, -k)[-k])


def _cell(cell: pa.Table, k: int) -> pa.Table:
    """The k best of each query among the cell's candidates."""
    asks = cell.column("is_query").to_numpy()
    queries, others = cell.filter(pa.array(asks)), cell.filter(pa.array(~asks))
    out: list[tuple] = []
    if queries.num_rows and others.num_rows:
        width = len(queries.column("v")[0])
        q, c = matrix(queries.column("v"), width), matrix(others.column("v"), width)
        q_rows, rows = queries.column("row").to_numpy(), others.column("row").to_numpy()
        missing = others.column("vec_id").is_null().to_numpy()
        ids = others.column("vec_id").fill_null(0).to_numpy()
        q_narrow, narrow = (t.column("narrow").to_numpy() for t in (queries, others))
        near = np.flatnonzero(narrow)
        best = {}
        if len(near) and q_narrow.any():
            best = _narrow_best(queries.filter(pa.array(q_narrow)), others.filter(pa.array(narrow)), k)
        for i in range(len(q)):
            found: list[tuple[int, int]] = []
            far = np.flatnonzero(~narrow if q_narrow[i] else rows != q_rows[i])
            if q_narrow[i] and len(near):
                found = [(s, int(near[a])) for s, a in best[int(q_rows[i])]]
            if len(far):
                far = far[_possible(q[i], c[far], k)]
                found += zip(exact_products(c[far], q[i]), far.tolist())
                found = sorted(found, key=lambda x: (-x[0], missing[x[1]], ids[x[1]]))[:k]
            out += [(q_rows[i], rows[a], None if missing[a] else ids[a], held(s), beyond(s)) for s, a in found]
    columns = list(zip(*out)) if out else [[]] * 5
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = ("query", "row", "vec_id", "score", "beyond")
    return pa.table({n: pa.array([x if x is None or isinstance(x, bytes) else int(x) for x in col], kind) for n, col, kind in zip(names, columns, kinds)})


def grid(points: DataFrame) -> DataFrame:
    """Candidates and queries (``is_query``) of each cell (w, qb, cb), the cells dealt out to tasks."""
    spark = points.sparkSession

    def blocks(df: DataFrame, size: int, name: str) -> DataFrame:
        return df.groupBy("w").agg(F.ceil(F.count(F.lit(1)) / size).alias(name))

    asked = points.filter("asks")
    # One row for each length of vectors.
    sizes = blocks(points, CANDIDATE_BLOCK, "cs").join(blocks(asked, QUERY_BLOCK, "qs"), "w").select("w", "cs", "qs").collect()
    tasks = max(1, min(sum(r.cs * r.qs for r in sizes), CELLS_PER_CORE * spark.sparkContext.defaultParallelism))
    sizes = F.broadcast(spark.createDataFrame(sizes, "w int, cs long, qs long"))

    def dealt(df: DataFrame, is_query: bool) -> DataFrame:
        own, other, names = ("qs", "cs", ("qb", "cb")) if is_query else ("cs", "qs", ("cb", "qb"))
        return df.join(sizes, "w").select(
            "row",
            "vec_id",
            "v",
            "narrow",
            "to_pivots",
            F.lit(is_query).alias("is_query"),
            "w",
            F.pmod(F.xxhash64("row"), F.col(own)).alias(names[0]),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(names[1]),
        )

    return dealt(points, False).unionByName(dealt(asked, True)).repartition(tasks, "w", "qb", "cb")


def top_k(vectors: DataFrame, asks: Column, k: int = K, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank from 1, vec_id and score: the k best other rows of ``vectors`` for each row for which ``asks`` is true.

    Vectors are rounded (``whole_vectors``); a score is the inner product. Equal scores go to the smaller vec_id; with fewer than k
    others all are returned. Vectors that are null or have a null or non-finite component take no part. Rows that share a vec_id,
    or are equal, are rows of their own, as queries too; rows without one come last among equals and are named by null. Only
    vectors of one length are compared; empty ones have scores of 0. Scores that are no long are ordered exactly and shown as
    the nearest long. Without queries or vectors there are no rows. Other columns are not read.
    """
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    # A file is read by no more tasks than it has row groups, and all that follows would be by as many.
    rows = whole_vectors(vectors.repartition(2 * cores), F.coalesce(asks, F.lit(False)).alias("asks"))
    squares = F.aggregate("v", F.lit(0.0), lambda sum_, x: sum_ + x * x)
    typed = rows.withColumn("w", F.size("v")).withColumn("narrow", squares < EXACT)
    points = keep(pivot_table(typed, chosen_pivots(typed, pivots)), "pivot_table")

    best = grid(points).groupBy("w", "qb", "cb").applyInArrow(lambda t: _cell(t, k), "query long, row long, vec_id long, score long, beyond binary")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(*best_first()))
    first = best.withColumn("rank", rank).filter(F.col("rank") <= k)
    names = points.filter("asks").select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    result = keep(first.join(names, "query").select("query_id", "rank", "vec_id", "score"), "top")
    release(rows, points)
    return result
