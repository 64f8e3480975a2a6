import random
from fractions import Fraction
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywell.llm import topk
from tallywell.llm.topk import top_k

KIND = "vec_id long, embedding array<float>, label int, v string, w string, rank string"


def made(spark, rows):
    return spark.createDataFrame([(i, e, 0, "a", "b", "c") for i, e in rows], KIND)


def by_hand(rows, k, every):
    """Straight from the definition, in Python integers; scores as the nearest long, null ids last."""
    sound = []
    for i, e in rows:
        if e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        sound.append((i, [floor(Fraction(float(np.float32(x))) * 256) for x in e]))
    out = []
    for at, (q, v) in enumerate(sound):
        if q is not None and q % every == 0:
            scores = [
                (-sum(a * b for a, b in zip(v, c, strict=True)), i is None, i)
                for n, (i, c) in enumerate(sound)
                if n != at and len(c) == len(v)
            ]
            scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
            out += [(q, n + 1, i, min(max(-s, -(1 << 63)), (1 << 63) - 1)) for n, (s, _, i) in enumerate(scores[:k])]
    return sorted(out, key=str)


def found(spark, rows, k=5, every=50):
    return sorted(map(tuple, top_k(made(spark, rows), F.col("vec_id") % every == 0, k).collect()), key=str)


@pytest.mark.parametrize("blocks", [(1024, 8192), (3, 40)])
def test_random_vectors_with_ties_and_copies(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", blocks[1])
    monkeypatch.setattr(topk, "STEP", 7)
    r = random.Random(1)
    rows = [(k, [r.gauss(0, 1) for _ in range(8)]) for k in range(300)]
    rows += [(300 + k, rows[7][1]) for k in range(100)]  # ties
    rows += [(400 + k, [float(r.randrange(2)) for _ in range(8)]) for k in range(200)]
    assert found(spark, rows, every=20) == by_hand(rows, 5, 20)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]),
        (50, [0.5, -0.5]),
        (1, None),
        (2, [1.0, None]),
        (3, [nan, 1.0]),
        (4, [inf, 1.0]),
        (100, [-inf, 1.0]),
        (None, [1.0, 1.0]),
        (5, [1.0, 2.0, 3.0]),
        (150, [1.0, 2.0, 3.0]),
        (200, []),
        (6, [2.0, 2.0]),
        (6, [2.0, 2.0]),
        (6, [1.0, 2.0]),
        (250, [0.0, 0.0]),
        (50, [0.5, -0.5]),
        (50, [1.5, -0.5]),
    ]
    assert found(spark, rows) == by_hand(rows, 5, 50)


def test_fewer_than_k_and_none(spark):
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]
    assert found(spark, [(1, [1.0])]) == [] and found(spark, []) == []


def test_components_of_any_finite_size(spark):
    r = random.Random(3)
    rows = [(k, [r.gauss(0, 1) * 10.0 ** r.choice([0, 0, 1, 3.6, 6, 8, 30, 37]) for _ in range(3)]) for k in range(120)]
    rows += [(200, [4096.0, -4096.0, 1.0]), (201, [4096.0, -4096.0, 1.0]), (250, [1e6, 1e6, 1e6]), (251, [1e30, -1e30, 1.0])]
    rows += [(300, [3e38, 3e38, 3e38]), (301, [3e38, 3e38, 3e38]), (302, [-3e38, 3e38, 1.0])]
    rows += [(400 + k, [1e9 + 64 * k, 1e9, -1e9]) for k in range(20)]  # told apart only by exact products
    assert found(spark, rows, every=10) == by_hand(rows, 5, 10)


def test_columns_with_clashing_names(spark):
    rows = [(k, [float(k % 7), 1.0]) for k in range(60)]
    more = made(spark, rows).selectExpr("*", "1 AS row", "'x' AS asks", "2 AS narrow", "'y' AS to_pivots")
    assert sorted(map(tuple, top_k(more, F.col("vec_id") % 50 == 0).collect()), key=str) == by_hand(rows, 5, 50)


def test_candidates_below_the_bound_are_not_evaluated():
    r = np.random.default_rng(2)
    candidates = np.concatenate([r.normal(0, 1, (5000, 4)), r.normal(300, 1, (50, 4))])
    query = np.full(4, 300.0)
    squares = (candidates**2).sum(1)
    bounds = (squares + (query**2).sum() - ((candidates - query) ** 2).sum(1)) / 2  # exact bounds
    seen = []

    class Watched(np.ndarray):
        def __getitem__(self, part):
            seen.append(len(part))
            return np.asarray(super().__getitem__(part))

    every = np.arange(5050)
    scores, places = topk._best(query, candidates.view(Watched), every, np.zeros(5050, bool), bounds, every, 5)
    assert sum(seen) <= 2 * topk.STEP
    assert places.tolist() == np.lexsort([every, -(candidates @ query)])[:5].tolist()


def test_cells_are_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 25)
    r = random.Random(5)
    rows = made(spark, [(k, [r.gauss(0, 1) for _ in range(4)]) for k in range(300)])
    typed = topk.whole_vectors(rows, (F.col("vec_id") % 50 == 0).alias("asks"))
    typed = typed.withColumn("w", F.size("v")).withColumn("narrow", F.lit(True))
    dealt = topk.grid(topk.pivot_table(typed, topk.chosen_pivots(typed, 4)))
    cells = dealt.groupBy("w", "qb", "cb", F.spark_partition_id().alias("task")).agg(F.sum(F.lit(1)).alias("n")).collect()
    assert len({r.cb for r in cells}) == 12 and sum(r.n for r in cells) == 300 + 6 * 12
    assert len({r.task for r in cells}) > 3


@pytest.mark.parametrize("held", [1 << 20, 50])
@pytest.mark.parametrize("kind", [np.float32, np.float64])
def test_queries_together_find_what_each_finds(monkeypatch, held, kind):
    monkeypatch.setattr(topk, "HELD", held)
    monkeypatch.setattr(topk, "STEP", 16)
    r = np.random.default_rng(4)
    points = np.concatenate([r.integers(-3, 3, (200, 3)), r.integers(200, 203, (100, 3)), np.tile([[5, 5, 5]], (150, 1))]).astype(float)
    ids, missing = r.permutation(450), np.zeros(450, bool)
    asked = np.array([0, 7, 210, 215, 400])
    away = np.linalg.norm(points[:, None] - points[None, [0, 250]], axis=2)
    steps, squares = topk._steps(away), (points**2).sum(1)
    bounds = topk._step_bounds(squares[asked], away[asked], squares, away, steps)
    scores = points[asked] @ points.T
    for j, step in enumerate(steps):
        assert (bounds[:, j] >= scores[:, step].max(axis=1)).all()
    found = topk._reached(points[asked].astype(kind), points.astype(kind), ids, missing, asked, steps, bounds, 5)
    for i, place in enumerate(asked):
        wanted = [p for p in np.lexsort([ids, -scores[i]]).tolist() if p != place][:5]
        mine = [(-s, ids[p], p) for q, p, s in zip(*found) if q == i]
        assert [p for _, _, p in sorted(mine)][:5] == wanted


def test_steps_below_the_bound_are_not_multiplied(monkeypatch):
    r = np.random.default_rng(6)
    points = np.concatenate([r.integers(-9, 9, (2000, 4)), r.integers(300, 309, (60, 4))]).astype(float)
    away = np.linalg.norm(points[:, None] - points[None, [0, 2030]], axis=2)
    steps, squares = topk._steps(away), (points**2).sum(1)
    asked = np.array([2040, 2050])
    seen = []

    class Watched(np.ndarray):
        def __getitem__(self, part):
            seen.append(len(part))
            return np.asarray(super().__getitem__(part))

    bounds = topk._step_bounds(squares[asked], away[asked], squares, away, steps)
    topk._reached(points[asked], points.view(Watched), np.arange(2060), np.zeros(2060, bool), asked, steps, bounds, 5)
    assert sum(seen) <= 2 * topk.STEP
