import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywell.llm import hard_negatives
from tallywell.llm.hard_negatives import Index, mined_negatives
from tallywell.llm.queries import ORACLES, REGISTRY

SF = "/root/testdata/sf0.001"
KIND = "vec_id long, embedding array<{}>, label int, row string, v string, windows string"


def made(spark, rows, kind="float"):
    return spark.createDataFrame([(i, e, y, "a", "b", "c") for i, e, y in rows], KIND.format(kind))


def whole(x):
    return int(np.floor(x * 256.0)) if abs(x * 256.0) < 2**52 else int(x * 256.0)


def by_hand(rows, every=100, positives=5, negatives=10, kind=np.float32):
    sound = []
    for i, e, y in rows:
        if y is not None and e is not None and all(x is not None and np.isfinite(float(x) * 256.0) for x in e):
            sound.append((i, [whole(float(kind(x))) for x in e], y))

    def first(a, fits, k, low=None, high=None):
        out = []
        for j, (i, v, y) in enumerate(sound):
            if j != a and len(v) == len(sound[a][1]) and fits(y):
                s = sum(x * z for x, z in zip(v, sound[a][1], strict=True))
                if low is None or low <= 100 * s <= high:
                    out.append((-s, i is None, i or 0, i, s))
        return [(i, s) for *_, i, s in sorted(out, key=lambda x: x[:3])[:k]]

    def shown(s):
        return min(max(s, -(2**63)), 2**63 - 1)

    out = []
    for a, (i, _, y) in enumerate(sound):
        if i is not None and i % every == 0:
            for p, ps in first(a, lambda z, y=y: z == y, positives):
                found = first(a, lambda z, y=y: z != y, negatives, 30 * ps, 90 * ps)
                out += [(i, p, r + 1, n, shown(ps), shown(ns)) for r, (n, ns) in enumerate(found)]
    return sorted(out, key=str)


def found(spark, rows, every=100, kind="float", **more):
    df = mined_negatives(made(spark, rows, kind), F.col("vec_id") % every == 0, F.col("label"), **more)
    return sorted(map(tuple, df.collect()), key=str)


def clustered(seed, n, width=16, labels=4):
    r = np.random.default_rng(seed)
    centres = r.normal(0, 0.3, (labels, width))
    return [(k, (centres[k % labels] + r.normal(0, 0.2, width)).tolist(), int(r.integers(labels))) for k in range(n)]


@pytest.mark.parametrize("sizes", [(512, 32768, 4096, 8), (3, 90, 17, 3)])
def test_blocks_do_not_matter(spark, monkeypatch, sizes):
    for name, size in zip(("ANCHOR_BLOCK", "CANDIDATE_BLOCK", "PART", "GROUP"), sizes, strict=True):
        monkeypatch.setattr(hard_negatives, name, size)
    rows = clustered(1, 300)
    rows += [(300 + k, rows[4][1], k % 3) for k in range(40)]  # ties
    rows += [(100, rows[5][1], 1), (7, rows[8][1], 2), (7, rows[8][1], 2)]  # repeated ids and rows
    assert found(spark, rows, every=20) == by_hand(rows, 20)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(2, 60, 3, 2)
    rows += [(100, None, 1), (200, [nan, 1.0, 1.0], 1), (300, [1.0, None, 1.0], 0), (400, [inf, 0.0, 0.0], 0), (500, [1.0, 1.0, 1.0], None)]
    rows += [(None, [1.0, 1.0, 1.0], 0), (None, [1.0, 1.0, 1.0], 1), (600, [], 0), (601, [], 0), (602, [], 1), (603, [1.0, 2.0], 1)]
    rows += [(700, [0.0, 0.0, 0.0], 1), (800, [-1.0, -1.0, -1.0], 0)]
    assert found(spark, rows, every=10) == by_hand(rows, 10)


def test_components_of_any_size(spark):
    r = random.Random(3)
    sizes = (1.0, 4096.0, 1e6, 1e12, 1e30, 3e38)
    rows = [(k, [r.uniform(-1, 1) * r.choice(sizes) for _ in range(4)], k % 3) for k in range(120)]
    assert found(spark, rows, every=10) == by_hand(rows, 10)
    rows = [(k, [r.uniform(0.5, 1) * 1e200, r.uniform(0.2, 1) * 1e200], k % 2) for k in range(20)] + [(50, [1e307, 1.0], 1)]
    assert found(spark, rows, every=10, kind="double") == by_hand(rows, 10, kind=np.float64)


def test_few_or_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 0), (2, [0.5], 1)]) == []
    assert found(spark, [(0, [1.0], 0)]) == []
    rows = [(0, [1.0], 0), (1, [1.0], 0), (2, [0.5], 1)]
    assert found(spark, rows) == by_hand(rows) == [(0, 1, 1, 2, 256 * 256, 256 * 128)]


def test_lists_leave_out_what_the_norms_cover():
    r = np.random.default_rng(4)
    points = np.floor(np.concatenate([r.normal(0, 5, (3000, 32)), r.normal(0, 90, (100, 32))]))
    index, anchor = Index(points), np.floor(r.normal(0, 90, 32))
    scores = points @ anchor
    for t in (0.0, 5000.0, 20000.0, 40000.0):
        places, own = index.reaching(anchor, t)
        assert set(np.flatnonzero(scores >= t)) <= set(places) and (own == scores[places]).all()
    assert len(index.reaching(anchor, 20000.0)[0]) < 100
    assert len(index.reaching(anchor, -np.inf)[0]) == len(points)


def test_anchors_are_looked_up_together_and_full_windows_ask_once(monkeypatch):
    r = np.random.default_rng(6)
    points = np.floor(r.normal(0, 90, (4000, 32)))
    index, anchors = Index(points), np.floor(r.normal(0, 90, (20, 32)))
    scores, t = anchors @ points.T, r.uniform(-5000, 60000, 20)
    places, own = index.reaching_any(anchors, t)
    assert set(np.flatnonzero((scores >= t[:, None]).any(axis=0))) <= set(places) and (own == scores[:, places]).all()

    asked, was = [], Index.reaching_any
    monkeypatch.setattr(Index, "reaching_any", lambda self, a, t: (asked.append(len(a)), was(self, a, t))[1])
    ids, missing, k = np.arange(4000), np.zeros(4000, bool), 5
    best = [[hard_negatives.Best(-np.inf, np.inf, k)] for _ in anchors]
    for first in range(0, 4000, 400):
        asked.clear()
        at = ids[first : first + 400]
        best = hard_negatives._filled(best, Index(points[at]), at, anchors, lambda i, j: j % 3 > 0, ids, missing)
        assert not first or asked == [len(anchors)]
    for (b,), own in zip(best, scores, strict=True):
        fit = np.flatnonzero(ids % 3 > 0)
        assert b.at.tolist() == sorted(fit, key=lambda j: (-own[j], j))[:k]


def test_a_label_has_a_grid_of_its_own(spark, monkeypatch):
    for name, size in zip(("ANCHOR_BLOCK", "CANDIDATE_BLOCK", "PART"), (4, 30, 11), strict=True):
        monkeypatch.setattr(hard_negatives, name, size)
    was = hard_negatives._cell

    def cell(t, same_label):
        assert not same_label or len(set(t.column("label").to_pylist())) == 1
        return was(t, same_label)

    monkeypatch.setattr(hard_negatives, "_cell", cell)
    rows = clustered(7, 200) + [(200 + k, [0.1 * k] * 16, 50 + k) for k in range(20)]
    assert found(spark, rows, every=10) == by_hand(rows, 10)


def test_zero_vectors_meet_anchors_of_any_size(spark):
    rows = [(0, [1e200, -1e200], 0), (1, [0.0, 0.0], 0), (2, [0.0, 0.0], 1), (3, [1.0, 1.0], 1), (4, [1e190, 1e190], 0), (5, [-1.0, 0.0], 1)]
    assert found(spark, rows, every=10, kind="double") == by_hand(rows, 10, kind=np.float64)


def test_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows = [(i, e, (y + 1) % 10 if y is not None and i % 7 == 0 else y) for i, e, y in rows]
    df = REGISTRY["op13_hard_negatives"](spark, SF)
    mine = sorted(map(tuple, df.collect()), key=str)
    assert mine == by_hand(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    sql = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLES['op13_hard_negatives']})").fetchall()
    assert sorted(sql, key=str) == mine
