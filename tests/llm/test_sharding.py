import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest_llm import ODD

from tallywell.llm import sharding
from tallywell.llm.queries import REGISTRY
from tallywell.llm.sharding import place, sharded, write_shards

SF = "/root/testdata/sf0.001"


def check(rows, docs, shards=16):
    """Every row is there once with its size and checksum, and slots have no gaps; returns loads and shards of each text."""
    raw = [(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in docs]
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=str) == sorted(raw, key=str)
    slots, loads, where = defaultdict(list), np.zeros((shards, 2)), defaultdict(set)
    for r in rows:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        loads[r.shard] += (r.size, 1)
        where[r.text_crc32, r.size].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return loads, where


def texts(seed, n, longest=400):
    r = np.random.default_rng(seed)
    return [(k, " ".join(f"w{x}" for x in r.integers(0, 10**6, r.integers(1, longest)))) for k in range(n)]


def test_bytes_and_rows_are_balanced(spark, docs):
    rows = texts(1, 3000)
    rows += [(3000 + k, rows[k % 7][1]) for k in range(700)]  # groups of a hundred copies
    loads, where = check(sharded(docs(*rows)).collect(), rows)
    assert loads[:, 0].max() <= 1.001 * loads[:, 0].min()
    assert loads[:, 1].max() <= 2.5 * loads[:, 1].min()  # the copies are many rows of few bytes
    assert all(len(s) == 1 for s in where.values())


def test_a_group_larger_than_a_shard_is_split(spark, docs):
    rows = texts(2, 1200) + [(2000 + k, "the same text in a third of all rows") for k in range(600)]
    loads, where = check(sharded(docs(*rows, parts=7)).collect(), rows)
    spread = [s for s in where.values() if len(s) > 1]
    assert len(spread) == 1 and len(spread[0]) > 4
    assert loads[:, 0].max() <= 1.01 * loads[:, 0].min() and loads[:, 1].max() <= 1.5 * loads[:, 1].min()


def test_odd_rows(spark, docs):
    loads, where = check(sharded(docs(*ODD)).collect(), ODD)
    assert all(len(s) == 1 for s in where.values())
    assert sharded(docs()).count() == 0


def test_one_text_larger_than_a_shard(spark, docs):
    rows = [(0, "x" * 500_000), *texts(3, 300, 40)]
    loads, _ = check(sharded(docs(*rows)).collect(), rows)
    others = np.sort(loads[:, 0])[:-1]
    assert others.max() <= 1.02 * others.min()


def test_only_equal_rows(spark, docs):
    rows = [(None, None)] * 40 + [(1, "")] * 24
    loads, _ = check(sharded(docs(*rows)).collect(), rows)
    assert set(loads[:, 1]) == {4}


@pytest.mark.parametrize("shards", [1, 3])
def test_other_numbers_of_shards_and_own_tokens(spark, docs, shards):
    rows = texts(4, 200, 30)
    df = docs(*rows)
    found = sharded(df, shards, columns=("doc_id", "text", "bucket"), tokens=df.n_chars if "n_chars" in df.columns else None)
    check(found.collect(), rows, shards)
    assert {r.bucket for r in found.collect()} == {"i"}


def test_dot_product_balances_unlike_items():
    # Half of the items are heavy in bytes, half in rows: bytes alone would not tell them apart.
    items = np.array([[8, 8, 1]] * 64 + [[1, 1, 8]] * 64, float)
    found = place(items, 8)
    loads = np.array([items[found == k].sum(axis=0) for k in range(8)])
    assert (loads == loads[0]).all()


def test_the_driver_holds_few_items(spark, docs, monkeypatch):
    sizes = []
    monkeypatch.setattr(sharding, "place", lambda items, shards: sizes.append(len(items)) or place(items, shards))
    monkeypatch.setattr(sharding, "BUNDLES", 8)
    monkeypatch.setattr(sharding, "OWN_PART", 4)
    rows = texts(5, 2000, 20)
    check(sharded(docs(*rows)).collect(), rows)
    assert sizes[0] <= 4 * 8


def test_shards_are_written_in_order(spark, docs, tmp_path):
    rows = texts(6, 100, 20)
    write_shards(sharded(docs(*rows), 4, columns=("doc_id", "text")), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id, r.text) for r in back.collect()) == rows
    assert {f.name for f in (tmp_path / "out").iterdir() if f.is_dir()} == {f"shard={k}" for k in range(4)}


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = REGISTRY["op12_sharding"](spark, SF).collect()
    loads, where = check(rows, docs)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    largest = max(len((t or "").encode()) + 1 for _, t in docs)
    assert loads[:, 0].max() <= loads[:, 0].min() + largest
