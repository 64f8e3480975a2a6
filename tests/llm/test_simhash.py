import random
import re

import numpy as np
import xxhash
from conftest_llm import ODD

from tallywell.llm import simhash
from tallywell.llm.components import components
from tallywell.llm.simhash import Part, allocate, group_bits, links, near_duplicates

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, distance):
    """The place of the first value that each is linked with."""
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= distance:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(values))]


def check(docs, rows):
    prints = [fingerprint(t) for _, t in rows]
    found = classes(prints, 2)
    least = {}
    for (doc_id, _), c in zip(rows, found, strict=True):
        least[c] = min((x for x in (least.get(c), doc_id) if x is not None), default=None)
    want = sorted((str(i), f"{p:016x}", str(least[c])) for (i, _), p, c in zip(rows, prints, found, strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in near_duplicates(docs(*rows)).collect()) == want


def test_odd_rows(docs):
    check(docs, list(ODD))
    check(docs, [(None, "a b c d"), (None, "a b c d"), (3, "x")])


def test_near_copies(docs):
    r = random.Random(6)
    vocabulary = [f"w{k}" for k in range(300)]
    rows = []
    for group in range(30):
        words = [r.choice(vocabulary) for _ in range(r.choice([1, 2, 5, 40, 300]))]
        for _ in range(r.randrange(1, 8)):
            own = list(words)
            if r.random() < 0.6:
                own[r.randrange(len(own))] = r.choice(vocabulary)
            rows.append((len(rows) * 3 % 101, (" " if r.random() < 0.7 else "\t\n").join(own).upper() if group % 4 == 0 else " ".join(own)))
    check(docs, rows)


def as_long(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def brute_links(values, distance):
    own = sorted({as_long(v) for v in values})
    a = np.array(own, np.int64)
    return {(own[i], own[j]) for i in range(len(own)) for j in np.flatnonzero(np.bitwise_count((a ^ a[i]).view(np.uint64)) <= distance).tolist() if j > i}


def test_links_are_all_pairs_within_the_distance(spark, monkeypatch):
    r = random.Random(9)
    values = [0]
    for _ in range(60):
        base = r.getrandbits(64)
        values += [base] + [base ^ sum(1 << b for b in r.sample(range(64), r.randrange(5))) for _ in range(12)]
    for crowded, distance in ((500, 2), (1, 2), (3, 3), (500, 0), (500, 1)):
        monkeypatch.setattr(simhash, "CROWDED", crowded)
        nodes = spark.createDataFrame([(as_long(v),) for v in set(values)], "fingerprint long")
        assert {(x.a, x.b) for x in links(nodes, distance).collect()} == brute_links(values, distance)


def test_unequal_thresholds_find_the_same_links(spark, monkeypatch):
    r = random.Random(10)
    base = r.getrandbits(64)
    values = {base ^ sum(1 << b for b in r.sample(range(64), r.randrange(4))) for _ in range(300)}
    nodes = spark.createDataFrame([(as_long(v),) for v in values], "fingerprint long")
    low, high, rest = tuple(range(20)), tuple(range(20, 40)), tuple(range(40, 64))
    for parts in ([Part(low + high, 1), Part(rest, 0)], [Part(low, 2), Part(high + rest, -1)][:1], [Part(low, 0), Part(high, 0), Part(rest, 0)]):
        monkeypatch.setattr(simhash, "allocate", lambda *_, parts=parts: parts)
        want = brute_links(values, 2)
        found = {(x.a, x.b) for x in links(nodes, 2).collect()}
        # [low: 2, others: -1] adds up to 2 - 2 + 1 as well: pairs within 2 bits are within 2 in any group
        assert found == want


def test_allocation_adds_up_and_follows_the_size():
    for n in (2, 10_000, 10**7, 10**10):
        sums = np.zeros((65, 64))
        parts = allocate(n, sums, 2)
        left_out = [m for m in range(1, 6) if sum(p.threshold for p in parts) - (m - len(parts)) == 2 - m + 1]
        assert left_out, parts
    few, many = (sum(len(p.flips()) for p in allocate(n, np.zeros((65, 64)), 2)) for n in (10_000, 10**10))
    assert many > few  # a large corpus gets wider groups and more probes


def test_correlated_bits_share_a_group():
    n = 1000
    sums = np.zeros((65, 64))
    for b in range(64):
        sums[b, b] = n
    for a, b in ((0, 63), (5, 40), (7, 21)):
        sums[a, b] = sums[b, a] = 0.9 * n
    groups = group_bits(n, sums, 3)
    assert sorted(b for g in groups for b in g) == list(range(64))
    for pair in ((0, 63), (5, 40), (7, 21)):
        assert any(set(pair) <= set(g) for g in groups)


def test_components_of_a_long_path_a_star_and_a_circle(spark):
    path = [(i, i + 1) for i in range(0, 200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    circle = [(2000 + i, 2000 + (i + 7) % 50) for i in range(50)]
    edges = spark.createDataFrame([(b, a) for a, b in path + star + circle] + [(5, 5), (0, 1)], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    want = {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)} | {2000 + i: 2000 for i in range(1, 50)}
    assert found == want
    assert components(edges.limit(0)).collect() == []


def test_a_very_long_text(docs):
    text = "word " * 400_000
    check(docs, [(1, text), (2, text + "more"), (3, "other words here")])


def test_no_rows(docs):
    assert near_duplicates(docs()).collect() == []
