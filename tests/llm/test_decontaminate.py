import random

import pytest
from conftest_llm import ODD

from tallywell.llm import decontaminate
from tallywell.llm.decontaminate import MASKS, find_overlaps, without_overlaps

ITEMS = "item_id long, text string, doc_id string"


def made(spark, *rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], ITEMS)


def words(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghij") for _ in range(4)) for _ in range(n)]


def overlaps(df):
    return {(r.doc_id, r.item_id): (r.first_token, r.n_tokens, r.n_matched) for r in df.collect()}


def test_masks_have_one_span_and_weight():
    assert {len(m) for m in MASKS} == {12} and {m.count("1") for m in MASKS} == {8}


def test_a_passage_is_found_whatever_stands_around(spark, docs):
    item = words(1, 30)
    rows = [
        (1, " ".join(words(2, 40) + item + words(3, 40))),
        (2, " ".join(words(4, 100))),
        (3, "Before, " + ", ".join(w.upper() for w in item) + "! (after)"),
        (4, " ".join(words(5, 9) + item[5:18])),
        (5, " ".join(words(5, 9) + item[5:17])),  # twelve words are too few
    ]
    found = overlaps(find_overlaps(docs(*rows), made(spark, (7, " ".join(item)), (8, " ".join(words(9, 30))))))
    assert found == {(1, 7): (40, 30, 30), (3, 7): (1, 30, 30), (4, 7): (9, 13, 13)}


def test_replaced_words_are_tolerated(spark, docs):
    r = random.Random(3)
    rows, items = [], []
    for k in range(60):
        item = words(100 + k, 40)
        own = list(item)
        for place in r.sample(range(40), 4):
            own[place] = "other"
        items.append((k, " ".join(item)))
        rows.append((k, " ".join(words(500 + k, 30) + own + words(900 + k, 30))))
    found = overlaps(find_overlaps(docs(*rows), made(spark, *items)))
    assert set(found) == {(k, k) for k in range(60)}
    assert all(matched >= 13 and matched >= 0.8 * n for _, n, matched in found.values())


def test_short_items(spark, docs):
    eight, ten, seven = words(1, 8), words(2, 10), words(3, 7)
    rows = [(1, " ".join(words(9, 5) + eight)), (2, " ".join(ten[:9])), (3, " ".join(ten)), (4, " ".join(seven))]
    items = made(spark, (1, " ".join(eight)), (2, " ".join(ten)), (3, " ".join(seven)))
    assert set(overlaps(find_overlaps(docs(*rows), items))) == {(1, 1), (3, 2)}


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 300])
def test_blocks_of_the_benchmark_change_nothing(spark, docs, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate.benchmark_blocks, "__defaults__", (block_bytes,))
    items = [(k, " ".join(words(k, 20))) for k in range(12)] + [(None, "x"), (99, None), (98, ""), (3, " ".join(words(3, 20)))]
    rows = [*ODD, *((100 + k, " ".join(words(50 + k, 10) + words(k, 20)) + "é É") for k in range(6)), (200, " ".join(words(77, 60)))]
    rows += [(100, rows[len(ODD)][1])]
    found = find_overlaps(docs(*rows), made(spark, *items)).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == sorted([*((100 + k, k) for k in range(6)), (100, 0)])
    kept = without_overlaps(docs(*rows), made(spark, *items))
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, *_ in [*ODD, (200,)])
    assert {r.text is None for r in kept.filter("doc_id = 7").collect()} == {True}


def test_nothing_to_compare(spark, docs):
    assert find_overlaps(docs(), made(spark, (1, "a b"))).collect() == []
    assert find_overlaps(docs((1, "a b")), made(spark)).collect() == []
    assert without_overlaps(docs((1, "a b")), made(spark)).count() == 1
    assert find_overlaps(docs((1, "a b")), made(spark, (1, "!!"))).collect() == []


def test_a_very_long_text(spark, docs):
    item = words(1, 20)
    rows = [(1, " ".join(words(2, 300_000) + item))]
    assert overlaps(find_overlaps(docs(*rows), made(spark, (5, " ".join(item))))) == {(1, 5): (300_000, 20, 20)}


@pytest.mark.parametrize("length", range(8, 16))
def test_whole_masks_leave_no_choice_of_differing_tokens_out(length):
    from itertools import combinations

    masks = [set(m.tolist()) for m in decontaminate.whole_masks(length)]
    for places in combinations(range(length), length - -(-4 * length // 5)):
        assert any(m.isdisjoint(places) for m in masks)


def test_replaced_words_of_short_items_are_tolerated(spark, docs):
    r, rows, items = random.Random(5), [], []
    for length in range(8, 16):
        for k in range(8):
            at, item = 100 * length + k, words(1000 * length + k, length)
            own = list(item)
            for place in r.sample(range(length), length - -(-4 * length // 5) + k // 6):  # the last two of eight: one too many
                own[place] = "other"
            items.append((at, " ".join(item)))
            rows.append((at, " ".join(words(5 * at, 20) + own + words(7 * at, 20))))
    found = overlaps(find_overlaps(docs(*rows), made(spark, *items)))
    assert set(found) == {(i, i) for i, _ in items if i % 100 < 6}
    assert all(found[i, i][:2] == (20, i // 100) for i, _ in found)
    assert {r.doc_id for r in without_overlaps(docs(*rows), made(spark, *items)).collect()} == {i for i, _ in items if i % 100 >= 6}


def test_very_short_items_and_unspaced_scripts(spark, docs):
    seven, one = words(3, 7), words(4, 1)
    han = "\u4eca\u65e5\u306f\u5929\u6c17\u304c\u3068\u3066\u3082\u826f\u3044\u306e\u3067\u5916\u3067\u6563\u6b69\u3057\u305f\u3044"
    rows = [(1, " ".join(words(9, 5) + seven)), (2, " ".join(seven[:6] + ["x"])), (3, " ".join(one)), (4, "\u6628" + han + "\u304b")]
    items = made(spark, (1, " ".join(seven)), (2, one[0]), (3, han))
    assert overlaps(find_overlaps(docs(*rows), items, shortest=1)) == {(1, 1): (5, 7, 7), (3, 2): (0, 1, 1), (4, 3): (1, len(han), len(han))}
    assert [r.doc_id for r in without_overlaps(docs(*rows), items, shortest=1).collect()] == [2]
