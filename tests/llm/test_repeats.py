"""Both operators that remove repeated windows, against windows kept in a dictionary."""

import random
from collections import Counter

import numpy as np
import pytest
from conftest_llm import ODD

from tallywell.llm import anchors, bwt_dedup
from tallywell.llm.automaton_dedup import SuffixAutomaton, deduplicated_words, first_words
from tallywell.llm.bwt_dedup import deduplicated_bytes, first_bytes, parted, suffix_order


def order(rows):
    return sorted({(i if i is not None else -(1 << 63), t or "") for i, t in rows})


def cut(units, gone):
    starts = [i for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1])]
    return len(units), sum(gone), len(starts), [u for u, g in zip(units, gone, strict=True) if not g]


def by_hand_bytes(rows, width):
    first = {}
    for i, t in order(rows):
        b = t.encode()
        for k in range(len(b) - width + 1):
            first.setdefault(b[k : k + width], i)
    out = []
    for i, t in rows:
        b, key = (t or "").encode(), i if i is not None else -(1 << 63)
        gone = [False] * len(b)
        for k in range(len(b) - width + 1):
            if first[b[k : k + width]] < key:
                gone[k : k + width] = [True] * width
        n, removed, spans, kept = cut(list(b), gone)
        out.append((str(i), n, removed, spans, bytes(kept)))
    return sorted(out)


def by_hand_words(rows, width):
    first = {}
    for i, t in order(rows):
        w = t.encode().split()
        for k in range(len(w) - width + 1):
            first.setdefault(tuple(w[k : k + width]), (i, t, k))
    out = []
    for i, t in rows:
        w, key = (t or "").encode().split(), (i if i is not None else -(1 << 63), t or "")
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < (*key, k):
                gone[k : k + width] = [True] * width
        n, removed, spans, kept = cut(w, gone)
        out.append((str(i), n, removed, spans, b" ".join(kept)))
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), r.n, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect())


def corpus(seed, unit):
    r = random.Random(seed)
    passages = ["".join(r.choice(unit) for _ in range(r.randrange(20, 120))) for _ in range(6)]
    rows = []
    for k in range(90):
        text = "".join(r.choice([*passages, r.choice(unit) * r.randrange(9), "".join(r.choice(unit) for _ in range(r.randrange(50)))]) for _ in range(r.randrange(5)))
        rows.append((k * 7 % 97 + 20, text))
    rows += [(500 + k, rows[3][1]) for k in range(20)]  # copies
    rows += [(600 + k, f"{k} " * 3 + passages[0][:30] + f" {k}" * 9) for k in range(40)]  # a phrase in many contexts
    return rows


UNITS = (["ab ", "b", "c é", "d ", "\n"], [" a", " b", " c", "\td"], [" a"])


@pytest.mark.parametrize("bucket_bytes", [1 << 20, 2000, 50])
@pytest.mark.parametrize("seed", [0, 1, 2])
def test_bytes(docs, monkeypatch, seed, bucket_bytes):
    monkeypatch.setattr(anchors, "BUCKET_BYTES", bucket_bytes)  # 50: all anchors are crowded
    monkeypatch.setattr(anchors, "LONGEST", (256, 3, 1)[seed])
    rows = [*(x for x in ODD if x[0] != 11), *corpus(seed, UNITS[seed])]
    assert found(deduplicated_bytes(docs(*rows), 12, 5)) == by_hand_bytes(rows, 12)


@pytest.mark.parametrize("bucket_bytes", [1 << 20, 2000, 50])
@pytest.mark.parametrize("seed", [0, 1, 2])
def test_words(docs, monkeypatch, seed, bucket_bytes):
    monkeypatch.setattr(anchors, "BUCKET_BYTES", bucket_bytes)  # 50: all anchors are crowded
    monkeypatch.setattr(anchors, "LONGEST", (256, 3, 1)[seed])
    rows = [*(x for x in ODD if x[0] != 11), *corpus(seed, UNITS[seed])]
    assert found(deduplicated_words(docs(*rows), 6, 2)) == by_hand_words(rows, 6)


def test_repeated_rows_are_one_document(docs):
    text = "one two three four five six seven"
    rows = [(1, text), (1, text), (2, text)]
    assert [(r.n_removed, r.doc_id) for r in deduplicated_words(docs(*rows), 4, 2).orderBy("doc_id").collect()] == [(0, 1), (0, 1), (7, 2)]
    assert [r.n_removed for r in deduplicated_bytes(docs(*rows), 9, 4).orderBy("doc_id").collect()] == [0, 0, len(text)]


def test_texts_under_one_doc_id(docs):
    rows = [(1, "a b c d e f x"), (1, "a b c d e f y")]
    assert sorted(r.n_removed for r in deduplicated_words(docs(*rows), 4, 2).collect()) == [0, 6]
    assert [r.n_removed for r in deduplicated_bytes(docs(*rows), 8, 4).collect()] == [0, 0]


def test_a_repeat_within_a_document(docs):
    rows = [(1, "a b c d e " * 3), (2, "x " * 40)]
    assert found(deduplicated_words(docs(*rows), 5, 2)) == by_hand_words(rows, 5)
    assert all(r.n_removed == 0 for r in deduplicated_bytes(docs(*rows), 8, 4).collect())


def test_very_long_texts(docs):
    r = random.Random(5)
    long = " ".join(str(r.randrange(10**6)) for _ in range(200_000))
    rows = [(1, long), (2, "start " + long[:5000] + " end"), (3, "z " * 100_000)]

    assert found(deduplicated_words(docs(*rows))) == by_hand_words(rows, 20)
    assert found(deduplicated_bytes(docs(*rows))) == by_hand_bytes(rows, 50)


def test_no_rows(docs):
    assert deduplicated_words(docs()).collect() == [] and deduplicated_bytes(docs()).collect() == []


def test_searches_find_the_first_place():
    r = random.Random(3)
    for _ in range(200):
        width, letters = r.choice([1, 2, 3, 5, 9]), r.choice(["ab", "abc", "abcdefgh"])
        contents = ["".join(r.choice(letters) for _ in range(r.randrange(width, width + 12))) for _ in range(r.randrange(2, 9))]
        places = [(k, i) for k, c in enumerate(contents) for i in range(len(c) - width + 1)]
        window = {p: contents[p[0]][p[1] : p[1] + width] for p in places}
        want = [next(q for q in places if window[q] == window[p]) for p in places]
        same = np.zeros(len(contents), np.int64)
        for search, shaped in ((first_bytes, [c.encode() for c in contents]), (first_words, [" ".join(c).encode() for c in contents])):
            _, owner, place = search(shaped, same, width)
            assert list(zip(owner.tolist(), place.tolist(), strict=True)) == want


def test_common_prefixes_come_out_up_to_the_threshold():
    r = random.Random(7)
    for _ in range(100):
        text = np.array([r.randrange(1, 4) for _ in range(r.randrange(2, 60))] + [0], np.uint16)
        threshold = r.choice([1, 2, 5, 10])
        rows = suffix_order(text, threshold + 1)
        common = parted(text[rows - 1], threshold)
        for i in range(1, len(rows)):
            a, b = text[rows[i - 1] :].tolist(), text[rows[i] :].tolist()
            n = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert min(common[i], threshold) == min(n, threshold)


def test_matching_statistics_of_other_texts():
    automaton = SuffixAutomaton()
    for x in [1, 2, 3, 4, 1, 2, 3, 5]:
        automaton.add(x)
    assert automaton.matches([1, 2, 3, 5, 9, 2, 3, 4], 3) == [-1, -1, 2, 7, -1, -1, -1, 3]


@pytest.mark.parametrize("words", [True, False])
def test_anchors_are_counted_over_all_texts(docs, monkeypatch, words):
    monkeypatch.setattr(anchors, "SCAN", 300)
    monkeypatch.setattr(anchors, "ANCHORS_HELD", 40)
    units = anchors.Units(*((6, 2) if words else (12, 5)), words, words)
    rows = corpus(1, UNITS[1])
    want = Counter()
    for _, text in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        hashes, _, _, first = units.split(data, np.array([0, len(data)]))
        p = anchors.pieces(hashes, first, units)
        want.update(set(p.anchor.tolist()))
        want.update(p.anchor[p.twice].tolist())
    counted = anchors.repeated_anchors(anchors.keyed(docs(*rows)), units).collect()
    assert sorted((r.anchor, r.n) for r in counted) == sorted((a, n) for a, n in want.items() if n > 1)


def test_pieces_go_out_once_for_each_bucket(docs, monkeypatch):
    monkeypatch.setattr(anchors, "CHUNK", 500)
    monkeypatch.setattr(anchors, "SCAN", 500, raising=False)
    r = random.Random(9)
    texts = ["".join(r.choice("abcdefgh ") for _ in range(300)) for _ in range(20)]
    rows = anchors.keyed(docs(*[(k, texts[k % 20]) for k in range(40)], parts=1))
    units = anchors.Units(50, 20, False, False)
    found = anchors.repeated_anchors(rows, units)
    bits, crowds = anchors.sieve(found), anchors.sieve(found.filter("n > 100"), anchors.CROWDED_SIEVE_BITS)
    packed = anchors.packed_pieces(rows, units, bits, crowds, 3).collect()
    assert sorted(x.bucket for x in packed) == [0, 1, 2]
    windows = Counter()
    for x in packed:
        for d, n in zip(x.d, x.n, strict=True):
            windows[d] += n
    assert windows == {k: 251 for k in range(40)}


def test_windows_that_occur_once_are_not_sorted(monkeypatch):
    r = random.Random(8)
    shared, own = ["".join(r.choice("abc") for _ in range(60)) for _ in range(2)]
    contents = [(own + shared).encode(), b"x" * 49 + shared.encode(), own[::-1].encode()]
    sizes, sort = [], bwt_dedup.suffix_order
    monkeypatch.setattr(bwt_dedup, "suffix_order", lambda text, depth: (sizes.append(len(text)), sort(text, depth))[1])
    number, owner, place = first_bytes(contents, np.zeros(3, np.int64))
    assert sizes == [2 * 61]
    want = [(0, k) for k in range(71)] + [(1, k) for k in range(49)] + [(0, 60 + k) for k in range(11)] + [(2, k) for k in range(11)]
    assert list(zip(owner.tolist(), place.tolist(), strict=True)) == want
