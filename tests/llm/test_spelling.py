import random
import re
import zlib
from collections import Counter

import pytest
from conftest_llm import ODD

from tallywell.llm import spelling
from tallywell.llm.queries import REGISTRY
from tallywell.llm.spelling import (
    AFTER,
    BEFORE,
    LONGEST,
    SHORTEST,
    Decomposition,
    counted_words,
    gram_dictionary,
    letter_runs,
    near_words,
    spelling_variants,
)

SF = "/root/testdata/sf0.001"


def rests(word):
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return min(a, b, key=len) in rests(max(a, b, key=len))


def by_hand(counts):
    meeting = {}
    for w in counts:
        for rest in {w} | rests(w):
            meeting.setdefault(rest, set()).add(w)
    found = {}
    for w, n in counts.items():
        others = {x for rest in {w} | rests(w) for x in meeting[rest] if near(w, x)}
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        found[w] = (best if best is not None and counts[best] >= 2 * n else None, n, len(others))
    out = {}
    for w, (form, n, n_near) in found.items():
        root = w
        while found[root][0] is not None:
            root = found[root][0]
        out[w] = (form, root, n, n_near, None if form is None else counts[form])
    return out


def as_found(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def frame(spark, counts):
    return spark.createDataFrame([(w, n, "clash", 1) for w, n in counts.items()], "word string, n long, near string, key int").repartition(3)


def invented(seed, number, letters="abcé"):
    r = random.Random(seed)
    words = {"".join(r.choice(letters) for _ in range(r.randint(3, 12))) for _ in range(number)}
    for w in list(words)[: number // 2]:
        i = r.randrange(len(w))
        words |= {w[:i] + w[i + 1 :], w[:i] + r.choice(letters) + w[i:], w[:i] + r.choice(letters) + w[i + 1 :]}
    return {w: r.choice((1, 2, 3, 5, 8, 20, 100)) for w in sorted(words)}


def dictionary(words, limit):
    counts = Counter(p[i : i + q] for w in words for p in [BEFORE + w + AFTER] for q in range(SHORTEST, LONGEST + 1) for i in range(len(p) - q + 1))
    found = {g: n for g, n in counts.items() if len(g) == SHORTEST}
    for stem in [g for g, n in counts.items() if n > limit]:
        held = 0
        for n, g in sorted((n, g) for g, n in counts.items() if len(g) > SHORTEST and g[:-1] == stem):
            held += n
            if held > limit:
                found[g] = n
    return found


@pytest.mark.parametrize("seed", range(4))
def test_an_edit_changes_no_more_grams_than_said(seed):
    words = sorted(invented(seed, 60, "ab" if seed % 2 else "abcd"))
    cut = Decomposition(dictionary(words, 5 + 10 * seed))
    r = random.Random(seed)

    def grams(word):
        padded = BEFORE + word + AFTER
        own = cut.grams(padded)
        return Counter(padded[a:b] for a, b, _ in own), cut.affected(padded, own)

    for w in words:
        own, most = grams(w)
        for _ in range(12):
            i, c = r.randrange(len(w) + 1), r.choice("abcdz")
            for other in (w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]):
                assert sum((own - grams(other)[0]).values()) <= most


def test_the_dictionary_is_pruned_by_frequency(spark):
    words = invented(3, 80)
    found = gram_dictionary(frame(spark, words), limit=9)
    assert set(found) == set(dictionary(words, 9))
    assert {g for g in found if len(g) > SHORTEST} and len(gram_dictionary(frame(spark, words), limit=9, most=20)) <= 20


@pytest.mark.parametrize("limit", [3, 64])
def test_all_near_words_are_found(spark, monkeypatch, limit):
    monkeypatch.setattr(spelling, "LIMIT", limit)
    monkeypatch.setattr(spelling.gram_dictionary, "__defaults__", (limit, spelling.MOST_GRAMS))
    counts = invented(limit, 250)
    assert as_found(spelling_variants(frame(spark, counts))) == by_hand(counts)


def test_words_without_sure_grams_meet_otherwise(spark, monkeypatch):
    counts = invented(9, 40, "ab") | {"": 3, "a": 9, "b": 1}
    monkeypatch.setattr(Decomposition, "affected", lambda self, padded, grams: len(grams))
    assert as_found(spelling_variants(frame(spark, counts))) == by_hand(counts)


def test_empty_and_one_letter_words_ties_and_very_long_words(spark):
    long = "abcdefghij" * 400
    counts = {"": 1, "a": 2, "b": 2, "ab": 7, "😀": 2, "x\x02y": 1, "xy": 5, long: 1, long[:-1] + "x": 4, long + "j": 4}
    assert as_found(spelling_variants(frame(spark, counts))) == by_hand(counts)
    assert as_found(spelling_variants(frame(spark, {}).filter("false"))) == {}
    assert near_words(frame(spark, {"abcde": 1})).count() == 0


def test_forms_are_followed_to_the_last(spark):
    words = ["abcdefgh" + "x" * k for k in range(9)]
    counts = {w: 3 * 2**k for k, w in enumerate(words)}
    found = as_found(spelling_variants(frame(spark, counts)))
    assert found == by_hand(counts) and {r[1] for r in found.values()} == {words[-1]}


def test_runs_and_counts(spark, docs):
    rows = [*ODD, (20, "Éa ÉA éa×b÷C 1abcde2 Abcde aBCDE ABCDE_x ñandú Ā"), (21, "abcde " * 40000)]
    found = Counter(r.run for r in letter_runs(docs(*rows)).collect())
    texts = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for _, t, *_ in rows]
    want = Counter(x for t in texts for x in re.findall("[A-Za-zÀ-ÿ]+", t))
    assert found == want
    counted = counted_words(letter_runs(docs(*rows)).withColumnRenamed("run", "word"))
    assert {r.word: r.n for r in counted.collect()} == {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}
    assert letter_runs(docs()).count() == 0


def test_query(spark):
    counts = Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    assert as_found(REGISTRY["op11_spelling_variants"](spark, SF)) == by_hand(counts)
