import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest_llm import ODD
from tokenizers import Tokenizer

from tallywell.llm import bpe
from tallywell.llm.common import byte_array

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load_vocabulary(PATH)


def automaton(words, vocabulary):
    data = np.frombuffer(b"".join(words), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    return bpe.Lexicon(np.frombuffer(bpe.compiled(words, *bpe.merge_words(data, at[:-1], at[1:], vocabulary)), np.uint8)), data, at


def same_as_library(texts, lexicon, vocabulary, library):
    data, bounds = byte_array(pa.array(texts, pa.string()))
    ids, at = bpe.encode_chunk(data, bounds, vocabulary, lexicon)
    raw, text_at = bpe.decode_chunk(ids, at, vocabulary)
    for i, text in enumerate(texts):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[at[i] : at[i + 1]].tolist() == want, text
        assert raw.tobytes()[text_at[i] : text_at[i + 1]].decode(errors="replace") == library.decode(want, skip_special_tokens=False)


def test_places_are_those_of_the_sorted_words_and_suffixes_are_shared(vocabulary):
    words = sorted({b"walking", b"talking", b"walked", b"talked", b"w", b" the", "é".encode()})
    lexicon, data, at = automaton(words, vocabulary)
    assert lexicon.places(data, at[:-1], at[1:]).tolist() == list(range(len(words)))
    other = b"walkwalkertalkingsq"
    found = lexicon.places(np.frombuffer(other, np.uint8), np.array([0, 4, 10, 18]), np.array([4, 10, 18, 19]))
    assert found.tolist() == [-1, -1, -1, -1]
    # w, wal..., tal... share alk(ed|ing): far fewer states than letters
    assert len(lexicon.final) < sum(map(len, words)) - 10


def test_an_empty_lexicon_holds_nothing(vocabulary):
    lexicon, *_ = automaton([], vocabulary)
    assert lexicon.places(np.frombuffer(b"ab", np.uint8), np.array([0]), np.array([2])).tolist() == [-1]


def test_random_texts_equal_the_library(vocabulary, library):
    r = random.Random(5)
    pieces = list(" \n\t\r'smtdrevl<|>endoftext0123abcÉéß漢字ａ½Ⅷ 　​😀\x1c\x1f\x85!?.,-_")
    pieces += ["<|endoftext|>", "  ", "'ll", "'re", " '", "͸", ""]
    texts = ["".join(r.choice(pieces) for _ in range(r.randrange(40))) for _ in range(3000)]
    same_as_library(texts, automaton([b" the", b"'s", b"a"], vocabulary)[0], vocabulary, library)


def test_every_kind_of_code_point_equals_the_library(vocabulary, library):
    points = [p for p in range(0, 0x110000, 37) if not 0xD800 <= p < 0xE000]
    same_as_library([f"{chr(p)}a{chr(p)}7 {chr(p)}{chr(p)}!{chr(p)}" for p in points], automaton([], vocabulary)[0], vocabulary, library)


def test_long_words_equal_the_library(vocabulary, library):
    texts = ["a" * 3000, "ab" * 900 + "<|endoftext|>", " " * 300, "aaa" * 77, "é" * 400, "\n" * 99 + "x", "=" * 33, "<|endoftext|>" * 3]
    same_as_library(texts, automaton([], vocabulary)[0], vocabulary, library)


@pytest.mark.parametrize("lexicon_words", [0, 3, 1000])
def test_documents(docs, library, lexicon_words):
    r = random.Random(2)
    rows = [*ODD, *((100 + k, " ".join(r.choice(["walk", "talk", "walking", "the", "of"]) for _ in range(50))) for k in range(40))]
    coder = bpe.BytePairCoder.train(docs(*rows), PATH, lexicon_words)
    found = sorted((str(x.doc_id), x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in coder.digests(docs(*rows)).collect())

    def want(doc_id, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        return str(doc_id), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    assert found == sorted(want(*x) for x in rows)
    encoded = coder.encode(docs(*rows))
    assert sorted((str(x.doc_id), x.text) for x in coder.decode(encoded).collect()) == sorted((str(i), t or "") for i, t in rows)


def test_no_documents(docs):
    coder = bpe.BytePairCoder.train(docs(), PATH)
    assert coder.digests(docs()).collect() == [] and coder.encode(docs()).collect() == []


def test_at_most_so_many_words_are_compiled(spark):
    from tallywell.llm.common import least_count

    counts = spark.createDataFrame([(n,) for n in [2] * 50 + [3] * 20 + [900, 901, 5000, 70000]], "n long")
    for most in (0, 1, 3, 4, 5, 24, 73, 74, 100):
        least = least_count(counts, most)
        above = counts.filter(f"n >= {least}").count()
        assert above <= most or most < 0
        assert above == max(k for k in (0, 1, 2, 3, 4, 24, 74) if k <= most)
