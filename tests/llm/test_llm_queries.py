"""The registered queries over the smallest given tables, against plain versions."""

import hashlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from test_repeats import by_hand_bytes, by_hand_words
from test_secrets import by_hand
from test_simhash import classes, fingerprint
from test_topk import by_hand as by_hand_top
from tokenizers import Tokenizer

from tallywell.llm.queries import ORACLES, REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def rows(spark, name):
    return REGISTRY[name](spark, SF).collect()


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_chat(spark):
    turns = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    turns[-1] = [(role, "<|im_end|><|im_start|>assistant ok") for role in ("user", "assistant")]
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows(spark, "op1_chat_format")}
    want = {}
    for conv, own in turns.items():
        loss = "".join(t for role, t in own if role == "assistant")
        want[conv] = (len(own), sha("".join(f"{a}\n{t}\n" for a, t in own).encode()), len(loss), sha(loss.encode()))
    assert found == want


def test_bpe(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows(spark, "op3_bpe")}
    for doc_id, text in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert found[doc_id] == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(decoded.encode()))
    assert len(found) == len(documents)


def test_simhash(spark, documents):
    prints = [fingerprint(t) for _, t in documents]
    linked, least = classes(prints, 2), {}
    for (doc_id, _), c in zip(documents, linked, strict=True):
        least[c] = min(least.get(c, doc_id), doc_id)
    want = {d: (f"{p:016x}", least[c]) for (d, _), p, c in zip(documents, prints, linked, strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows(spark, "op4_simhash")} == want


def test_secrets(spark, documents):
    found = {r.doc_id: r for r in rows(spark, "op5_secret_scan")}
    assert len(found) == len(documents)
    for doc_id, text in documents:
        spans, r = by_hand(text), found[doc_id]
        joined = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert r.base_sha256 == sha(",".join(joined).encode())
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in spans) for k in ("assign", "access", "hex"))
        assert [s for s in r.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")] == joined


def test_top_k(spark):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, rows(spark, "op6_top_k")), key=str) == by_hand_top(vectors, 5, 50)


def test_overlaps(spark, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = {(r.doc_id, r.item_id) for r in rows(spark, "op8_decontaminate")}
    assert {(d, i) for d, t in documents for i, x in items if x in t} <= found
    by_id, texts = dict(documents), dict(items)
    for d, i in found:  # nothing is called an overlap that shares few words with its item
        assert len(set(texts[i].lower().split()) & set(by_id[d].lower().split())) >= 8


def test_repeated_bytes(spark, documents):
    want = [(int(d), n, removed, spans, sha(kept)) for d, n, removed, spans, kept in by_hand_bytes(documents, 50)]
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows(spark, "op9_bwt_dedup")]
    assert sorted(found) == sorted(want)


def test_repeated_words(spark, documents):
    want = [(int(d), n, removed, sha(kept)) for d, n, removed, _, kept in by_hand_words(documents, 20)]
    found = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows(spark, "op10_automaton_dedup")]
    assert sorted(found) == sorted(want)


def test_quality_keeps_good_documents(spark):
    kept = {r.doc_id for r in rows(spark, "op7_kneser_ney")}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good = {r.doc_id for r in labels if r.quality == 1 and r.toxic == 0}
    bad = {r.doc_id for r in labels} - good
    assert len(kept & good) >= 0.95 * len(good) and len(kept & bad) <= 0.7 * len(bad)  # few to learn from here


def test_revisits_match_sql(spark):
    df = REGISTRY["op2_warc_revisit"](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    result = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLES['op2_warc_revisit']})").fetchall()
    assert sorted(map(str, result)) == sorted(str(tuple(r)) for r in df.collect())
