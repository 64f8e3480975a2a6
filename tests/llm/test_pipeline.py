"""The pipeline on a small corpus, each stage against a plain version of it."""

import random

import public_tokenizers
from test_secrets import KEY
from test_simhash import classes, fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from tallywell.llm.kneser_ney import judged

WORDS = [f"{a}{b}" for a in ("ba", "ke", "lo", "mi", "su") for b in ("ra", "te", "no", "pi", "", "x")]


def text(r, n):
    return " ".join(r.choices(WORDS, [1 / (k + 1) for k in range(len(WORDS))], k=n))


def corpus():
    r = random.Random(11)
    docs = [(k, text(r, r.randrange(30, 90)), "en") for k in range(400)]
    items = [(k, " ".join(f"q{r.randrange(40)}" for _ in range(25))) for k in range(3)]
    docs += [(500 + k, docs[k][1], "en") for k in range(40)]  # copies
    docs += [(600 + k, f"{text(r, 150)} {items[k % 3][1]} {text(r, 150)}", "en") for k in range(12)]
    docs += [(700 + k, f"{text(r, 80)} password={KEY} {text(r, 20)} é", None) for k in range(12)]
    docs += [(800 + k, " ".join(f"zz{r.randrange(10**6)}" for _ in range(40)), "en") for k in range(12)]  # junk
    docs += [(900, None, "en"), (901, "", None), (902, " \n", "en"), (None, text(r, 50), "en"), (399, docs[399][1], "en")]
    return docs, items


def made(spark, folder):
    docs, items = corpus()
    full = [(i, t, lang, "src", len(t or "")) for i, t, lang in docs]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(full, schema).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(300)] + [(800, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, items


def test_stages(spark, tmp_path):
    rows, items = made(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == list(corpus_pipeline.COLUMNS)
        after.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        found[name] = docs.collect()
    quality, distinct, clean, redacted, tokens = found.values()

    verdicts = judged(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()
    assert sorted(str(r.doc_id) for r in quality) == sorted(str(r.doc_id) for r in verdicts if r.keep)
    kept = {r.doc_id for r in quality}
    assert len(kept & set(range(400))) > 390 and not kept & set(range(800, 903))

    links, best = classes([fingerprint(r.text) for r in quality], 2), {}
    for r, c in zip(quality, links, strict=True):
        best[c] = min((x for x in (best.get(c), r.doc_id) if x is not None), default=None)
    assert sorted(map(str, best.values())) == sorted(str(r.doc_id) for r in distinct)
    assert {r.doc_id: r.text for r in distinct}.items() <= {r.doc_id: r.text for r in quality}.items()

    held = {r.doc_id for r in distinct if any(x in r.text for _, x in items)}
    assert held and {r.doc_id for r in clean} == {r.doc_id for r in distinct} - held

    assert {r.doc_id for r in redacted} == {r.doc_id for r in clean}
    before = {r.doc_id: r.text for r in clean}
    for r in redacted:
        assert r.text == before[r.doc_id].replace(f"password={KEY}", "[SECRET]") and r.n_chars == len(r.text)
    assert any("[SECRET]" in r.text for r in redacted)

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert {r.doc_id: r.ids for r in tokens} == {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in redacted}
    assert all(r.n_tokens == len(r.ids) for r in tokens)


def test_run_gives_the_last_stage(spark, tmp_path):
    made(spark, tmp_path)
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert result.columns == ["doc_id", "n_tokens", "ids"] and result.count() > 300


def test_empty_tables(spark, tmp_path):
    for name, schema in (
        ("documents", "doc_id long, text string, lang string, source string, n_chars long"),
        ("labels", "doc_id long, quality int, toxic int"),
        ("benchmark", "item_id long, text string"),
    ):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_ids_do_not_tell_groups_apart(spark):
    r = random.Random(12)
    a, b, c, d, e = (text(r, 60) for _ in range(5))
    rows = [(None, a), (None, b), (1, c), (1, d), (2, d), (3, None), (3, e), (None, e), (4, a), (1, c)]
    docs = spark.createDataFrame([(i, t, "en", "src", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = [(r.doc_id, r.text) for r in corpus_pipeline.distinct_documents(spark, docs, "").collect()]
    assert sorted(found, key=str) == sorted([(None, b), (1, c), (1, d), (3, None), (3, e), (4, a)], key=str)
