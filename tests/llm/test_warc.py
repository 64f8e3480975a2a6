import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tallywell.llm.warc import RENEWABLE, canonical_url, resolve_revisits

KIND = "record_id long, kind string, url string, captured timestamp, status long, headers map<string,string>, canonical string, full string"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def made(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], KIND)


def at(seconds):
    return START + timedelta(seconds=seconds)


def found(df):
    return {r.record_id: (r.response_id, r.outcome, r.headers) for r in df.collect()}


def test_canonical_urls(spark):
    cases = {
        "HTTP://WWW.Example.com:80/A/b/?b=2&a=1&utm_source=x#frag": "example.com/A/b?a=1&b=2",
        "https://example.com": "example.com",
        "https://example.com/": "example.com",
        "example.com:443/x?ref=1": "example.com/x",
        "http://example.com?": "example.com",
        " http://example.com/x?reference=1 ": "example.com/x?reference=1",
        "": "",
        None: None,
    }
    rows = spark.createDataFrame([(u,) for u in cases], "u string").select("u", canonical_url(F.col("u")).alias("c")).collect()
    assert {r.u: r.c for r in rows} == cases




def test_outcomes_and_merged_headers(spark):
    u = "http://a.org/x"
    rows = [
        (1, "response", u, at(0), 200, {"etag": "1", "content-type": "t", "date": "d0", "vary": "v"}),
        (2, "response", u, at(50), 500, {"etag": "9"}),
        (3, "revisit", "https://www.a.org/x/", at(100), 304, {"etag": "1", "date": "d1", "content-type": "ignored", "new": "ignored"}),
        (4, "revisit", u, at(100), 304, {"etag": "2"}),
        (5, "revisit", u, at(100), 304, {"date": "d"}),
        (6, "revisit", u, at(-5), 304, {"etag": "1"}),
        (7, "revisit", u, at(0), 304, {"etag": "1"}),  # not later than the response
        (8, "revisit", u, at(100), 304, {"etag": "1", "last-modified": "m"}),
        (9, "revisit", u, None, 304, {"etag": "1"}),
        (10, "revisit", None, at(100), 304, None),
        (11, "revisit", "http://b.org", at(100), 304, {"etag": "1"}),
    ]
    out = found(resolve_revisits(made(spark, rows)))
    assert out[3] == (1, "resolved", {"etag": "1", "content-type": "t", "date": "d1", "vary": "v"})
    assert out[4][:2] == (1, "changed") and out[5][:2] == (1, "unchecked") and out[8][:2] == (1, "changed")
    assert {k: out[k][:2] for k in (6, 7, 9, 10, 11)} == dict.fromkeys((6, 7, 9, 10, 11), (None, "missing"))
    assert out[4][2] == {"etag": "2"} and out[10][2] == {}
    assert len(out) == 9


@pytest.mark.parametrize("stretch", [1, 60, 86_400])
def test_random_histories(spark, stretch):
    r = random.Random(stretch)
    rows = []
    for k in range(700):
        kind = r.choice(["response", "revisit"])
        url = "http://hot.org/" if k % 3 else f"http://u{k % 7}.org/p"
        headers = {h: str(r.randrange(2)) for h in ("etag", "last-modified", "date", "server") if r.random() < 0.6}
        rows.append((k, kind, url, at(r.randrange(300)), r.choice([200, 200, 404]), headers))
    out = found(resolve_revisits(made(spark, rows), stretch))
    assert len(out) == sum(x[1] == "revisit" for x in rows)
    for i, kind, url, when, _, headers in rows:
        if kind != "revisit":
            continue
        earlier = [x for x in rows if x[1] == "response" and x[4] == 200 and x[2] == url and x[3] < when]
        if not earlier:
            assert out[i] == (None, "missing", headers)
            continue
        last = max(earlier, key=lambda x: (x[3], x[0]))
        checks = [h for h in ("etag", "last-modified") if h in headers]
        outcome = "unchecked" if not checks else "resolved" if all(last[5].get(h) == headers[h] for h in checks) else "changed"
        merged = last[5] | {h: v for h, v in headers.items() if h in RENEWABLE} if outcome == "resolved" else headers
        assert out[i] == (last[0], outcome, merged)


def test_no_rows(spark):
    assert resolve_revisits(made(spark, [])).collect() == []
