import random
import re

from conftest_llm import ODD

from tallywell.llm.secrets import BASE_RULES, RULES, Rule, find_secrets, redact_secrets, trigram_query

KEY = "AKIA" + "Q" * 16
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def by_hand(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(found)]


def spans(df):
    return sorted((str(r.doc_id), [tuple(s) for s in r.spans]) for r in df.collect())


def test_queries_hold_what_a_match_needs():
    assert trigram_query("AKIA[A-Z0-9]+") == {frozenset({b"aki", b"kia"})}
    assert trigram_query("[0-9a-f]{24,}") == {frozenset()}
    assert trigram_query("abc|xyz+") == {frozenset({b"abc"}), frozenset({b"xyz"})} or trigram_query("abc|xyz+") == {frozenset()}
    assert trigram_query("ab?c") == {frozenset()}  # ac has no trigram
    assert trigram_query("(foo|bar)baz") == {frozenset({b"foo", b"oob", b"oba", b"baz"}), frozenset({b"bar", b"arb", b"rba", b"baz"})}
    assert trigram_query(".*") == {frozenset()}


def test_every_match_satisfies_its_query():
    r = random.Random(4)
    for rule in RULES:
        query, compiled = trigram_query(rule.pattern), rule.compiled()
        for _ in range(2000):
            text = "".join(r.choice(["password", "api", "_", "KEY", "token", "=", ":", "'", " ", "AKIA", "Q7" * 9, "ghp_" + "x" * 36, "xoxb-" + "1" * 12, "eyJ", "a" * 9, ".", "-----BEGIN ", "PRIVATE KEY-----"]) for _ in range(8))
            for m in compiled.finditer(text):
                held = {m[0].lower().encode()[i : i + 3] for i in range(len(m[0]))}
                assert any(way <= held for way in query)


def test_random_texts(docs):
    r = random.Random(8)
    pieces = ["password", "PassWord", "passwd", "ſecret", "secret", "toKen", "api_key", "apikey", ":", "=", " ", '"', "'", "abc123", "é", "x" * 7, KEY, KEY[:18], "0123456789abcdef", "deadbeef", "\n"]
    rows = [*ODD, *((100 + k, "".join(r.choice(pieces) for _ in range(r.randrange(14)))) for k in range(600))]
    assert spans(find_secrets(docs(*rows), BASE_RULES)) == sorted((str(i), by_hand(t)) for i, t in rows)


def test_more_rules_only_add(docs):
    text = f"é {KEY} xoxb-0123456789 password=ghp_{'g1' * 18} -----BEGIN RSA PRIVATE KEY-----"
    found = spans(find_secrets(docs((1, text))))[0][1]
    assert [s for s in found if s[0] in ("assign", "access", "hex")] == by_hand(text)
    assert {s[0] for s in found} == {"access", "chat", "assign", "forge", "pem"}
    assert all(text[a:b] for _, a, b in found)


def test_a_rule_without_trigrams_scans_all_texts(docs):
    rule = Rule("two", "[xy]z")
    assert spans(find_secrets(docs((1, "a xz yz"), (2, "zz")), (rule,))) == [("1", [("two", 2, 4), ("two", 5, 7)]), ("2", [])]


def test_redaction(docs):
    rows = [*ODD, (1, f"a password = {KEY} b {'0f' * 12}é"), (2, "clean")]
    found = {r.doc_id: r for r in redact_secrets(docs(*rows)).collect() if r.doc_id in (1, 2, 7)}
    assert found[1].text == "a [SECRET] b [SECRET]é" and found[2].text == "clean" and found[7].text is None
    assert redact_secrets(docs(*rows)).count() == len(rows) and found[2].anchor == "g"


def test_a_very_long_text(docs):
    text = "clean words " * 500_000 + KEY
    assert spans(find_secrets(docs((1, text))))[0][1] == [("access", len(text) - 20, len(text))]


def test_no_rows(docs):
    assert find_secrets(docs()).collect() == [] and redact_secrets(docs()).collect() == []
