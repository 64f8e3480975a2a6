import itertools

import pytest
from pyspark.sql import functions as F

from tallywell.operators.remediate import EMPTY_STATUS_RULE, register_repair, repair_column
from tallywell.operators.validate import Policy, clean_rows, classify, quarantined_rows, violations
from tallywell.streaming.pipeline import silver_from

DAY = "2026-01-01 10:00:00"

# status, amount, order id, customer id, time -> label, route
TABLE = [
    (("packed", "1e3", "o", "c", DAY), "VALID", "clean"),
    (("", "7.125", "o", "c", DAY), "EMPTY_STATUS", "clean"),
    (("shipped", "-1_000", "o", "c", DAY), "NEGATIVE_VALUE", "quarantine"),
    (("", "-5", "o", "c", DAY), "EMPTY_STATUS", "clean"),
    (("   ", "5", "o", "c", DAY), "EMPTY_STATUS", "clean"),
    (("shipped", "abc", "o", "c", DAY), "VALID", "clean"),
    (("shipped", "5", "", "c", DAY), "INVALID", "quarantine"),
    (("shipped", "5", None, "c", DAY), "INVALID", "quarantine"),
    (("shipped", "5", "  ", "c", DAY), "INVALID", "quarantine"),
    (("", "5", "  ", "c", DAY), "EMPTY_STATUS", "clean"),
    (("", "5", "o", "", DAY), "EMPTY_STATUS", "quarantine"),
    (("shipped", "5", "o", "c", ""), "VALID", "quarantine"),
    (("shipped", "5", "o", "c", "garbage"), "VALID", "quarantine"),
    (("shipped", "NaN", "o", "c", DAY), "INVALID", "quarantine"),
    (("shipped", "-Infinity", "o", "c", DAY), "INVALID", "quarantine"),
    (("shipped", "-0.004", "o", "c", DAY), "NEGATIVE_VALUE", "quarantine"),
    (("shipped", "-0.00", "o", "c", DAY), "VALID", "clean"),
    ((None, None, "o", "c", DAY), "EMPTY_STATUS", "clean"),
    (("shipped", "-5", "", "c", DAY), "NEGATIVE_VALUE", "quarantine"),
]


def event(i, status, amount, order, customer, at):
    return (f"i{i}", order, customer, status, at, amount)


def test_truth_table(events):
    df = classify(events(*[event(i, *row) for i, (row, _, _) in enumerate(TABLE)]))
    got = {r["ingest_id"]: (r["validation_status"], r["route"]) for r in df.collect()}
    for i, (row, label, route) in enumerate(TABLE):
        assert got[f"i{i}"] == (label, route), row


def test_routes_are_disjoint_and_exhaustive(events):
    ids = [None, "", " ", "x"]
    amounts = [None, "", "1", "-1", "nan", "abc"]
    rows = itertools.product(["", " ", None, "ok"], amounts, ids, ids, [DAY, "", None, "x"])
    rows = [event(i, *row) for i, row in enumerate(rows)]
    for policy in (Policy(), Policy(True, True, "all"), Policy(route_on="all"), Policy(blank_is_empty=True)):
        df = classify(events(*rows), policy)
        assert df.filter(F.col("route").isNull() | F.col("validation_status").isNull()).count() == 0
        assert clean_rows(df).count() + quarantined_rows(df).count() == len(rows)


def test_violations_list_what_the_label_hides(events):
    df = events(event(0, "", "-5", "", "c", ""), event(1, "ok", "abc", "o", "c", DAY), event(2, "ok", "1", "o", "c", DAY))
    loose = [r[0] for r in df.select(violations()).collect()]
    strict = [r[0] for r in df.select(violations(Policy(strict_amount=True))).collect()]
    assert loose == [["EMPTY_STATUS", "NEGATIVE_VALUE", "INVALID_ID", "MISSING_DATE"], [], []]
    assert strict[1] == ["UNREADABLE_VALUE"]


def test_policies(events):
    rows = [event(0, "", "-5", "o", "c", DAY), event(1, "ok", "abc", "o", "c", DAY), event(2, "", "5", " ", "c", DAY)]
    routes = {}
    for name, policy in {
        "all": Policy(route_on="all"),
        "strict": Policy(strict_amount=True),
        "blank": Policy(blank_is_empty=True),
    }.items():
        df = classify(events(*rows), policy).orderBy("ingest_id")
        routes[name] = [r["route"] for r in df.collect()]
    assert routes["all"] == ["quarantine", "clean", "quarantine"]
    assert routes["strict"] == ["clean", "quarantine", "clean"]
    assert routes["blank"] == ["clean", "clean", "quarantine"]
    with pytest.raises(ValueError):
        Policy(route_on="some")


def test_blank_status_is_repaired_only_when_asked(events):
    df = events(event(0, "  ", "5", "o", "c", DAY))
    for policy, status, rule in ((Policy(), "  ", None), (Policy(blank_is_empty=True), "UNKNOWN", "FIX_BLANK_STATUS")):
        row = silver_from(classify(df, policy), policy).first()
        assert (row["order_status"], row["_remediation_rule"]) == (status, rule)


def test_repair_and_provenance(spark):
    df = spark.createDataFrame([("o1", "delivered"), ("o2", ""), ("o3", None)], "order_id string, order_status string")
    rows = repair_column(df, "order_status", EMPTY_STATUS_RULE).orderBy("order_id").collect()
    assert [r["order_status"] for r in rows] == ["delivered", "UNKNOWN", "UNKNOWN"]
    assert [r["_is_remediated"] for r in rows] == [False, True, True]
    assert [r["_remediation_rule"] for r in rows] == [None, EMPTY_STATUS_RULE, EMPTY_STATUS_RULE]
    with pytest.raises(ValueError):
        repair_column(df, "order_status", "NO_SUCH_RULE")


def test_registered_repair_uses_its_own_trigger(spark):
    register_repair("UPPER_CITY", lambda c: F.coalesce(c != F.upper(c), F.lit(False)), F.upper)
    df = spark.createDataFrame([("Hue",), ("HUE",), (None,)], "city string")
    rows = repair_column(df, "city", "UPPER_CITY").collect()
    assert [(r["city"], r["_is_remediated"]) for r in rows] == [("HUE", True), ("HUE", False), (None, False)]
    with pytest.raises(ValueError):
        register_repair("UPPER_CITY", F.isnull, F.upper)
