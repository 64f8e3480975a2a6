from decimal import Decimal, InvalidOperation

import pytest
from pyspark.sql import functions as F

from tallywell.functions import (
    blank_sql,
    event_date,
    event_instant,
    exact_money,
    is_blank,
    is_empty,
    is_negative_amount,
    is_nonfinite_amount,
    is_unreadable_amount,
    time_ordered_id,
)

TEXTS = [None, "", " ", "   ", "\t\n", "\x0b\x0c\r", "\x1c\x1f", " ", "  ", "　", "​"] + [
    "a", " a", "a ", "　a", "!", "~", "~~", "\x7f", "é", "中"
]


def test_blank_is_what_strip_empties(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    rows = df.select("t", is_blank(F.col("t")).alias("col"), F.expr(blank_sql("t")).alias("sql"), is_empty(F.col("t")).alias("e"))
    for row in rows.collect():
        expected = (row["t"] or "").strip() == ""
        assert (row["col"], row["sql"]) == (expected, expected), repr(row["t"])
        assert row["e"] == ((row["t"] or "") == "")


AMOUNTS = [None, "", " ", "0", "-0", "-0.00", "-0.004", "-1", " -5 ", "-.5", "-5.", "5.", ".5", "+5", "--5", "-", "-.", "."] + [
    "abc", "-abc", "1e5", "-1e5", "-1e-400", "-0e5", "-1_000", "1_000", "5d", "-5f", "0x1", "-0x1", "nan", "NaN", "-nan",
    "sNaN12", "inf", "-Infinity", "+inf", "infinit", "none", "-12345678901234567890", "99.905", "1-2", "- 5",
]


def model(text):
    """(negative, nonfinite, unreadable) by the decimal library."""
    try:
        value = Decimal(text or "")
    except InvalidOperation:
        return False, False, True
    if not value.is_finite():
        return False, True, False
    return value < 0, False, False


def test_amount_predicates_agree_with_decimal_library(spark):
    c = F.col("t")
    df = spark.createDataFrame([(t,) for t in AMOUNTS], "t string")
    df = df.select("t", is_negative_amount(c).alias("n"), is_nonfinite_amount(c).alias("f"), is_unreadable_amount(c).alias("u"))
    for row in df.collect():
        assert (row["n"], row["f"], row["u"]) == model(row["t"]), repr(row["t"])


@pytest.mark.parametrize(
    "text, value",
    [("99.905", "99.91"), ("-99.905", "-99.91"), (" 5 ", "5.00"), ("1e2", "100.00"), ("abc", None), ("", None)]
    + [("1_000", None), ("NaN", None), ("99999999999999999", None), ("9999999999999999.99", "9999999999999999.99")],
)
def test_exact_money(spark, text, value):
    got = spark.createDataFrame([(text,)], "t string").select(exact_money(F.col("t"))).first()[0]
    assert got == (None if value is None else Decimal(value))


def test_dates_never_fail(spark):
    texts = ["2026-01-02 11:00:00", "2026-01-02", "", "garbage", None, "2026-02-30 00:00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(event_date(F.col("t")).cast("string"), event_instant(F.col("t")).cast("string")).collect()
    assert [r[0] for r in rows] == ["2026-01-02", "2026-01-02", None, None, None, None]
    assert [r[1] for r in rows] == ["2026-01-02 11:00:00", None, None, None, None, None]


def test_ids_are_v7_shaped_ordered_and_repeatable(spark):
    df = spark.range(200).select((F.col("id") * 1000).alias("ms"), F.col("id").cast("string").alias("k"))
    rows = df.select("ms", time_ordered_id(F.col("ms"), F.col("k")).alias("i")).orderBy("ms").collect()
    ids = [r["i"] for r in rows]
    again = [r["i"] for r in df.select("ms", time_ordered_id(F.col("ms"), F.col("k")).alias("i")).orderBy("ms").collect()]
    assert ids == sorted(ids) == again and len(set(ids)) == 200
    assert all(len(i) == 36 and i[14] == "7" and i[19] in "89ab" for i in ids)
