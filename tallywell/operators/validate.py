"""Business rules: typing, one label per row, every broken rule, and the route a row takes.

The rules are data. A label is the first broken rule in table order, as only one label fits the
``validation_status`` column; ``violations`` lists all of them.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.functions import (
    blank_sql,
    empty_sql,
    event_date,
    exact_money,
    is_blank,
    is_negative_amount,
    is_nonfinite_amount,
    is_unreadable_amount,
)

CLEAN = "clean"
QUARANTINE = "quarantine"
VALID = "VALID"
# Labels a row may carry and still reach the clean table.
PASSING_LABELS = (VALID, "EMPTY_STATUS")


@dataclass(frozen=True)
class Policy:
    """Departures from the default behaviour, all opt-in.

    ``strict_amount``: text that is no number is INVALID instead of counting as zero.
    ``blank_is_empty``: white space counts as empty in routing and repair, not only in labelling.
    ``route_on``: ``"first"`` routes by the label; ``"all"`` also by rules the label hides.
    """

    strict_amount: bool = False
    blank_is_empty: bool = False
    route_on: str = "first"

    def __post_init__(self) -> None:
        if self.route_on not in ("first", "all"):
            raise ValueError(f"route_on must be 'first' or 'all', not {self.route_on!r}")


DEFAULT_POLICY = Policy()


@dataclass(frozen=True)
class Rule:
    name: str
    label: str | None
    repairable: bool
    broken: Callable[[Policy], Column]


def _bad_amount(policy: Policy) -> Column:
    amount = F.col("payment_value")
    if not policy.strict_amount:
        return F.lit(False)
    return is_unreadable_amount(amount) | (exact_money(amount).isNull() & ~is_nonfinite_amount(amount))


RULES = (
    Rule("EMPTY_STATUS", "EMPTY_STATUS", True, lambda _: is_blank(F.col("order_status"))),
    Rule("NEGATIVE_VALUE", "NEGATIVE_VALUE", False, lambda _: is_negative_amount(F.col("payment_value"))),
    Rule(
        "INVALID_ID",
        "INVALID",
        False,
        lambda _: is_blank(F.col("order_id")) | is_blank(F.col("customer_id")),
    ),
    Rule("NON_FINITE_VALUE", "INVALID", False, lambda _: is_nonfinite_amount(F.col("payment_value"))),
    Rule("UNREADABLE_VALUE", "INVALID", False, _bad_amount),
    Rule("MISSING_DATE", None, False, lambda _: event_date(F.col("order_purchase_timestamp")).isNull()),
)


def _active(policy: Policy) -> list[Rule]:
    return [r for r in RULES if r.name != "UNREADABLE_VALUE" or policy.strict_amount]


def validation_label(policy: Policy = DEFAULT_POLICY) -> Column:
    """Label of a row over the six event columns; never NULL."""
    label = F.lit(VALID)
    for rule in reversed([r for r in _active(policy) if r.label]):
        label = F.when(rule.broken(policy), F.lit(rule.label)).otherwise(label)
    return label


def violations(policy: Policy = DEFAULT_POLICY) -> Column:
    """Names of all broken rules, in table order; empty for a faultless row."""
    return F.array_compact(F.array(*[F.when(r.broken(policy), F.lit(r.name)) for r in _active(policy)]))


def key_contract_breach(policy: Policy = DEFAULT_POLICY) -> str:
    """SQL predicate for rows the clean table must never hold: no order, customer or day.

    Text, so that the same definition serves a filter and a DELETE statement.
    """
    absent = blank_sql if policy.blank_is_empty else empty_sql
    return f"{absent('order_id')} OR {absent('customer_id')} OR created_date IS NULL"


def needs_review(policy: Policy = DEFAULT_POLICY) -> Column:
    """Quarantine test over typed and labelled rows; never NULL, so its negation is the clean test."""
    test = ~F.col("validation_status").isin(*PASSING_LABELS) | F.expr(key_contract_breach(policy))
    if policy.route_on == "all":
        for rule in _active(policy):
            if not rule.repairable:
                test = test | rule.broken(policy)
    return test


def classify(events: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Typed amount and day, label, and ``route``. One pass, no shuffle, no Python."""
    typed = events.withColumns(
        {
            "parsed_payment_value": exact_money(F.col("payment_value")),
            "created_date": event_date(F.col("order_purchase_timestamp")),
            "validation_status": validation_label(policy),
        }
    )
    route = F.when(needs_review(policy), F.lit(QUARANTINE)).otherwise(F.lit(CLEAN))
    return typed.withColumn("route", route)


def clean_rows(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("route") == CLEAN).drop("route")


def quarantined_rows(classified: DataFrame) -> DataFrame:
    """Rows for the review queue, opened as PENDING."""
    return (
        classified.filter(F.col("route") == QUARANTINE).drop("route").withColumn("_status", F.lit("PENDING"))
    )
