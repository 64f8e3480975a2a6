"""Column-level building blocks; all of them stay inside Spark expressions."""

from tallywell.functions.ids import time_ordered_id
from tallywell.functions.money import (
    exact_money,
    is_negative_amount,
    is_nonfinite_amount,
    is_unreadable_amount,
)
from tallywell.functions.text import blank_sql, empty_sql, is_blank, is_empty
from tallywell.functions.times import event_date, event_instant

__all__ = [
    "blank_sql",
    "empty_sql",
    "event_date",
    "event_instant",
    "exact_money",
    "is_blank",
    "is_empty",
    "is_negative_amount",
    "is_nonfinite_amount",
    "is_unreadable_amount",
    "time_ordered_id",
]
