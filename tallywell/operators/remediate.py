"""Automatic repairs, looked up by name, each leaving its provenance in the row."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.functions import is_blank, is_empty


@dataclass(frozen=True)
class Repair:
    """``applies`` must be TRUE or FALSE for every value, NULL included."""

    applies: Callable[[Column], Column]
    value: Callable[[Column], Column]


# Rule names and the fallback category.
EMPTY_STATUS_RULE = "FIX_EMPTY_STATUS"
BLANK_STATUS_RULE = "FIX_BLANK_STATUS"
UNKNOWN = "UNKNOWN"

_REPAIRS: dict[str, Repair] = {
    EMPTY_STATUS_RULE: Repair(is_empty, lambda c: F.lit(UNKNOWN)),
    BLANK_STATUS_RULE: Repair(is_blank, lambda c: F.lit(UNKNOWN)),
}


def register_repair(name: str, applies: Callable[[Column], Column], value: Callable[[Column], Column]) -> None:
    if name in _REPAIRS:
        raise ValueError(f"A repair named {name!r} exists already")
    _REPAIRS[name] = Repair(applies, value)


def registered_repairs() -> list[str]:
    return sorted(_REPAIRS)


def repair_column(df: DataFrame, column: str, rule: str) -> DataFrame:
    """Apply ``rule`` to ``column``; adds ``_is_remediated`` and ``_remediation_rule``."""
    if rule not in _REPAIRS:
        raise ValueError(f"Unknown repair {rule!r}; registered are {registered_repairs()}")
    repair, old = _REPAIRS[rule], F.col(column)
    hit = repair.applies(old)
    # One projection: every expression still sees the column as it was before the repair.
    return df.withColumns(
        {
            column: F.when(hit, repair.value(old)).otherwise(old),
            "_is_remediated": hit,
            "_remediation_rule": F.when(hit, F.lit(rule)),
        }
    )
