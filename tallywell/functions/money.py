"""Amounts arrive as text. These read them without ever failing a job on a bad value.

The sign and finiteness tests look at the text itself, so '-0.004' is negative although it rounds
to zero, and '-1e-400' is negative although a double would underflow. Digits other than 0-9 are
not recognised.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywell.schemas import MONEY

_MANTISSA = r"(?:[0-9]+\.?[0-9]*|\.[0-9]+)"
_EXPONENT = r"(?:[eE][+-]?[0-9]+)?"
_NUMBER = rf"^\s*[+-]?{_MANTISSA}{_EXPONENT}\s*$"
# A minus sign, and some digit of the mantissa that is not zero.
_NEGATIVE = rf"^\s*-(?=[0-9.]*[1-9]){_MANTISSA}{_EXPONENT}\s*$"
_NONFINITE = r"(?i)^\s*[+-]?(?:inf|infinity|s?nan[0-9]*)\s*$"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _matches(c: Column, pattern: str) -> Column:
    # Underscores between digits are legal grouping marks.
    return F.replace(_text(c), F.lit("_"), F.lit("")).rlike(pattern)


def exact_money(c: Column) -> Column:
    """DECIMAL(18,2), half up; NULL when the text is no number or does not fit."""
    return c.try_cast(MONEY)


# Each pattern is tried only on text that has a letter or sign it needs: a byte search settles
# nearly every row.


def is_negative_amount(c: Column) -> Column:
    return F.contains(_text(c), F.lit("-")) & _matches(c, _NEGATIVE)


def is_nonfinite_amount(c: Column) -> Column:
    has_n = F.contains(_text(c), F.lit("n")) | F.contains(_text(c), F.lit("N"))
    return has_n & _matches(c, _NONFINITE)


def is_unreadable_amount(c: Column) -> Column:
    """Neither a number nor a NaN/infinity; NULL and '' are unreadable as well."""
    return ~(_matches(c, _NUMBER) | is_nonfinite_amount(c))
