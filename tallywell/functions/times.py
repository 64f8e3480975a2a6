"""Event time arrives as 'yyyy-MM-dd HH:mm:ss' text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_FULL_TIMESTAMP = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"


def event_date(c: Column) -> Column:
    """Calendar day of the text; NULL when there is none."""
    return c.try_cast("date")


def event_instant(c: Column) -> Column:
    """Wall-clock time of the text, free of any session time zone; NULL unless it is complete."""
    return F.when(c.rlike(_FULL_TIMESTAMP), c.try_cast("timestamp_ntz"))
