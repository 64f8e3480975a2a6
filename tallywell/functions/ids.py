"""Identifiers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_ordered_id(epoch_ms: Column, *identity: Column) -> Column:
    """Version-7 shaped UUID text: 48 bits of time, the rest hashed from ``identity``.

    Being a function of its inputs, a retried task yields the same id. ``identity`` must tell two
    deliveries within one millisecond apart.
    """
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in identity]
    digest = F.sha2(F.concat_ws("\x1f", *parts), 256)
    stamp = F.lpad(F.lower(F.hex(F.greatest(epoch_ms, F.lit(0)))), 12, "0")
    variant = F.substring(F.lit("89ab"), F.pmod(F.ascii(F.substring(digest, 4, 1)), F.lit(4)) + 1, F.lit(1))
    return F.concat(
        F.substring(stamp, 1, 8),
        F.lit("-"),
        F.substring(stamp, 9, 4),
        F.lit("-7"),
        F.substring(digest, 1, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 5, 3),
        F.lit("-"),
        F.substring(digest, 8, 12),
    )
