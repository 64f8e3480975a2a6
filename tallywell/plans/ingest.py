"""Raw orders and payments to publishable events."""

from pyspark.sql import Column, DataFrame

from tallywell.operators.ingest import chronological, envelope, inject_faults, join_payments


def order_events(
    orders: DataFrame,
    payments: DataFrame,
    *,
    delivered_at: Column,
    structural_rate: float = 0.0,
    business_rate: float = 0.0,
    seed: int = 42,
) -> DataFrame:
    """One event per order in order of purchase time, damaged at the given rates.

    ``delivered_at`` is the time of delivery in milliseconds, one for the whole run: ids of a later run are greater, and
    a run repeated with its time repeats its ids.
    """
    priced = join_payments(orders, payments)
    return priced_events(priced, delivered_at=delivered_at, structural_rate=structural_rate, business_rate=business_rate, seed=seed)


def priced_events(
    priced: DataFrame, *, delivered_at: Column, structural_rate: float = 0.0, business_rate: float = 0.0, seed: int = 42
) -> DataFrame:
    """The same of orders that have their payment already, as ``join_payments`` gives them."""
    events = envelope(chronological(priced), delivered_at.cast("bigint"))
    if structural_rate or business_rate:
        events = inject_faults(events, structural_rate, business_rate, seed=seed)
    return events
