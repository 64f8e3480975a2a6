"""Where rows come from: files, tables, streams, encoded payloads."""

from tallywell.sources.codec import decode_events, encode_events, split_structural
from tallywell.sources.files import read_csv_text, read_raw_orders, read_raw_payments
from tallywell.sources.streams import file_stream, kafka_stream
from tallywell.sources.tables import current_table, rows_or_empty, table_or_none

__all__ = [
    "current_table",
    "decode_events",
    "encode_events",
    "file_stream",
    "kafka_stream",
    "read_csv_text",
    "read_raw_orders",
    "read_raw_payments",
    "rows_or_empty",
    "split_structural",
    "table_or_none",
]
