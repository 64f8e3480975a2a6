"""Tables of the pipeline and the row-level writes on them."""

from tallywell.sinks.layers import Layers, create_layers
from tallywell.sinks.publish import file_writer, kafka_writer, publish_events
from tallywell.sinks.writes import (
    append_absent,
    append_batch,
    append_rows,
    delete_from_table,
    replace_table,
    upsert_table,
)

__all__ = [
    "Layers",
    "append_absent",
    "append_batch",
    "append_rows",
    "create_layers",
    "delete_from_table",
    "file_writer",
    "kafka_writer",
    "publish_events",
    "replace_table",
    "upsert_table",
]
