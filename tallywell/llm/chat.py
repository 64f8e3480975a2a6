"""Chat formatting by columnar byte assembly.

A turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n`` and a conversation is its turns in order. For a batch of
turns the lengths of all segments (header, role, line end, text, footer) are computed at once; their running sum
says where each begins; the bytes of each kind of segment are then scattered into one preallocated buffer with
one index array, and that buffer is the Arrow column of the result.

Control strings in texts are escaped so that they can be told from the template and restored: ``<``, any number of
backslashes and ``|`` get one more backslash, so no ``<|`` is left in a text. A role also has its line ends and
backslashes escaped.

Rows are dealt by conversation and sorted within the partition. A conversation is one value, unless its rows have
more than ``part_bytes`` bytes: then it continues in further rows (``part`` 1, 2, ...), cut between turns, so a task holds
a part at a time however long a conversation is.
"""

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import byte_array, ranges

START, END = "<|im_start|>", "<|im_end|>"
PART_BYTES = 32 << 20

FORMATTED = "conv_id long, part int, n_turns long, formatted string, loss_spans array<struct<start:long,end:long>>"

_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)


def escaped(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"<(\\*)\|", r"<\1\\|")


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escaped_roles(roles: pa.Array) -> pa.Array:
    # Line ends last: what stands for them has a backslash of its own.
    return escaped(pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n"))


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role))


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The buffer of all turns, where each turn begins in it (one more at the end), and where each text begins and ends."""
    role_bytes, role_at = byte_array(roles)
    text_bytes, text_at = byte_array(texts)
    n = len(roles)
    role_len, text_len = np.diff(role_at), np.diff(text_at)
    lengths = np.column_stack(
        [np.full(n, len(START)), role_len, np.ones(n, np.int64), text_len, np.full(n, len(END) + 1)]
    )
    at = np.concatenate([[0], np.cumsum(lengths.ravel())])
    begins = at[:-1].reshape(n, 5)
    out = np.empty(int(at[-1]), np.uint8)
    for column, constant in ((0, START), (2, "\n"), (4, END + "\n")):
        piece = np.frombuffer(constant.encode(), np.uint8)
        out[begins[:, column, None] + np.arange(len(piece))] = piece
    out[ranges(begins[:, 1], role_len)] = role_bytes
    out[ranges(begins[:, 3], text_len)] = text_bytes
    return out, np.append(begins[:, 0], at[-1]), begins[:, 3], begins[:, 3] + text_len


def _conversations(turns: pa.RecordBatch, part: int) -> pa.RecordBatch:
    """Turns in order as conversations; the first of them continues as ``part``."""
    groups = pc.dictionary_encode(turns.column("conv_id"), null_encoding="encode").indices.to_numpy()
    first = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    roles, texts = turns.column("role"), turns.column("text")
    out, turn_at, text_from, text_to = assemble(escaped_roles(roles), escaped(texts))
    # Code points before each byte: all bytes count but those that continue a character.
    points = np.zeros(len(out) + 1, np.int64)
    np.cumsum((out & 0xC0) != 0x80, out=points[1:])
    conv_at = turn_at[np.append(first, len(groups))]
    group_of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(groups))))
    loss = np.flatnonzero(pc.equal(roles, "assistant").to_numpy(zero_copy_only=False))
    base = points[conv_at[group_of[loss]]]
    spans = pa.StructArray.from_arrays(
        [pa.array(points[text_from[loss]] - base), pa.array(points[text_to[loss]] - base)], ["start", "end"]
    )
    span_at = np.searchsorted(group_of[loss], np.arange(len(first) + 1))
    parts = np.zeros(len(first), np.int32)
    parts[0] = part
    return pa.RecordBatch.from_arrays(
        [
            turns.column("conv_id").take(pa.array(first)),
            pa.array(parts),
            pa.array(np.diff(np.append(first, len(groups)))),
            pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(conv_at.astype(np.int32)), pa.py_buffer(out)]),
            pa.ListArray.from_arrays(pa.array(span_at, pa.int32()), spans),
        ],
        ["conv_id", "part", "n_turns", "formatted", "loss_spans"],
    )


def format_conversations(turns: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """A row for each conversation (or part of a very long one), its parts in order within a partition.

    ``loss_spans`` covers the assistant's texts, in code points of ``formatted``. A null text or role is empty. Rows without
    conv_id are one conversation. A null turn comes first; turns with one number are ordered by role and text, and
    repeated rows are turns of their own. No rows give no rows. Other columns are not read.
    """
    ordered = (
        turns.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .drop("turn")
    )

    def form(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # rows of the last conversation so far
        part, open_id = 0, None  # parts that it has already given, and its id if so
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks().to_batches()[0]
            ids = rows.column("conv_id")
            if part and ids[0].as_py() != open_id:
                part = 0
            groups = pc.dictionary_encode(ids, null_encoding="encode").indices.to_numpy()
            last = int(np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))[-1])
            if last:
                yield _conversations(rows.slice(0, last), part)
                part = 0
            held = rows.slice(last)
            if len(byte_array(held.column("text"))[0]) > part_bytes:
                yield _conversations(held, part)
                held, part, open_id = None, part + 1, ids[-1].as_py()
        if held is not None:
            yield _conversations(held, part)

    return ordered.mapInArrow(form, FORMATTED)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation, as they were before."""
    found = list(_TURN.finditer(formatted))
    if sum(m.end() - m.start() for m in found) != len(formatted):
        raise ValueError("not a formatted conversation")
    return [(unescaped_role(m[1]), unescaped(m[2])) for m in found]


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """One row for each conversation of ``format_conversations``, read back from its formatted text and loss spans."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_row: list | None = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["part"] == 0:
                    if open_row:
                        done.append(_closed(open_row))
                    open_row = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns = read_turns(row["formatted"])
                open_row[1] += len(turns)
                for role, text in turns:
                    open_row[2].update(f"{role}\n{text}\n".encode())
                for span in row["loss_spans"]:
                    text = unescaped(row["formatted"][span["start"] : span["end"]])
                    open_row[3] += len(text)
                    open_row[4].update(text.encode())
                open_row[5] += len(row["formatted"])
            if done:
                yield _digest_batch(done)
        if open_row:
            yield _digest_batch([_closed(open_row)])

    return formatted.mapInArrow(read, DIGESTS)


def _closed(row: list) -> list:
    return [row[0], row[1], row[2].hexdigest(), row[3], row[4].hexdigest(), row[5]]


def _digest_batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in DIGESTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
