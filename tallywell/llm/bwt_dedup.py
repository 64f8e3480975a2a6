"""Dedup of byte strings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

Within a bucket of pieces (see ``anchors``) the transform of the concatenation of those of their windows is built whose hash occurs
twice in it; a window with a hash of its own occurs once. Starting from the interval of
all suffixes, intervals are extended backwards by each byte that precedes one of their suffixes, breadth first, all
intervals of a level at once. When strings of length l + 1 come out, every interval end not seen before parts suffixes
that have l bytes in common, so common prefixes are found by increasing value, each once; intervals whose end is
known already are not followed. Expansion stops at the minimum length: what is not parted by then has at least that
much in common.
"""

import numpy as np
from pyspark.sql import DataFrame

from tallywell.llm.anchors import Units, alone, covered, cut, keyed
from tallywell.llm.common import mixed, ranges, run_hashes

WIDTH = 50
GRAM = 20

_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))
_KEY_SYMBOLS = 7  # of 9 bits each in a sort key


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their first ``depth`` symbols (or more), ties by place. Symbols are 0 to 256."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(_KEY_SYMBOLS, text.dtype)]).astype(np.int64)
    key = np.zeros(n, np.int64)
    for j in range(_KEY_SYMBOLS):
        key = key << 9 | padded[j : n + j]
    known = _KEY_SYMBOLS
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate([[False], ordered[1:] != ordered[:-1]])
        if known >= depth or new.sum() == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) + 1
        later = np.zeros(n, np.int64)
        later[: max(0, n - known)] = rank[known:]
        key = rank << 32 | later
        known *= 2


def parted(transform: np.ndarray, threshold: int) -> np.ndarray:
    """For each place between suffixes (0 to n) the length of their common prefix, or ``threshold`` if it is not less.

    ``transform`` has the symbol before each suffix, in the order of suffixes.
    """
    n = len(transform)
    order = np.argsort(transform, kind="stable")
    ahead = np.empty(n, np.int64)  # where the suffix that is one symbol longer stands
    ahead[order] = np.arange(n)
    same = transform[order][1:] == transform[order][:-1]
    before, after = np.full(n, -1, np.int64), np.full(n, n, np.int64)  # rows with the same symbol
    before[order[1:][same]] = order[:-1][same]
    after[order[:-1][same]] = order[1:][same]
    common = np.full(n + 1, threshold, np.int64)
    common[[0, n]] = -1
    low, high = np.array([0]), np.array([n])
    for length in range(threshold):
        size = high - low
        rows = ranges(low, size)
        starts = np.sort(ahead[rows[before[rows] < np.repeat(low, size)]])
        ends = np.sort(ahead[rows[after[rows] >= np.repeat(high, size)]]) + 1
        fresh = common[ends] == threshold
        low, high = starts[fresh], ends[fresh]
        if not len(low):
            break
        common[high] = length
    return common


def first_bytes(contents: list[bytes], anchor: np.ndarray, width: int = WIDTH):
    """See ``anchors.Search``; contents are byte strings."""
    lengths = np.array([len(c) for c in contents], np.int64)
    windows = lengths - width + 1
    number = np.repeat(np.arange(len(contents)), windows)
    place = ranges(np.zeros(len(contents), np.int64), windows)
    owner = number.copy()
    some = np.flatnonzero(~alone(anchor))
    if not len(some):
        return number, owner, place
    text = np.frombuffer(b"".join(contents[k] for k in some), np.uint8)
    begins = np.cumsum(lengths[some]) - lengths[some]
    at = ranges(begins, windows[some])
    repeated = _occur_twice(run_hashes(_BYTES[text], width)[at])
    # Stretches of windows that may occur elsewhere; the others are first where they stand.
    chosen = np.flatnonzero(~alone(anchor)[number])
    of, w = number[chosen], place[chosen]
    new = repeated.copy()
    new[1:] &= ~repeated[:-1] | (of[1:] != of[:-1])
    first_window = np.flatnonzero(new)
    if not len(first_window):
        return number, owner, place
    count = np.bincount((np.cumsum(new) - 1)[repeated], minlength=len(first_window))
    sizes = count + width - 1
    # A 0 after each stretch: it is no byte, so what holds it equals no window.
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    joined = np.zeros(int(sizes.sum()) + len(sizes), np.uint16)
    joined[ranges(begins, sizes)] = text[ranges(at[first_window], sizes)].astype(np.uint16) + np.uint16(1)
    order = suffix_order(joined, width + 1)
    common = parted(joined[order - 1], width)
    new = common[:-1] < width
    group = np.empty(len(joined), np.int64)
    group[order] = np.cumsum(new) - 1
    earliest = np.minimum.reduceat(order, np.flatnonzero(new))  # pieces stand in the order of documents
    first = earliest[group[ranges(begins, count)]]
    chosen = chosen[repeated]
    k = np.searchsorted(begins, first, "right") - 1
    owner[chosen] = of[first_window[k]]
    place[chosen] = w[first_window[k]] + first - begins[k]
    return number, owner, place


def _occur_twice(hashes: np.ndarray) -> np.ndarray:
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    out = np.zeros(len(hashes), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def deduplicated_bytes(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Every row's doc_id, n bytes, n_removed, n_spans, spans (of bytes) and kept: its text's UTF-8 bytes but those covered by a
    string of ``width`` bytes that also starts in a document with a smaller doc_id.

    Strings are judged on the input and never cross documents. A null or empty text has no bytes. A null doc_id comes
    before all others; rows with one doc_id never remove from each other. No rows give no rows. Other columns are not
    read. What is left may not be valid UTF-8.
    """
    units = Units(width, gram, False, False)
    rows = keyed(docs)
    spans = covered(rows, units, lambda c, a: first_bytes(c, a, width))
    return cut(rows, spans, units)
