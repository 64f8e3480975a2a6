"""Benchmark decontamination by spaced seeds.

A seed is the tokens under a fixed mask, laid over twelve consecutive tokens; those the mask leaves out may differ. Seeds of
documents are joined with those of the benchmark by their hashes. Where one hits, document and item are laid upon each
other there, and the stretch of the item that fits best is found: tokens that agree count 1, others -4, so four fifths of
the best stretch agree. It is an overlap if enough tokens agree in it.

An item of fewer than 16 tokens is an overlap too where the whole of it lies upon the document and four fifths of it agree.
Its seeds are parts of the whole item, chosen so that whatever may differ leaves one of them alone. An item under eight
tokens has to agree in all.

Tokens are runs of letters, digits and other characters that are no ASCII sign or white space, in lower case. In scripts
without spaces between words each character is a token.
The benchmark is sent to the tasks in blocks of at most ``BLOCK_BYTES`` of text (or one item): documents are read once for
each block, so a larger benchmark takes more time but no more memory.
"""

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import byte_array, mixed, ranges, span_hashes, text_chunks, texts_of, word_spans

#: Positions that count, of span 12 and weight 8.
MASKS = ("111011001011", "110101110011", "101110011101", "111100101011")
#: So many agreeing tokens of a stretch make an overlap.
LEAST = 13
#: Shorter items occur by chance; they are left out unless a caller asks for them.
SHORTEST = 8
#: Shorter items are compared as a whole, from which on some tokens may differ.
WHOLE, TOLERANT = 16, 8
MISMATCH = 4
BLOCK_BYTES = 8 << 20

_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[:128] = [b if chr(b).isalnum() else 32 for b in range(128)]

#: Scripts without spaces between words, and the first bytes of their characters (and of some others).
_UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"
_LEADS = np.zeros(256, bool)
_LEADS[[0xE0, 0xE1, *range(0xE3, 0xEA), 0xEF, 0xF0]] = True

OVERLAPS = "doc_id long, item_id long, first_token long, n_tokens long, n_matched long"


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each token of all texts, and the number of each text's first token (one more at the end)."""
    column = pc.utf8_lower(column)
    data, bounds = byte_array(column)
    if _LEADS[data].any():
        data, bounds = byte_array(pc.replace_substring_regex(column, _UNSPACED, r" \1 "))
    clean = _CLEAN[data]
    starts, ends, first = word_spans(clean, bounds)
    return span_hashes(clean, starts, ends), first


def least_agreeing(length: int) -> int:
    """Of a whole item of so many tokens, those that have to agree."""
    return -(-4 * length // 5) if length >= TOLERANT else length


def whole_masks(length: int) -> list[np.ndarray]:
    """Parts of an item so that each choice of tokens that may differ leaves one part alone.

    The item is cut into two pieces more than tokens may differ; a part is any two of the pieces.
    """
    differ = length - least_agreeing(length)
    if not differ:
        return [np.arange(length)]
    return [np.sort(np.concatenate(two)) for two in combinations(np.array_split(np.arange(length), differ + 2), 2)]


def _seed_keys(hashes: np.ndarray, at: np.ndarray, mask: np.ndarray) -> np.ndarray:
    keys = np.zeros(len(at), np.uint64)
    for p in mask.tolist():
        keys = mixed(keys + hashes[at + p])
    return keys


class Benchmark:
    """The seeds of a block of items."""

    def __init__(self, ids: list[int], texts: list[str], shortest: int = SHORTEST):
        hashes, first = token_hashes(pa.array(texts, pa.string()))
        self.ids, self.hashes, self.first = np.array(ids, np.int64), hashes, first
        self.known = np.unique(hashes)
        lengths = np.diff(first)
        span = len(MASKS[0])
        masks = [(span, np.flatnonzero([c == "1" for c in m]), lengths >= span) for m in MASKS]
        masks += [(n, m, lengths == n) for n in range(max(shortest, 1), WHOLE) for m in whole_masks(n)]
        self.seeds = []
        for width, mask, chosen in masks:
            items = np.flatnonzero(chosen)
            counts = lengths[items] - width + 1
            at = ranges(first[items], counts)
            keys = _seed_keys(hashes, at, mask)
            order = np.argsort(keys)
            if len(order):
                self.seeds.append((width, mask, keys[order], np.repeat(items, counts)[order], at[order]))

    def hits(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Rows of text, item and how far the item's first token lies from the text's, where a seed hits; each once."""
        place = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        known = self.known[place] == hashes
        end_of = np.repeat(first[1:], np.diff(first))
        found = [np.zeros((0, 3), np.int64)]
        for width, mask, keys, items, item_at in self.seeds:
            n = len(hashes) - width + 1
            if n <= 0:
                continue
            ok = np.arange(n) + width <= end_of[:n]
            for p in mask.tolist():
                ok &= known[p : n + p]
            at = np.flatnonzero(ok)
            own = _seed_keys(hashes, at, mask)
            low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            some = np.flatnonzero(high > low)
            count = (high - low)[some]
            at, seed = np.repeat(at[some], count), ranges(low[some], count)
            text = np.searchsorted(first, at, "right") - 1
            shift = (at - first[text]) - (item_at[seed] - self.first[items[seed]])
            found.append(np.column_stack([text, items[seed], shift]))
        return np.unique(np.concatenate(found), axis=0)

    def overlaps(self, hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Text, item_id, first token, length and agreeing tokens of the best overlap of each text and item."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        if not len(self.known) or not len(hashes):
            return []
        for text, item, shift in self.hits(hashes, first).tolist():
            own = hashes[first[text] : first[text + 1]]
            other = self.hashes[self.first[item] : self.first[item + 1]]
            low, high = max(0, shift), min(len(own), shift + len(other))
            same = own[low:high] == other[low - shift : high - shift]
            start, end = _best_stretch(same)
            matched = int(same[start:end].sum())
            if matched < LEAST and len(other) < WHOLE and len(same) == len(other):
                start, end, matched = 0, len(other), int(same.sum())
            if matched >= (least_agreeing(len(other)) if end - start == len(other) < WHOLE else LEAST):
                found = (matched, low + start, end - start)
                best[text, item] = max(best.get((text, item), found), found)
        return [(t, int(self.ids[i]), at, n, matched) for (t, i), (matched, at, n) in sorted(best.items())]


def _best_stretch(same: np.ndarray) -> tuple[int, int]:
    """The stretch of the greatest sum, 1 for each True and -MISMATCH for each False."""
    sums = np.concatenate([[0], np.cumsum(np.where(same, 1, -MISMATCH))])
    lowest = np.minimum.accumulate(sums)
    end = int(np.argmax(sums - lowest))
    return int(np.flatnonzero(sums[: end + 1] == lowest[end])[-1]), end


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, *, shortest: int = SHORTEST) -> Iterator[Benchmark]:
    """The items in blocks. Their bytes are counted first, so that no more than a block comes to the driver at a time.

    An item without item_id or text takes no part; repeated items are one.
    """
    items = (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        .dropna()
        .distinct()
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Half as many bytes on average: blocks are dealt by hash, and not all alike.
    blocks = max(1, -(-2 * total // block_bytes)) if total > block_bytes else 1
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        if rows:
            yield Benchmark([r.item_id for r in rows], [r.text for r in rows], shortest)


def find_overlaps(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Rows (doc_id, item_id, first_token, n_tokens, n_matched): the best overlap of each document with each item, if any.

    Items of fewer than ``shortest`` tokens take no part. A null or empty text has none. Rows with a null or repeated doc_id are documents like any other. Without documents or
    items there are no rows. Other columns are not read.
    """
    spark, rows, found = docs.sparkSession, texts_of(docs), None
    for block in benchmark_blocks(benchmark, shortest=shortest):
        sent = spark.sparkContext.broadcast(block)

        def scan(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for part, _, _ in text_chunks(batches):
                out = sent.value.overlaps(*token_hashes(part.column("text")))
                if out:
                    text, *rest = (pa.array(x, pa.int64()) for x in zip(*out, strict=True))
                    names = [x.split()[0] for x in OVERLAPS.split(", ")]
                    yield pa.RecordBatch.from_arrays([part.column("doc_id").take(text), *rest], names)

        here = rows.mapInArrow(scan, OVERLAPS)
        found = here if found is None else found.union(here)
    return spark.createDataFrame([], OVERLAPS) if found is None else found


def without_overlaps(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """The rows of ``docs``, all columns, whose text overlaps with no item of at least ``shortest`` tokens."""
    for block in benchmark_blocks(benchmark, shortest=shortest):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def scan(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for part, _, _ in text_chunks(batches):
                texts = pc.fill_null(part.column("text"), "")
                hit = np.zeros(part.num_rows, bool)
                hit[[x[0] for x in sent.value.overlaps(*token_hashes(texts))]] = True
                yield part.filter(pa.array(~hit))

        docs = docs.mapInArrow(scan, docs.schema)
    return docs
