"""Dealing out repeated windows by anchors.

An anchor of a window of W units (words or bytes) is the smallest hash among the runs of ``gram`` units in it. Equal
windows have equal anchors, and neighbouring windows mostly share one, so a document falls into pieces: the units of all
consecutive windows with one anchor. Repeats are found among the pieces of one anchor, wherever they lie.

Only pieces whose anchor occurs at least twice matter. Anchors are counted over all documents by partial sums; a sieve
of fixed size, sent to all tasks, then drops most others while the documents are read again. What passes the sieve by
chance meets nothing and changes nothing.

The pieces of an anchor meet in one bucket, packed by bucket where they are made. An anchor that occurs very often is
crowded: copied many times over, or a phrase in many contexts. Its pieces go another way, see ``crowded_spans``: they
are first reduced to one row for each content, and then dealt out by the content of each window.
"""

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import byte_array, keep, mixed, ranges, release, run_hashes, signed, span_hashes, strings, text_chunks, texts_of, word_spans

#: Bytes of text worked on at a time, and where anchors are made, whose arrays have eight bytes for each and should stay in a cache.
CHUNK, SCAN = 1 << 18, 1 << 15
#: Windows in a piece at most; a longer run of one anchor becomes several pieces.
LONGEST = 256
#: Bits kept of an anchor. Two anchors that fall together only bring pieces together that do not match.
ANCHOR_BITS = 48
SIEVE_BITS = 28
_SIEVE_BLOCK = 15
CROWDED_SIEVE_BITS = 24
#: Anchors are counted in blocks that share so many of their last bits; the first ones are uneven, being those of smallest hashes.
BLOCK_BITS = 10
#: Anchors and bytes of pieces that a task holds before they go out.
ANCHORS_HELD, PIECES_HELD = 1 << 19, 8 << 20
#: Documents with spans are dealt out to so many groups.
SLOTS = 256
#: Tasks of the buckets for each core, or one for so many buckets if that is more.
TASKS_PER_CORE, BUCKETS_PER_TASK = 8, 16
#: Bytes of pieces searched together, on average. An anchor whose pieces alone have more is crowded.
BUCKET_BYTES = 4 << 20


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))


@dataclass(frozen=True)
class Units:
    """What windows are made of: ``width`` and ``gram`` units, of words or of bytes; and whether a window can repeat
    one of its own document."""

    width: int
    gram: int
    words: bool
    inner: bool

    @property
    def piece_bytes(self) -> int:
        """About so many bytes has a piece; it sets the number of buckets and when an anchor is crowded."""
        return self.width * (10 if self.words else 2)

    @property
    def crowded(self) -> int:
        """An anchor that occurs more often is crowded."""
        return max(1, BUCKET_BYTES // self.piece_bytes)

    def split(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, start and end of each unit, and the number of each text's first unit (one more at the end)."""
        if self.words:
            starts, ends, first = word_spans(data, bounds)
            return span_hashes(data, starts, ends), starts, ends, first
        at = np.arange(len(data))
        return _BYTES[data], at, at + 1, bounds


@dataclass
class Pieces:
    """Of a chunk of texts: first window, number of windows, text and anchor of each piece."""

    start: np.ndarray
    count: np.ndarray
    text: np.ndarray
    anchor: np.ndarray
    twice: np.ndarray  # whether the anchor's run of units occurs twice in the text


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if width > have else out


def pieces(hashes: np.ndarray, first: np.ndarray, units: Units) -> Pieces:
    grams = run_hashes(hashes, units.gram)
    n = len(hashes) - units.width + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return Pieces(none, none, none, none, none.astype(bool))
    least = _smallest(grams, units.width - units.gram + 1)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[:n]
    fits = np.arange(n) + units.width <= first[text + 1]
    begin = fits.copy()
    begin[1:] &= (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    start = np.flatnonzero(begin)
    # A piece ends where the next begins or windows no longer fit.
    stop = np.flatnonzero(fits & ~np.append(fits[1:] & ~begin[1:], False)) + 1
    count = stop - start
    more = -(-count // LONGEST)
    part = ranges(np.zeros(len(start), np.int64), more)
    start = np.repeat(start, more) + part * LONGEST
    count = np.minimum(np.repeat(count, more) - part * LONGEST, LONGEST)
    anchor = least[start]
    twice = np.zeros(len(anchor), bool)
    if not units.inner:
        return Pieces(start, count, text[start], signed(anchor >> np.uint64(64 - ANCHOR_BITS)), twice)
    # Grams of one text that occur twice in it; the text's number is mixed in.
    gram_text = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(grams)].astype(np.uint64)
    own = np.sort(grams + gram_text * np.uint64(0x9E3779B97F4A7C15))
    again = np.unique(own[1:][own[1:] == own[:-1]])
    key = anchor + text[start].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    place = np.searchsorted(again, key)
    some = place < len(again)
    twice[some] = again[place[some]] == key[some]
    return Pieces(start, count, text[start], signed(anchor >> np.uint64(64 - ANCHOR_BITS)), twice)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, d (doc_id, the smallest long for null), t (a hash of the text, telling texts under one doc_id apart), text."""
    return texts_of(docs).select(
        "doc_id", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("d"), F.xxhash64("text").alias("t"), "text"
    )


def repeated_anchors(rows: DataFrame, units: Units) -> DataFrame:
    """``anchor`` and ``n``, how often it occurs: those of two or more texts, and those whose units occur twice in one.

    Nearly all anchors occur once, so they are counted as arrays, in blocks by their last bits: what a task has found goes out as
    one row for each block, each anchor once, with its number where that is more than one.
    """
    high, low = ANCHOR_BITS - BLOCK_BITS, (1 << BLOCK_BITS) - 1
    size = -(-high // 8)

    def packed(found: list[np.ndarray]) -> pa.RecordBatch:
        anchors, n = np.unique(np.concatenate(found), return_counts=True)
        order = np.argsort((anchors & low).astype(np.uint16), kind="stable")
        anchors, n = anchors[order], n[order]
        edge = np.searchsorted(anchors & low, np.arange(low + 2))
        some = np.flatnonzero(np.diff(edge))
        bounds = np.append(edge[some], len(anchors))
        raw = np.ascontiguousarray((anchors >> BLOCK_BITS).astype("<i8").view(np.uint8).reshape(-1, 8)[:, :size]).ravel()
        several = n > 1
        at = np.concatenate([[0], np.cumsum(several)])[bounds]
        pairs = np.stack([anchors[several], n[several]], axis=1).astype("<i8").view(np.uint8).ravel()
        each = (strings(raw, bounds * size), strings(pairs, at * 16))
        return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(x.cast(pa.binary()) for x in each)], ["block", "anchors", "several"])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found = 0, []
        for _, data, bounds in text_chunks(batches, limit=SCAN):
            hashes, _, _, first = units.split(data, bounds)
            p = pieces(hashes, first, units)
            # One for each text: pieces of one anchor in one text are told by `twice`.
            order = np.lexsort([p.anchor, p.text])
            a, t = p.anchor[order], p.text[order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (t[1:] != t[:-1])
            found += [a[new], p.anchor[p.twice]]
            held += len(found[-2]) + len(found[-1])
            if held > ANCHORS_HELD:
                yield packed(found)
                held, found = 0, []
        if held:
            yield packed(found)

    def count(rows: pa.Table) -> pa.Table:
        raw, _ = byte_array(rows.column("anchors"))
        wide = np.zeros((len(raw) // size, 8), np.uint8)
        wide[:, :size] = raw.reshape(-1, size)
        anchors = np.sort(wide.view("<i8").ravel() << BLOCK_BITS | rows.column("block")[0].as_py())
        begin = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
        n = np.diff(np.append(begin, len(anchors)))
        anchors = anchors[begin]
        more, times = np.ascontiguousarray(byte_array(rows.column("several"))[0]).view("<i8").reshape(-1, 2).T
        np.add.at(n, np.searchsorted(anchors, more), times - 1)
        return pa.table({"anchor": anchors[n > 1], "n": n[n > 1].astype(np.int64)})

    blocks = rows.select("text").mapInArrow(scan, "block int, anchors binary, several binary")
    return blocks.groupBy("block").applyInArrow(count, "anchor long, n long")


def sieve(anchors: DataFrame, size_bits: int = SIEVE_BITS):
    """A bit for each value that an anchor's last ``size_bits`` bits can take, as a broadcast of fixed size."""
    spark = anchors.sparkSession
    place = F.col("anchor").bitwiseAND((1 << size_bits) - 1).cast("int").alias("place")
    places = anchors.select(place).distinct()

    def block(rows: pa.Table) -> pa.Table:
        places = rows.column("place").to_numpy()
        bits = np.zeros(1 << _SIEVE_BLOCK, np.uint8)
        bits[places & ((1 << _SIEVE_BLOCK) - 1)] = 1
        return pa.table({"block": [int(places[0]) >> _SIEVE_BLOCK], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    blocks = places.groupBy(F.shiftright("place", _SIEVE_BLOCK).alias("b")).applyInArrow(block, "block long, bits binary")
    # Kept first, as what a shuffle leaves would stay on disk for as long as the driver does not collect its garbage.
    blocks = keep(blocks, "sieve")
    out = np.zeros(1 << (size_bits - 3), np.uint8)
    size = 1 << (_SIEVE_BLOCK - 3)
    for r in blocks.toLocalIterator():
        out[r.block * size : (r.block + 1) * size] = np.frombuffer(bytes(r.bits), np.uint8)
    release(blocks)
    return spark.sparkContext.broadcast(out)


def passes(bits: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    low = anchors & (8 * len(bits) - 1)
    return (bits[low >> 3] >> (low & 7).astype(np.uint8)) & 1 == 1


@dataclass
class Found:
    """Of a chunk: the pieces that pass the sieve, whether they are crowded, and where their contents lie in ``data``."""

    start: np.ndarray
    count: np.ndarray
    text: np.ndarray
    anchor: np.ndarray
    at: np.ndarray
    crowd: np.ndarray
    data: np.ndarray
    begins: np.ndarray
    ends: np.ndarray

    def contents(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = (self.ends - self.begins)[chosen]
        return self.data[ranges(self.begins[chosen], lengths)], np.concatenate([[0], np.cumsum(lengths)])


def _found(data: np.ndarray, bounds: np.ndarray, units: Units, bits: np.ndarray, crowds: np.ndarray) -> Found:
    hashes, starts, ends, first = units.split(data, bounds)
    p = pieces(hashes, first, units)
    some = np.flatnonzero(passes(bits, p.anchor))
    start, count, text, anchor = p.start[some], p.count[some], p.text[some], p.anchor[some]
    last = start + count + units.width - 2
    if units.words:
        data, begins, stops = _joined(data, starts, ends, start, last)
    else:
        begins, stops = start, last + 1
    return Found(start, count, text, anchor, start - first[text], passes(crowds, anchor), data, begins, stops)


def _joined(data, starts, ends, first, last) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words with a space after each, and the spans there from word ``first`` to word ``last``."""
    lengths = ends - starts + 1
    at = np.concatenate([[0], np.cumsum(lengths)])
    out = np.full(int(at[-1]), 32, np.uint8)
    out[ranges(at[:-1], lengths - 1)] = data[ranges(starts, lengths - 1)]
    return out, at[first], at[last + 1] - 1


#: From contents and their anchors, sorted by first occurrence: for each window of each content, one content after the
#: other, the number of the content and the window in it where it occurs first.
Search = Callable[[list[bytes], np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass
class Stretches:
    """Windows of different contents, in stretches: content, first window, windows, and the content (``owner``) and
    window in it (``place``) where the first of them occurs first; the others follow there one by one."""

    number: np.ndarray
    w: np.ndarray
    n: np.ndarray
    owner: np.ndarray
    place: np.ndarray


def _stretches(contents: list[bytes], anchor: np.ndarray, search: Search) -> Stretches:
    number, owner, place = search(contents, anchor)
    w = np.arange(len(number)) - np.searchsorted(number, number)
    new = np.ones(len(number), bool)
    new[1:] = (number[1:] != number[:-1]) | (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)
    begin = np.flatnonzero(new)
    return Stretches(number[begin], w[begin], np.diff(np.append(begin, len(number))), owner[begin], place[begin])


# the usual way: all pieces of an anchor in one bucket ------------------------------------------------

PACKED = "bucket long, d array<long>, t array<long>, at array<int>, n array<int>, anchor array<int>, size array<int>, contents binary"
SLOTTED = "slot int, d array<long>, t array<long>, a array<int>, b array<int>"


def packed_pieces(rows: DataFrame, units: Units, bits, crowds, buckets: int) -> DataFrame:
    """The pieces that are not crowded: a row for each bucket of what a task holds, not of each chunk, as buckets grow in number with
    the table."""

    def packed(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        data, begins, size, anchor, *values = zip(*found)
        starts = np.cumsum([0, *map(len, data)])
        begins = np.concatenate([x + at for x, at in zip(begins, starts)])
        anchor, size, *values = (np.concatenate(x) for x in (anchor, size, *values))
        bucket = mixed(anchor.view(np.uint64)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        bucket, size = bucket[order], size[order]
        edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        edges = np.append(edge, len(order))
        lists = pa.array(edges.astype(np.int32))
        contents, at = np.concatenate(data)[ranges(begins[order], size)], np.concatenate([[0], np.cumsum(size)])
        columns = [*(x[order] for x in values), anchor[order].astype(np.int32), size.astype(np.int32)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[edge].view(np.int64)),
                *(pa.ListArray.from_arrays(lists, pa.array(v)) for v in columns),
                strings(contents, at[edges]).cast(pa.binary()),
            ],
            [x.split()[0] for x in PACKED.split(", ")],
        )

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found = 0, []
        for part, data, bounds in text_chunks(batches, limit=SCAN):
            f = _found(data, bounds, units, bits.value, crowds.value)
            some = np.flatnonzero(~f.crowd)
            if not len(some):
                continue
            d, t = (part.column(c).to_numpy()[f.text[some]] for c in ("d", "t"))
            size = (f.ends - f.begins)[some]
            ints = (f.at[some].astype(np.int32), f.count[some].astype(np.int32))
            found.append((f.data, f.begins[some], size, f.anchor[some], d, t, *ints))
            held += len(f.data) + int(size.sum())
            if held > PIECES_HELD:
                yield packed(found)
                held, found = 0, []
        if found:
            yield packed(found)

    return rows.select("d", "t", "text").mapInArrow(scan, PACKED)


def _bucket_spans(rows: pa.Table, units: Units, search: Search) -> pa.Table:
    d, t, at, n, anchor, size = (
        pa.concat_arrays([c.flatten() for c in rows.column(name).chunks]).to_numpy()
        for name in ("d", "t", "at", "n", "anchor", "size")
    )
    at = at.astype(np.int64)
    data, _ = byte_array(rows.column("contents"))
    coded = strings(data, np.concatenate([[0], np.cumsum(size.astype(np.int64))])).dictionary_encode()
    code = coded.indices.to_numpy()
    # Contents in the order of their first occurrences.
    order = np.lexsort([at, t, d])
    _, first = np.unique(code[order], return_index=True)
    first = np.sort(first)
    owner = order[first]
    place = np.empty(len(owner), np.int64)
    place[code[owner]] = np.arange(len(owner))
    number = place[code]
    contents = coded.dictionary.take(pa.array(code[owner])).to_pylist()
    s = _stretches(contents, anchor[owner], search)
    # Each occurrence with the stretches of its content.
    from_, to = np.searchsorted(s.number, number), np.searchsorted(s.number, number, "right")
    own = np.repeat(np.arange(len(d)), to - from_)
    k = ranges(from_, to - from_)
    f, begin = owner[s.owner[k]], at[own] + s.w[k]
    hit = d[f] < d[own]
    if units.inner:
        hit |= (d[f] == d[own]) & ((t[f] < t[own]) | (t[f] == t[own]) & (at[f] + s.place[k] < begin))
    own, begin, n = own[hit], begin[hit], s.n[k[hit]]
    end = begin + n + (units.width - 1)
    return _slots(d[own], t[own], begin, end)


def _slots(d: np.ndarray, t: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """Spans, a row for each slot that their documents fall into."""
    slot = (mixed(d.view(np.uint64)) % np.uint64(SLOTS)).astype(np.uint16)
    order = np.argsort(slot, kind="stable")
    edge = np.searchsorted(slot[order], np.arange(SLOTS + 1))
    some = np.flatnonzero(np.diff(edge))
    lists = pa.array(np.append(edge[some], len(order)).astype(np.int32))
    columns = (d[order], t[order], a[order].astype(np.int32), b[order].astype(np.int32))
    return pa.table([pa.array(some.astype(np.int32)), *(pa.ListArray.from_arrays(lists, pa.array(x)) for x in columns)], ["slot", "d", "t", "a", "b"])


def _joined_spans(document: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of documents (numbers) as maximal stretches, ordered: those that overlap or touch become one."""
    order = np.lexsort([a, document])
    document, a, b = document[order], a[order].astype(np.int64), b[order].astype(np.int64)
    # The furthest end so far in the document.
    far = np.maximum.accumulate(b + (document << 32)) - (document << 32)
    new = np.ones(len(a), bool)
    new[1:] = (document[1:] != document[:-1]) | (a[1:] > far[:-1])
    begin = np.flatnonzero(new)
    return document[begin], a[begin], far[np.append(begin[1:], len(a)) - 1] if len(a) else far


def _document_spans(rows: pa.Table) -> pa.Table:
    d, t, a, b = (pa.concat_arrays([c.flatten() for c in rows.column(x).chunks]).to_numpy() for x in ("d", "t", "a", "b"))
    order = np.lexsort([t, d])
    new = np.ones(len(order), bool)
    new[1:] = (d[order][1:] != d[order][:-1]) | (t[order][1:] != t[order][:-1])
    document = np.empty(len(order), np.int64)
    document[order] = np.cumsum(new) - 1
    owner = order[new]
    document, a, b = _joined_spans(document, a, b)
    lists = pa.array(np.searchsorted(document, np.arange(len(owner) + 1)).astype(np.int32))
    spans = pa.StructArray.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], ["a", "b"])
    return pa.table({"d": d[owner], "t": t[owner], "spans": pa.ListArray.from_arrays(lists, spans)})


# crowded anchors: one row for each content, then one bucket for each window's content -------------------

PIECE = "anchor long, d long, t long, at int, n int"
FIRSTS = "array<struct<w:int,n:int,d:long,t:long,at:int>>"


def crowded_pieces(rows: DataFrame, units: Units, bits, crowds, content: bool) -> DataFrame:
    """The crowded pieces: anchor, document (d, t), first window (at), windows (n), and c: their content (the units' bytes,
    words joined by single spaces) or a hash of it."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in text_chunks(batches, limit=CHUNK):
            f = _found(data, bounds, units, bits.value, crowds.value)
            chosen = np.flatnonzero(f.crowd)
            if not len(chosen):
                continue
            text = pa.array(f.text[chosen])
            values = strings(*f.contents(chosen)).cast(pa.binary()) if content else pa.array(signed(span_hashes(f.data, f.begins[chosen], f.ends[chosen])))
            columns = [pa.array(f.anchor[chosen]), part.column("d").take(text), part.column("t").take(text)]
            columns += [pa.array(f.at[chosen].astype(np.int32)), pa.array(f.count[chosen].astype(np.int32)), values]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "d", "t", "at", "n", "c"])

    return rows.select("d", "t", "text").mapInArrow(scan, PIECE + (", c binary" if content else ", c long"))


def _windows(pieces: DataFrame, units: Units) -> DataFrame:
    """Each window of each content as a content of its own, with hashes of both."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in text_chunks(batches, "c", CHUNK):
            _, starts, ends, first = units.split(data, bounds)
            count = np.diff(first) - units.width + 1
            piece = np.repeat(np.arange(part.num_rows), count)
            w = ranges(np.zeros(part.num_rows, np.int64), count)
            begin = first[piece] + w
            at, to = starts[begin], ends[begin + units.width - 1]
            owner, take = part.column("first"), pa.array(piece)
            columns = {
                "anchor": part.column("anchor").take(take),
                "piece": pa.array(signed(span_hashes(data, bounds[:-1], bounds[1:]))).take(take),
                "w": pa.array(w.astype(np.int32)),
                "c": strings(data[ranges(at, to - at)], np.concatenate([[0], np.cumsum(to - at)])).cast(pa.binary()),
                "window": pa.array(signed(span_hashes(data, at, to))),
                "d": owner.field("d").take(take),
                "t": owner.field("t").take(take),
                "at": pa.array((owner.field("at").to_numpy()[piece] + w).astype(np.int32)),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return pieces.mapInArrow(run, "anchor long, piece long, w int, c binary, window long, d long, t long, at int")


def _window_firsts(rows: pa.Table, search: Search) -> pa.Table:
    """Of contents that are one window each: hash, and where it occurs first."""
    first = rows.column("first").combine_chunks()
    d, t, at = (first.field(x).to_numpy() for x in ("d", "t", "at"))
    order = np.lexsort([at, t, d])
    d, t, at, anchor = d[order], t[order], at[order].astype(np.int64), rows.column("anchor").to_numpy()[order]
    contents = rows.column("c").combine_chunks().take(pa.array(order))
    s = _stretches(contents.to_pylist(), anchor, search)
    data, bounds = byte_array(contents)
    window = signed(span_hashes(data, bounds[:-1], bounds[1:]))[s.number]
    return pa.table(
        {"anchor": anchor[s.number], "window": window, "d": d[s.owner], "t": t[s.owner], "at": (at[s.owner] + s.place).astype(np.int32)}
    )


def crowded_spans(rows: DataFrame, units: Units, bits, crowds, search: Search) -> DataFrame:
    """The spans of crowded pieces. A content is searched once, however often it occurs, and what was found for its
    windows is joined with its occurrences; both joins can be split where a key is hot."""
    first = F.min(F.struct("d", "t", "at")).alias("first")
    contents = crowded_pieces(rows, units, bits, crowds, True).groupBy("anchor", "c").agg(first)
    windows = keep(_windows(contents, units), "windows")
    each = windows.groupBy("anchor", "c").agg(first)
    total = windows.agg(F.sum(F.octet_length("c"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("c"), F.lit(max(1, -(-total // BUCKET_BYTES))))
    firsts = each.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(
        lambda t: _window_firsts(t, search), "anchor long, window long, d long, t long, at int"
    )
    found = windows.select("anchor", "piece", "w", "window").join(firsts, ["anchor", "window"])
    # A content has no more than LONGEST windows.
    found = found.groupBy("anchor", F.col("piece").alias("c")).agg(F.collect_list(F.struct("w", "d", "t", "at")).alias("firsts"))
    own = crowded_pieces(rows, units, bits, crowds, False).withColumnRenamed("at", "from")
    at = F.col("from") + F.col("f.w")
    each = own.join(keep(found, "firsts"), ["anchor", "c"]).select("d", "t", "from", F.explode("firsts").alias("f"))
    earlier = F.col("f.d") < F.col("d")
    if units.inner:
        earlier = F.struct("f.d", "f.t", "f.at") < F.struct("d", "t", at.alias("at"))
    return each.filter(earlier).select("d", "t", at.alias("a"), (at + units.width).alias("b"))


def alone(anchor: np.ndarray) -> np.ndarray:
    """Whether each content is the only one of its anchor: no other holds a window of it."""
    _, place, n = np.unique(anchor, return_inverse=True, return_counts=True)
    return n[place] == 1


def covered(rows: DataFrame, units: Units, search: Search) -> DataFrame:
    """d, t and ``spans``: for each document, in units, the stretches (a, b) covered by windows that occur earlier: in a document
    of a smaller d or, if windows can repeat their own document, anywhere earlier by d, t and place. They are maximal and ordered.
    """
    anchors = keep(repeated_anchors(rows, units), "anchors")
    bits, crowds = sieve(anchors), sieve(anchors.filter(F.col("n") > units.crowded), CROWDED_SIEVE_BITS)
    usual = F.col("n") <= units.crowded
    total, crowded = anchors.agg(F.sum(F.when(usual, F.col("n"))), F.count_if(~usual)).first()
    buckets = max(1, -(-(total or 0) * units.piece_bytes // BUCKET_BYTES))
    # By number: adaptive execution would join buckets by their bytes, which say little of the work.
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = min(buckets, max(TASKS_PER_CORE * cores, buckets // BUCKETS_PER_TASK))
    spans = (
        packed_pieces(rows, units, bits, crowds, buckets)
        .repartition(tasks, "bucket")
        .groupBy("bucket")
        .applyInArrow(lambda t: _bucket_spans(t, units, search), SLOTTED)
    )
    if crowded:

        def slotted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x in batches:
                yield from _slots(*(x.column(c).to_numpy() for c in ("d", "t", "a", "b"))).to_batches()

        spans = spans.union(crowded_spans(rows, units, bits, crowds, search).mapInArrow(slotted, SLOTTED))
    # Repeated rows give the same spans.
    documents = spans.groupBy("slot").applyInArrow(_document_spans, "d long, t long, spans array<struct<a:int,b:int>>")
    found = keep(documents, "spans")
    release(anchors)
    return found


def cut(rows: DataFrame, spans: DataFrame, units: Units) -> DataFrame:
    """``rows`` (doc_id and what ``keyed`` gives) without the spans: doc_id, n (units), n_removed, n_spans (maximal stretches
    removed), spans (of units) and kept (bytes, or words joined by single spaces)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in text_chunks(batches, limit=CHUNK):
            if units.words:
                starts, ends, first = word_spans(data, bounds)
            else:
                first = bounds
            lists = part.column("spans")
            per_text = lists.value_lengths().fill_null(0).to_numpy()
            spans = lists.flatten()
            text = np.repeat(np.arange(part.num_rows), per_text)
            a, b = (spans.field(x).to_numpy().astype(np.int64) for x in ("a", "b"))
            # +1 where a span begins and -1 where it ends: units inside add up to one.
            edges = np.zeros(int(first[-1]) + 1, np.int8)
            edges[first[text] + a] += 1
            edges[first[text] + b] -= 1
            left = np.flatnonzero(np.cumsum(edges[:-1], dtype=np.int8) == 0)
            of_text = np.searchsorted(left, first)
            if units.words:
                kept, at = _spaced(data, starts[left], ends[left], of_text)
            else:
                kept, at = data[left], of_text
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "n": pa.array(np.diff(first).astype(np.int64)),
                    "n_removed": pa.array((np.diff(first) - np.diff(of_text)).astype(np.int64)),
                    "n_spans": pa.array(per_text.astype(np.int64)),
                    "spans": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)), spans),
                    "kept": strings(kept, at).cast(pa.binary()),
                }
            )

    joined = rows.join(spans, ["d", "t"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, "doc_id long, n long, n_removed long, n_spans long, spans array<struct<a:int,b:int>>, kept binary")


def _spaced(data, starts, ends, first) -> tuple[np.ndarray, np.ndarray]:
    """Words with a space between those of one text, and where each text begins there; ``first`` is each text's first word."""
    sizes = ends - starts + 1
    sizes[first[1:][np.diff(first) > 0] - 1] -= 1  # none after a text's last word
    at = np.concatenate([[0], np.cumsum(sizes)])
    out = np.full(int(at[-1]), 32, np.uint8)
    lengths = ends - starts
    out[ranges(at[:-1], lengths)] = data[ranges(starts, lengths)]
    return out, at[first]
