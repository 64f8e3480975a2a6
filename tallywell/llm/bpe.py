"""Byte-level BPE by a minimal acyclic transducer over frequent words.

The corpus's words (the pieces that the tokenizer's pre-tokenizer cuts) are counted over all documents. The most
frequent ones, with the ids that BPE gives them, are compiled into a minimal acyclic automaton: words share prefixes
and, as equal states are merged while sorted words come in, suffixes. Each arc carries a number, and the numbers along
a word's path add up to the word's place among all words; that place leads to its ids. The automaton is one file of
flat arrays, handed to the executors by Spark and memory-mapped there, so all tasks of a machine share it.

Encoding cuts a chunk of texts with array operations, finds its distinct words, walks all of them through the
automaton at once, one byte a step, and merges the words it does not hold by the exact BPE rule, also all at once.
"""

import functools
import hashlib
import json
import os
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import give_back, keep, least_count, ranges, release, strings, text_chunks, texts_of

#: So many of the most frequent words are compiled. A bound on the file, not on what is encoded.
LEXICON_WORDS = 262_144

#: Bytes of text worked on at a time: more find fewer different words for each.
CHUNK = 4 << 20

#: Words of more bytes are merged one by one.
WIDE = 32

# vocabulary ---------------------------------------------------------------------------------------


def _alphabet() -> dict[str, int]:
    """Character to byte of the public byte-level alphabet: printable Latin-1 stands for itself, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


#: Kinds of code points for cutting texts. A gap stands between texts; no text holds its code point.
OTHER, LETTER, NUMBER, SPACE, BETWEEN = range(5)
GAP = 0xD800


def code_point_kinds(tokenizer) -> np.ndarray:
    """The kind of each code point, asked from the tokenizer's own pre-tokenizer, whose Unicode version counts.

    All code points but U+0020 in a row are cut where the kind changes. One of each piece is then put between two
    letters, digits or signs, which only its own kind does not cut.
    """
    points = np.array([p for p in range(0x110000) if not 0xD800 <= p < 0xE000 and p != 32])
    pieces = []
    for block in np.split(points, range(4096, len(points), 4096)):
        text = "".join(map(chr, block))
        pieces += [block[start:end] for _, (start, end) in tokenizer.pre_tokenize_str(text)]
    kinds = np.full(0x110000, SPACE, np.uint8)
    for piece in pieces:
        for kind, side in ((OTHER, "!"), (LETTER, "a"), (NUMBER, "7")):
            if len(tokenizer.pre_tokenize_str(f"{side}{chr(piece[0])}{side}")) == 1:
                kinds[piece] = kind
    kinds[GAP] = BETWEEN
    return kinds


class Vocabulary:
    """Bytes of each id, merges, special strings and code point kinds of a byte-level BPE file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        model, cutter = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or cutter["type"] != "ByteLevel" or cutter["add_prefix_space"] or not cutter["use_regex"]:
            raise ValueError("only byte-level BPE without a prefix space is covered")
        if spec["normalizer"] is not None:
            raise ValueError("a normalizer is not covered")
        Tokenizer.from_file(path)  # the library accepts it
        byte_of = _alphabet()
        ids = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        pieces = [b""] * size
        for token, k in ids.items():
            pieces[k] = bytes(byte_of[c] for c in token) if token not in self.special else token.encode()
        for token, k in self.special.items():
            pieces[k] = token.encode()
        self.pieces = np.frombuffer(b"".join(pieces), np.uint8)
        self.piece_at = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        self.byte_ids = np.zeros(256, np.int64)
        for c, b in byte_of.items():
            self.byte_ids[b] = ids[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([ids[a] * size + ids[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.size, self.merge_keys, self.merge_ranks = size, keys[order], order.astype(np.int64)
        self.merge_ids = np.array([ids[a + b] for a, b in merges], np.int64)
        self.kinds = code_point_kinds(pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair of ids; their number of merges if there is none."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.merge_keys, keys), len(self.merge_keys) - 1)
        return np.where(self.merge_keys[at] == keys, self.merge_ranks[at], len(self.merge_ids))


# cutting texts into words ----------------------------------------------------------------------------


def cuts(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Whether a word begins at each code point. Gaps stand between texts.

    The rule cut by: 's 't 're 've 'm 'll 'd; a run of letters, numbers or signs with one space before it; white space,
    whose last character goes with what follows.
    """
    n = len(points)
    kind = kinds[points]
    begin = np.ones(n, bool)
    begin[1:] = kind[1:] != kind[:-1]
    space = kind == SPACE
    before_text = np.zeros(n, bool)  # last of a run of white space, with something after it
    before_text[:-1] = space[:-1] & ~space[1:] & (points[1:] != GAP)
    begin |= before_text
    joined = before_text & (points == 32)
    begin[1:][joined[:-1]] = False
    quote = points == 39
    if quote.any():
        at = np.flatnonzero(quote & begin)  # at a begin, so no space clings to it
        at = at[at + 1 < n]
        one = points[at + 1]
        two = np.where(at + 2 < n, points[np.minimum(at + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        begin[at[short | long] + 1] = False
        after = np.concatenate([at[short] + 2, at[long] + 3])
        begin[after[after < n]] = True
    return begin


def words(data: np.ndarray, bounds: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word of the texts begins (bytes; one more at the end), the number of each text's first word
    (one more at the end), and for each word the id if it is a special string, else -1."""
    raw = data.tobytes()
    edges = set(bounds.tolist())
    special_at: dict[int, tuple[int, int]] = {}
    for content, k in vocabulary.special.items():
        needle = content.encode()
        at = raw.find(needle)
        while at >= 0:
            end = at + len(needle)
            if end <= bounds[np.searchsorted(bounds, at, "right")]:  # lies in one text
                special_at[at] = end, k
                edges |= {at, end}
                at = raw.find(needle, end)
            else:
                at = raw.find(needle, at + 1)
    points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    gapped, place = _with_gaps(points, np.searchsorted(lead, np.array(sorted(edges), np.int64)))
    begin = cuts(gapped, vocabulary.kinds)[place]
    for at, (end, _) in special_at.items():
        first, last = np.searchsorted(lead, [at, end])
        begin[first + 1 : last] = False
    starts = lead[begin]
    special = np.full(len(starts), -1, np.int64)
    for at, (_, k) in special_at.items():
        special[np.searchsorted(starts, at)] = k
    return np.append(starts, len(data)), np.searchsorted(starts, bounds), special


def _with_gaps(points: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points with a gap before each inner edge, and their places there."""
    inner = edges[(edges > 0) & (edges < len(points))]
    before = np.zeros(len(points), np.int64)
    before[inner] = 1
    place = np.arange(len(points)) + np.cumsum(before)
    out = np.full(len(points) + len(inner), GAP, np.uint32)
    out[place] = points
    return out, place


# exact merges ------------------------------------------------------------------------------------------


def merge_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of each word, one after the other, and how many each has. All words of like length are merged at once."""
    lengths = ends - starts
    counts = np.zeros(len(starts), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for low, high in ((0, 6), (6, 10), (10, 16), (16, WIDE)):
        group = np.flatnonzero((lengths > low) & (lengths <= high))
        for at in range(0, len(group), 1 << 16):
            part = group[at : at + (1 << 16)]
            ids, left = _merged_block(data, starts[part], lengths[part], high, vocabulary)
            counts[part] = left
            found.append((part, ids, left))
    for k in np.flatnonzero(lengths > WIDE).tolist():
        ids = _merged_long(vocabulary.byte_ids[data[starts[k] : ends[k]]], vocabulary)
        counts[k] = len(ids)
        found.append((np.array([k]), ids, counts[k : k + 1]))
    at = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(int(at[-1]), np.int64)
    for part, ids, left in found:
        out[ranges(at[part], left)] = ids
    return out, counts


def _merged_block(data, starts, lengths, width, vocabulary) -> tuple[np.ndarray, np.ndarray]:
    n, none = len(starts), len(vocabulary.merge_ids)
    place = np.arange(width)
    ids = vocabulary.byte_ids[data[np.minimum(starts[:, None] + place, len(data) - 1)]]
    left = lengths.copy()
    ranks = np.full((n, width), none, np.int64)
    has = place[None, : width - 1] < left[:, None] - 1
    r, c = np.nonzero(has)
    ranks[r, c] = vocabulary.ranks(ids[r, c], ids[r, c + 1])
    row = np.arange(n)
    while len(row):
        best = ranks[row].argmin(axis=1)  # of equal ranks the leftmost
        rank = ranks[row, best]
        go = rank < none
        row, best, rank = row[go], best[go], rank[go]
        if not len(row):
            break
        # The pair becomes one id, what stands after it moves up by one.
        moved = np.minimum(place[None, :] + (place[None, :] > best[:, None]), width - 1)
        ids[row] = np.take_along_axis(ids[row], moved, 1)
        ranks[row] = np.take_along_axis(ranks[row], moved, 1)
        ids[row, best] = vocabulary.merge_ids[rank]
        left[row] -= 1
        ranks[row, width - 1] = none
        for side in (best, best - 1):
            ok = (side >= 0) & (side < left[row] - 1)
            r, c = row[ok], side[ok]
            ranks[r, c] = vocabulary.ranks(ids[r, c], ids[r, c + 1])
            end = (side >= 0) & ~ok
            ranks[row[end], side[end]] = none
    return ids[place[None, :] < left[:, None]], left


def _merged_long(ids: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """One long word. In rank order, all places of the lowest rank are merged in a pass from the left; a merge only
    makes pairs of its own id, so none of a lower rank than its own can be missed by going on in the pass."""
    while len(ids) > 1:
        ranks = vocabulary.ranks(ids[:-1], ids[1:])
        best = ranks.min()
        if best == len(vocabulary.merge_ids):
            break
        at = np.flatnonzero(ranks == best)
        if len(at) > 1 and (np.diff(at) == 1).any():  # aaa: pairs overlap, the left one first
            run = np.concatenate([[0], np.cumsum(np.diff(at) != 1)])
            first = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1])
            at = at[(np.arange(len(at)) - first[run]) % 2 == 0]
        ids = ids.copy()
        ids[at] = vocabulary.merge_ids[best]
        ids = np.delete(ids, at + 1)
    return ids


# the automaton --------------------------------------------------------------------------------------------


def compiled(words_in_order: list[bytes], ids: np.ndarray, counts: np.ndarray) -> bytes:
    """The automaton of distinct, sorted, non-empty words and the ids of each, as one file's bytes.

    Words come in sorted, so once a word leaves a prefix, the states below it are final: each is then replaced by an
    equal one that is registered already, or registered itself.
    """
    register: dict[tuple, int] = {}
    arcs_of: list[tuple] = []  # of registered states: (label, state), ascending
    ends: list[bool] = []
    path: list[list] = [[False, []]]  # of states not yet registered: whether a word ends, and arcs

    def registered(final: bool, arcs: list) -> int:
        key = (final, tuple(arcs))
        if key not in register:
            register[key] = len(arcs_of)
            arcs_of.append(key[1])
            ends.append(final)
        return register[key]

    before = b""
    for word in words_in_order:
        shared = len(os.path.commonprefix([before, word]))
        while len(path) > shared + 1:
            final, arcs = path.pop()
            path[-1][1].append((before[len(path) - 1], registered(final, arcs)))
        path += [[False, []] for _ in word[shared:]]
        path[-1][0] = True
        before = word
    while len(path) > 1:
        final, arcs = path.pop()
        path[-1][1].append((before[len(path) - 1], registered(final, arcs)))
    root = registered(*path[0])

    below = np.zeros(len(arcs_of), np.int64)  # words from each state on; a state's arcs lead to earlier ones
    keys, targets, adds = [], [], []
    for state, arcs in enumerate(arcs_of):
        total = int(ends[state])
        for label, to in arcs:
            keys.append(state << 8 | label)
            targets.append(to)
            adds.append(total)
            total += int(below[to])
        below[state] = total
    return _packed(
        root=np.array([root], np.int64),
        final=np.array(ends, np.uint8),
        keys=np.array(keys, np.int64),
        targets=np.array(targets, np.int32),
        adds=np.array(adds, np.int32),
        ids=ids.astype(np.int32),
        id_at=np.concatenate([[0], np.cumsum(counts)]).astype(np.int64),
    )


def _packed(**arrays: np.ndarray) -> bytes:
    at, table, blocks = 0, {}, []
    for name, a in arrays.items():
        table[name] = (a.dtype.str, len(a), at)
        blocks.append(a.tobytes() + b"\0" * (-a.nbytes % 64))
        at += len(blocks[-1])
    head = json.dumps(table).encode()
    head += b" " * (-(len(head) + 8) % 64)
    return len(head).to_bytes(8, "little") + head + b"".join(blocks)


class Lexicon:
    """The automaton over a buffer or a memory-mapped file."""

    def __init__(self, data: np.ndarray):
        size = int.from_bytes(data[:8].tobytes(), "little")
        for name, (kind, n, at) in json.loads(data[8 : 8 + size].tobytes()).items():
            from_ = 8 + size + at
            setattr(self, name, data[from_ : from_ + n * np.dtype(kind).itemsize].view(kind))

    def places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The place of each word among those compiled, or -1."""
        n = len(starts)
        state = np.full(n, self.root[0], np.int64)
        place = np.zeros(n, np.int64)
        out = np.full(n, -1, np.int64)
        row, at = np.arange(n), starts.copy()
        if not len(self.keys):
            return out
        while len(row):
            done = at == ends[row]
            ended = row[done]
            out[ended] = np.where(self.final[state[ended]] == 1, place[ended], -1)
            row, at = row[~done], at[~done]
            if not len(row):
                break
            key = state[row] << 8 | data[at]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            go = self.keys[arc] == key
            row, at, arc = row[go], at[go] + 1, arc[go]
            state[row] = self.targets[arc]
            place[row] += self.adds[arc]
        return out


def _mapped(content, name: str) -> Lexicon:
    """The lexicon file in the executor's own folder of Spark files, put there by the first task that needs it."""
    path = os.path.join(SparkFiles.getRootDirectory(), name)
    if not os.path.exists(path):
        own = f"{path}.{uuid.uuid4().hex}"
        with open(own, "wb") as f:
            f.write(content.value)
        os.replace(own, path)
    return Lexicon(np.memmap(path, np.uint8, "r"))


# encoding and decoding ------------------------------------------------------------------------------------


def encode_chunk(data, bounds, vocabulary: Vocabulary, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, and where those of each text begin (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
    starts, first, special = words(data, bounds, vocabulary)
    coded = strings(data, starts).dictionary_encode()
    number = coded.indices.to_numpy()
    piece_bytes, at = _binary(coded.dictionary)
    begins, ends = at[:-1], at[1:]
    place = lexicon.places(piece_bytes, begins, ends)
    known, rest = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
    counts = np.zeros(len(place), np.int64)
    counts[known] = np.diff(lexicon.id_at)[place[known]]
    merged, counts[rest] = merge_words(piece_bytes, begins[rest], ends[rest], vocabulary)
    marks = np.flatnonzero(special >= 0)
    own = dict(zip(number[marks].tolist(), special[marks].tolist(), strict=True))
    before = counts.copy()
    counts[list(own)] = 1
    own_at = np.concatenate([[0], np.cumsum(counts)])
    ids = np.zeros(int(own_at[-1]), np.int32)
    ids[ranges(own_at[known], counts[known])] = lexicon.ids[ranges(lexicon.id_at[place[known]], counts[known])]
    rest_at = np.concatenate([[0], np.cumsum(before[rest])])[:-1]
    ids[ranges(own_at[rest], counts[rest])] = merged[ranges(rest_at, counts[rest])]
    for k, v in own.items():
        ids[own_at[k]] = v
    lengths = counts[number]
    return ids[ranges(own_at[:-1][number], lengths)], np.concatenate([[0], np.cumsum(lengths)])[first]


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8), at


def decode_chunk(ids: np.ndarray, id_at: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (one more at the end)."""
    lengths = np.diff(vocabulary.piece_at)[ids]
    out = vocabulary.pieces[ranges(vocabulary.piece_at[ids], lengths)]
    return out, np.concatenate([[0], np.cumsum(lengths)])[id_at]


def word_counts(docs: DataFrame, vocabulary) -> DataFrame:
    """word (bytes) and n, over all texts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, numbers = [], []
            for _, data, bounds in text_chunks([batch], limit=CHUNK):
                if len(data):
                    starts, _, special = words(data, bounds, vocabulary.value)
                    coded = strings(data, starts).dictionary_encode()
                    found.append(coded.dictionary)
                    numbers.append(np.bincount(coded.indices.to_numpy()[special < 0], minlength=len(coded.dictionary)))
            if found:
                again = pa.concat_arrays(found).dictionary_encode()
                n = np.bincount(again.indices.to_numpy(), weights=np.concatenate(numbers)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([again.dictionary.cast(pa.binary()), pa.array(n)], ["word", "n"])

    rows = texts_of(docs).select("text").mapInArrow(count, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


@functools.lru_cache(maxsize=4)
def load_vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class BytePairCoder:
    """Encodes and decodes documents; made by ``train``. Rows keep their doc_id, null and repeated ones too.

    A null text counts as empty and has no ids. No rows give no rows. Other columns are not read.
    """

    def __init__(self, spark, path: str, lexicon: bytes):
        self._vocabulary = spark.sparkContext.broadcast(load_vocabulary(path))
        self._lexicon = spark.sparkContext.broadcast(lexicon)
        self._name = f"lexicon-{hashlib.sha256(lexicon).hexdigest()[:24]}"

    @classmethod
    def train(cls, docs: DataFrame, path: str, lexicon_words: int = LEXICON_WORDS) -> "BytePairCoder":
        """Compile the most frequent words of ``docs``: all whose count is above the one that would exceed the bound."""
        spark = docs.sparkSession
        vocabulary = load_vocabulary(path)
        sent = spark.sparkContext.broadcast(vocabulary)
        counts = keep(word_counts(docs, sent).filter("n > 1"), "words")
        sent.destroy()
        least = least_count(counts, lexicon_words)
        found = sorted(bytes(r.word) for r in counts.filter(F.col("n") >= least).select("word").toLocalIterator())
        release(counts)
        data = np.frombuffer(b"".join(found), np.uint8)
        at = np.concatenate([[0], np.cumsum([len(w) for w in found])]).astype(np.int64)
        ids, n = merge_words(data, at[:-1], at[1:], vocabulary)
        lexicon = compiled(found, ids, n)
        del found, data, at, ids, n
        give_back()
        return cls(spark, path, lexicon)

    def encode(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_tokens and ids."""
        vocabulary, lexicon, name = self._vocabulary, self._lexicon, self._name

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = _mapped(lexicon, name)
            for rows, data, bounds in text_chunks(batches, limit=CHUNK):
                ids, at = encode_chunk(data, bounds, vocabulary.value, own)
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(at)), lists], ["doc_id", "n_tokens", "ids"])

        return texts_of(docs).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")

    def decode(self, encoded: DataFrame) -> DataFrame:
        """doc_id and text of rows with doc_id and ids; bytes that are no UTF-8 become U+FFFD, null ids an empty text."""
        vocabulary = self._vocabulary

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, at = _lists(batch.column("ids"))
                data, bounds = decode_chunk(ids, at, vocabulary.value)
                raw = data.tobytes()
                texts = [raw[a:b].decode(errors="replace") for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

        rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
        return rows.mapInArrow(run, "doc_id long, text string")

    def digests(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_tokens, and SHA-256 of the ids (little-endian, 32 bits each) and of the text decoded from them."""
        vocabulary, lexicon, name = self._vocabulary, self._lexicon, self._name

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = _mapped(lexicon, name)
            for rows, data, bounds in text_chunks(batches, limit=CHUNK):
                ids, at = encode_chunk(data, bounds, vocabulary.value, own)
                texts, text_at = decode_chunk(ids, at, vocabulary.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(np.diff(at)),
                        pa.array(_sha256(ids.astype("<u4").tobytes(), at * 4)),
                        pa.array(_sha256(texts.tobytes(), text_at, valid_text)),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

        return texts_of(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def valid_text(raw: bytes) -> bytes:
    return raw.decode(errors="replace").encode()


def _sha256(raw: bytes, at: np.ndarray, shape=bytes) -> list[str]:
    return [hashlib.sha256(shape(raw[a:b])).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)
    return values[at[0] : at[-1]] if len(column) else values[:0], at - at[0]
