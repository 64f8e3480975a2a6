"""Secret scan through a trigram index.

From each rule's regular expression a Boolean query over trigrams is derived that every match satisfies:
a literal run needs all its trigrams, alternatives are joined by OR, and what can be anything asks nothing.
The texts of a chunk are a shard with an inverted index of its own: a posting list of texts for each trigram
that some rule asks for. A rule's query is answered by intersecting and uniting posting lists, and its regular
expression runs on the texts found. A rule whose query asks nothing runs on every text.

Shards are built and answered where the texts are read, so texts are never shuffled, and a task holds one
shard at a time. Trigrams are of bytes with A-Z lower-cased, so a rule that ignores case needs no variants.
"""

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallywell.llm.common import text_chunks, texts_of

# Python 3.11 moved the parser of its regular expressions here.
from re import _constants as sre  # noqa: I001
from re import _parser as parser


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches whose ``group`` has at least ``least`` characters; others are dropped."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    # Runs of hex digits never touch, so asking for 24 in the expression equals dropping shorter ones.
    Rule("hex", r"[0-9a-f]{24,}", 24),
)

MORE_RULES = (
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)

RULES = BASE_RULES + MORE_RULES

SPANS = "array<struct<kind:string,start:long,end:long>>"

# the query of a regular expression ----------------------------------------------------------------

#: So many strings at most are followed one by one; beyond, their trigrams so far are kept and the run ends.
MOST_STRINGS = 128

ALWAYS = frozenset({frozenset()})
"""A query: any of these sets of trigrams, all of its trigrams. The empty set asks nothing."""


def _simpler(query: Iterable[frozenset[bytes]]) -> frozenset[frozenset[bytes]]:
    ways = set(query)
    return frozenset(w for w in ways if not any(o < w for o in ways))


def _both(a: frozenset, b: frozenset) -> frozenset:
    # Too many ways: the shorter query alone is still true of every match.
    return _simpler(x | y for x in a for y in b) if len(a) * len(b) <= 4 * MOST_STRINGS else min(a, b, key=len)


def _needs(known: set[bytes]) -> frozenset:
    return _simpler(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in known)


def _repeated(known: set[bytes], low: int, high: int) -> set[bytes] | None:
    found, last = set(), {b""}
    for n in range(high + 1):
        if n >= low:
            found |= last
        last = {a + b for a in last for b in known}
        if len(found) + len(last) > MOST_STRINGS:
            return None
    return found


def _literal(code: int) -> bytes:
    return chr(code).encode("utf-8", "surrogatepass").lower()


def _of(op, arg) -> tuple[set[bytes] | None, frozenset]:
    """What the node matches if that is few strings, else None, and its query."""
    if op is sre.LITERAL:
        known = {_literal(arg)}
    elif op is sre.IN:
        known = {_literal(a) for o, a in arg if o is sre.LITERAL}
        if len(known) != len(arg) and not (all(o is sre.LITERAL for o, _ in arg)):
            return None, ALWAYS
    elif op is sre.BRANCH:
        sides = [_sequence(x) for x in arg[1]]
        if any(k is None for k, _ in sides):
            return None, _simpler(w for _, q in sides for w in q)
        known = set().union(*(k for k, _ in sides))
    elif op is sre.SUBPATTERN:
        return _sequence(arg[3])
    elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        low, high, item = arg
        inner, query = _sequence(item)
        if inner is not None and high is not sre.MAXREPEAT and high <= 8 and (k := _repeated(inner, low, high)) is not None:
            known = k
        else:
            return None, query if low else ALWAYS
    elif op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
        known = {b""}
    else:
        return None, ALWAYS
    return (known, _needs(known)) if len(known) <= MOST_STRINGS else (None, _needs(known))


def _sequence(items) -> tuple[set[bytes] | None, frozenset]:
    known: set[bytes] = {b""}
    query, whole = ALWAYS, True
    for op, arg in items:
        now, needs = _of(op, arg)
        if now is not None and len(known) * len(now) <= MOST_STRINGS:
            known = {a + b for a in known for b in now}
            continue
        query, whole = _both(query, _needs(known)), False
        known = {b""} if now is None else now
        query = _both(query, needs) if now is None else query
    return (known, _needs(known)) if whole else (None, _both(query, _needs(known)))


def trigram_query(pattern: str) -> frozenset[frozenset[bytes]]:
    """Sets of trigrams, one of which lies wholly in every text with a match."""
    return _sequence(parser.parse(pattern))[1]


# index and scan -----------------------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Scanner:
    """Finds the spans of all rules in the texts of a chunk."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, r.compiled(), trigram_query(r.pattern)) for r in rules]
        wanted = sorted({t for *_, query in self.rules for way in query for t in way})
        self.slot_of = {t: k + 1 for k, t in enumerate(wanted)}
        self.table = np.zeros(1 << 24, np.uint16)
        for t, k in self.slot_of.items():
            self.table[t[0] << 16 | t[1] << 8 | t[2]] = k

    def postings(self, data: np.ndarray, bounds: np.ndarray) -> dict[int, np.ndarray]:
        """For each wanted trigram's number the texts that hold it, ascending."""
        if len(data) < 3 or not self.slot_of:
            return {}
        low = _LOWER[data].astype(np.int32)
        slots = self.table[(low[:-2] << 16) | (low[1:-1] << 8) | low[2:]]
        at = np.flatnonzero(slots)
        text = np.searchsorted(bounds, at, "right") - 1
        whole = at + 3 <= bounds[text + 1]
        n = len(bounds)
        pairs = np.unique(slots[at[whole]].astype(np.int64) * n + text[whole])
        if not len(pairs):
            return {}
        numbers, first = np.unique(pairs // n, return_index=True)
        return {int(k): p % n for k, p in zip(numbers, np.split(pairs, first[1:]), strict=True)}

    def candidates(self, query: frozenset, postings: dict[int, np.ndarray], n: int) -> np.ndarray:
        found = [np.zeros(0, np.int64)]
        for way in query:
            if not way:
                return np.arange(n)
            lists = sorted((postings.get(self.slot_of[t], found[0]) for t in way), key=len)
            texts = lists[0]
            for other in lists[1:]:
                texts = np.intersect1d(texts, other, assume_unique=True)
            found.append(texts)
        return np.unique(np.concatenate(found))

    def spans(self, data: np.ndarray, bounds: np.ndarray) -> list[list[tuple[str, int, int]]]:
        """By text: kind, start and end in code points, by start and then in the order of the rules."""
        n = len(bounds) - 1
        postings = self.postings(data, bounds)
        raw = data.tobytes()
        texts: dict[int, str] = {}
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
        for k, (rule, compiled, query) in enumerate(self.rules):
            for i in self.candidates(query, postings, n).tolist():
                if i not in texts:
                    texts[i] = raw[bounds[i] : bounds[i + 1]].decode()
                for m in compiled.finditer(texts[i]):
                    if len(m[rule.group]) >= rule.least:
                        found[i].append((m.start(), k, m.end()))
        return [[(self.rules[k][0].kind, start, end) for start, k, end in sorted(x)] for x in found]


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row's doc_id with its ``spans`` (kind, start, end in code points, end exclusive).

    A null or empty text has no spans. A row with a null or repeated doc_id is a row like any other. No rows
    give no rows. Other columns are not read.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for rows, data, bounds in text_chunks(batches):
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in scanner.spans(data, bounds)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    return texts_of(docs).mapInArrow(scan, f"doc_id long, spans {SPANS}")


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns; in ``text`` each found span, with those it overlaps, is replaced by ``mark``.

    A null text stays null.
    """
    names = docs.columns

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for rows, data, bounds in text_chunks(batches):
            spans = scanner.spans(data, bounds)
            texts = rows.column("text")
            changed = [
                _without(texts[i].as_py(), spans[i], mark) if spans[i] else None for i in range(rows.num_rows)
            ]
            if any(spans):
                new = pa.array([c if s else t for c, s, t in zip(changed, spans, texts.to_pylist(), strict=True)], texts.type)
                rows = rows.set_column(names.index("text"), "text", new)
            yield rows

    return docs.mapInArrow(scan, docs.schema)


def _without(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
