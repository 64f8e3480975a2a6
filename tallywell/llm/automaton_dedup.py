"""Substring dedup of word sequences by suffix automata.

Documents are streamed through the suffix automaton of a reference shard; after each word it tells how long the longest
match ending there is (the matching statistics), and its states know where their strings ended first. A window of words
is removed if it occurs earlier.

A shard holds the pieces (see ``anchors``) of some anchors, each once and in the order of documents, and the pieces are
streamed through it where it is built. So each automaton has a bounded size and meets only the parts of documents that
can match it, rather than every automaton being sent to every document, which would cost their product.
"""

import numpy as np
from pyspark.sql import DataFrame

from tallywell.llm.anchors import Units, alone, covered, cut, keyed

WIDTH = 20
GRAM = 5


class SuffixAutomaton:
    """All substrings of the sequences added; a state's ``ends`` is where its strings ended first."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ends = [-1]
        self.last = 0
        self.size = 0

    def add(self, symbol: int) -> None:
        nexts, links, lengths = self.next, self.link, self.length
        new = len(nexts)
        nexts.append({})
        lengths.append(lengths[self.last] + 1)
        links.append(0)
        self.ends.append(self.size)
        p = self.last
        while p >= 0 and symbol not in nexts[p]:
            nexts[p][symbol] = new
            p = links[p]
        if p >= 0:
            q = nexts[p][symbol]
            if lengths[p] + 1 == lengths[q]:
                links[new] = q
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[q]))
                lengths.append(lengths[p] + 1)
                links.append(links[q])
                self.ends.append(self.ends[q])
                while p >= 0 and nexts[p].get(symbol) == q:
                    nexts[p][symbol] = copy
                    p = links[p]
                links[q] = links[new] = copy
        self.last = new
        self.size += 1

    def matches(self, sequence: list[int], width: int) -> list[int]:
        """After each symbol: where the last ``width`` symbols first ended among those added, or -1 if nowhere."""
        nexts, links, lengths, ends = self.next, self.link, self.length, self.ends
        state = matched = 0
        out = []
        for symbol in sequence:
            while state and symbol not in nexts[state]:
                state = links[state]
                matched = lengths[state]
            if symbol in nexts[state]:
                state = nexts[state][symbol]
                matched += 1
            if matched >= width:
                while lengths[links[state]] >= width:
                    state = links[state]
                matched = min(matched, lengths[state])
                out.append(ends[state])
            else:
                out.append(-1)
        return out


def first_words(contents: list[bytes], anchor: np.ndarray, width: int = WIDTH):
    """See ``anchors.Search``; contents are words joined by single spaces."""
    only = alone(anchor)
    symbols: dict[bytes, int] = {}
    sequences = [[symbols.setdefault(w, len(symbols)) for w in c.split(b" ")] for c in contents]
    automaton, of_end, begins, at = SuffixAutomaton(), [], [], 0
    searched = []
    for k, s in enumerate(sequences):
        begins.append(at)
        if only[k] and not _repeats(s, width):
            searched.append(False)
            continue
        searched.append(True)
        for x in s:
            automaton.add(x)
        automaton.add(-1 - k)  # occurs nowhere else, so no match goes beyond a piece
        at += len(s) + 1
        of_end += [k] * (len(s) + 1)
    number, owner, place = [], [], []
    for k, s in enumerate(sequences):
        windows = len(s) - width + 1
        number += [k] * windows
        if searched[k]:
            for end in automaton.matches(s, width)[width - 1 :]:
                j = of_end[end]
                owner.append(j)
                place.append(end - width + 1 - begins[j])
        else:
            owner += [k] * windows
            place += range(windows)
    return np.array(number, np.int64), np.array(owner, np.int64), np.array(place, np.int64)


def _repeats(sequence: list[int], width: int) -> bool:
    """Whether a window of it may occur twice in it."""
    if len(set(sequence)) == len(sequence):
        return False
    windows = [tuple(sequence[i : i + width]) for i in range(len(sequence) - width + 1)]
    return len(set(windows)) < len(windows)


def deduplicated_words(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Every row's doc_id, n words, n_removed, n_spans, spans (of words) and kept: its words but those covered by a window of
    ``width`` words that also starts earlier, in a document with a smaller doc_id or further ahead in the same one.

    Windows are judged on the input. A null or empty text has no words. A null doc_id comes before all others; different
    texts under one doc_id are documents of their own, ordered by a hash of the text; repeated rows are one document,
    and all get its result. No rows give no rows. Other columns are not read.
    """
    units = Units(width, gram, True, True)
    rows = keyed(docs)
    spans = covered(rows, units, lambda c, a: first_words(c, a, width))
    return cut(rows, spans, units)
