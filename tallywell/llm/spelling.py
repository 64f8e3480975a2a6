"""Grouping of spelling variants over a variable-length gram index.

Words one edit apart (a code point inserted, deleted or replaced) are near. A dictionary of grams is built from the words:
a gram is extended by a letter where it occurs in more than LIMIT places, and its rare extensions, LIMIT places in all, are
pruned again, so that the lists of grams are short or as long as grams may get. Each word is decomposed into the longest
grams of the dictionary; what lies inside an earlier gram is left out. For each word the largest number of its grams that one
edit can affect is known, so a near word holds all but that many, and at least one of that many and one rarest grams: only
their lists are merged, by gram, place and length, which one edit moves by one at most. Pairs that lack more grams than an
edit affects are left out, the others are verified.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywell.llm.common import keep, least_count, release

#: Shortest and longest gram.
SHORTEST, LONGEST = 2, 4
#: A gram in at most so many places is not extended.
LIMIT = 64
#: The dictionary's largest size, as every task holds it. Pruned grams only make lists longer.
MOST_GRAMS = 1 << 17
#: Code points put before and after a word, so that its ends lie in as many grams as its middle.
BEFORE, AFTER = "\x02" * (LONGEST - 1), "\x03" * (LONGEST - 1)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MIX = 0x9E3779B97F4A7C15


def letter_runs(docs: DataFrame) -> DataFrame:
    """doc_id and run: each maximal run of Latin letters of each whole text, A-Z in lower case. A null text has none."""
    text = F.translate(F.col("text").cast("string"), _UPPER, _LOWER)
    runs = F.regexp_extract_all(text, F.lit("([a-zÀ-ÿ]+)"), F.lit(1))
    return docs.select("doc_id", F.explode(runs).alias("run"))


def counted_words(words: DataFrame, shortest: int = 5, least: int = 3) -> DataFrame:
    """word and n: the words with at least ``shortest`` code points that occur ``least`` times or more; nulls do not count."""
    rows = words.select("word").filter(F.length("word") >= shortest)
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def gram_dictionary(words: DataFrame, limit: int = LIMIT, most: int = MOST_GRAMS) -> dict[str, int]:
    """The grams longer than SHORTEST and, for each gram, in how many places no longer one is taken (about).

    A gram is in it if the one it extends occurs more than ``limit`` times, and if it is not among the rarest of such
    extensions that occur ``limit`` times in all. Beyond ``most`` grams the rarest are left out.
    """
    padded = F.concat(F.lit(BEFORE), "word", F.lit(AFTER))

    def cuts_of(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.length("padded") - (size - 1))
        return F.transform(starts, lambda p: F.substring("padded", p, size))

    cuts = [cuts_of(q) for q in range(SHORTEST, LONGEST + 1)]
    grams = words.select(padded.alias("padded")).select(F.explode(F.concat(*cuts)).alias("gram"))
    counts = keep(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "grams")
    stem = F.expr("substring(gram, 1, length(gram) - 1)")
    wide = counts.filter(F.col("n") > limit).select(F.col("gram").alias("stem"))
    longer = counts.filter(F.length("gram") > SHORTEST).withColumn("stem", stem).join(wide, "stem")
    # A gram has at most as many extensions as there are letters.
    rarest = Window.partitionBy("stem").orderBy("n", "gram").rowsBetween(Window.unboundedPreceding, 0)
    chosen = longer.withColumn("held", F.sum("n").over(rarest)).filter(F.col("held") > limit).select("gram", "n")
    chosen = keep(chosen.unionByName(counts.filter(F.length("gram") == SHORTEST)), "dictionary")
    if chosen.count() > most:
        chosen = chosen.filter(F.col("n") >= least_count(chosen, most))
    found = {r.gram: r.n for r in chosen.collect()}  # at most ``most`` rows
    release(counts)
    for gram, n in list(found.items()):
        if len(gram) > SHORTEST:
            found[gram[:-1]] = found.get(gram[:-1], n) - n
    return found


class Decomposition:
    """Decomposes words by a dictionary and bounds what one edit can change."""

    def __init__(self, found: dict[str, int]):
        self.rank = found
        self.longer = {g for g in found if len(g) > SHORTEST}
        self.stems = {g[:-1] for g in self.longer}
        #: What can stand in a gram after its first letter.
        self.inside = {g[a:b] for g in self.longer for a in range(1, len(g)) for b in range(a + 1, len(g) + 1)}

    def grams(self, padded: str) -> list[tuple[int, int, int]]:
        """Start and end (exclusive) of each gram kept, and the last place looked at to choose it."""
        longer, stems, n, far, out = self.longer, self.stems, len(padded), 0, []
        for p in range(n - SHORTEST + 1):
            end = p + SHORTEST
            while end - p < LONGEST and end < n and padded[p : end + 1] in longer:
                end += 1
            if end > far:
                out.append((p, end, end if padded[p:end] in stems else end - 1))
                far = end
        return out

    def affected(self, padded: str, grams: list[tuple[int, int, int]]) -> int:
        """The most grams that one edit between BEFORE and AFTER can change or remove.

        An edit at place i changes the choice of grams that looked at i. It also can make a gram from before i reach over a
        later one, which then is left out: that takes a gram which holds all from behind i to the later one's end, after at
        least one other letter. An insertion before i + 1 does no more than a replacement of i.
        """
        change = [0] * (len(padded) + 2)
        for start, end, seen in grams:
            i = start
            while i > 0 and (end - i < SHORTEST or padded[i:end] in self.inside):
                i -= 1
            change[i] += 1
            change[seen + 1] -= 1
        most, now = 0, 0
        first, last = len(BEFORE) - 1, len(padded) - len(AFTER)
        for i, step in enumerate(change[:last]):
            now += step
            if i >= first and now > most:
                most = now
        return most

    def entries(self, word: str) -> tuple[list[tuple[str, int]], int, int, int]:
        """The rarest grams with their places, all grams as bits, how many an edit affects, and how many remain."""
        padded = BEFORE + word + AFTER
        grams = self.grams(padded)
        most = min(self.affected(padded, grams), len(grams))
        rank, named, bits = self.rank, [], 0
        for p, end, _ in grams:
            gram = padded[p:end]
            named.append((rank.get(gram, 0), gram, p))
            bits |= 1 << ((hash_of(gram) * _MIX >> 58) & 63)
        named.sort()
        return [(g, p) for _, g, p in named[: most + 1]], bits, most, len(grams) - most


def hash_of(gram: str) -> int:
    """The same in every process."""
    h = 0
    for c in gram:
        h = (h * 1000003 + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def _entries(words: DataFrame, found: dict[str, int]) -> DataFrame:
    """A row for each word: its rarest grams with places (``grams``, ``places``), ``bits``, ``most`` and ``left``."""
    shared = words.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Decomposition(shared.value)
        for batch in batches:
            rows = [cut.entries(w) for w in batch.column("word").to_pylist()]
            columns = {
                "word": batch.column("word"),
                "n": batch.column("n"),
                "grams": pa.array([[g for g, _ in r[0]] for r in rows], pa.list_(pa.string())),
                "places": pa.array([[p for _, p in r[0]] for r in rows], pa.list_(pa.int32())),
                "bits": pa.array(np.array([r[1] for r in rows], np.uint64).view(np.int64)),
                "most": pa.array([r[2] for r in rows], pa.int32()),
                "left": pa.array([r[3] for r in rows], pa.int32()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return words.mapInArrow(
        run, "word string, n long, grams array<string>, places array<int>, bits long, most int, left int"
    )


def _one_edit() -> Column:
    return F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1


def near_words(words: DataFrame) -> DataFrame:
    """word, near and near_n: each word of ``words`` (word, n; each word once) with each word one edit away."""
    entries = keep(_entries(words, gram_dictionary(words)), "gram_lists")

    def key(gram, length, place):
        return F.xxhash64(gram, length.cast("int"), place.cast("int"))

    each = entries.select("word", "n", "bits", "most", F.length("word").alias("length"), F.explode(F.arrays_zip("grams", "places")).alias("at"))
    gram, place, length = F.col("at.grams"), F.col("at.places"), F.col("length")
    index = each.select("word", "n", "bits", "most", "length", key(gram, length, place).alias("key"))
    # A longer word has the gram at the same place or one further.
    asked = F.array(key(gram, length, place), key(gram, length + 1, place), key(gram, length + 1, place + 1))
    probes = each.select("word", "n", "bits", "most", "length", F.explode(asked).alias("key"))

    def lacking(one: str, other: str):
        return F.bit_count(F.col(f"{one}.bits").bitwiseAND(F.bitwise_not(f"{other}.bits"))) <= F.col(f"{one}.most")

    ordered = (F.col("a.length") < F.col("b.length")) | (F.col("a.word") < F.col("b.word"))
    alike = (F.col("a.key") == F.col("b.key")) & lacking("a", "b") & lacking("b", "a") & ordered
    by_grams = probes.alias("a").join(index.alias("b"), alike & _one_edit())

    # Words of which an edit can affect all grams need not share one: they meet by what is left without one letter.
    loose = entries.filter("left <= 0").select("word", "n")
    less = F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: _without("word", i))
    rests = loose.select("word", "n", F.explode(F.array_distinct(F.concat(F.array("word"), less))).alias("rest"))
    same = (F.col("a.rest") == F.col("b.rest")) & (F.col("a.word") < F.col("b.word")) & _one_edit()
    by_rests = rests.alias("a").join(rests.alias("b"), same)

    def both(pairs: DataFrame) -> DataFrame:
        ways = F.array(
            F.struct(F.col("a.word").alias("word"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n")),
            F.struct(F.col("b.word").alias("word"), F.col("a.word").alias("near"), F.col("a.n").alias("near_n")),
        )
        return pairs.select(F.inline(ways))

    return both(by_grams).unionByName(both(by_rests)).distinct()


def _without(word: str, place) -> Column:
    """The word without the code point at ``place`` (from 1)."""
    return F.concat(F.substring(word, F.lit(1), place - 1), F.substring(F.col(word), place + 1, F.length(word)))


def _roots(links: DataFrame) -> DataFrame:
    """word and root: where following ``form`` ends. Each round doubles the steps; a form is at least twice as frequent as
    its word, so there are few."""
    now = keep(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = now.select("word", "root").join(further, "root", "left")
        moved = F.col("next").isNotNull().alias("moved")
        last, now = now, keep(stepped.select("word", F.coalesce("next", "root").alias("root"), moved), "roots")
        release(last)
        if now.filter("moved").isEmpty():
            return now.drop("moved")


def spelling_variants(words: DataFrame) -> DataFrame:
    """word, n, form, root, n_near and form_n of each row of ``words`` (word, n; each word once, none null).

    Two words are near if exactly one code point is inserted, deleted or replaced. ``n_near`` counts the near words, 0 if
    there are none. ``form`` is the near word with the greatest n, of equal ones the first in code-point order, where its n
    (``form_n``) is at least twice the word's; else both are null. ``root`` is where following the forms ends, the word itself
    if it has none. The empty word is near every word of one letter. Words of any length are taken whole. Without words there
    are no rows. Other columns of ``words`` are not looked at.
    """
    words = keep(words.select(F.col("word").cast("string"), F.col("n").cast("long")), "words")
    near = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    best = words.join(near, "word", "left").withColumn("best_n", -F.col("best.less"))
    large = F.col("best_n") >= 2 * F.col("n")
    found = keep(
        best.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(large, F.col("best.near")).alias("form"),
            F.when(large, F.col("best_n")).alias("form_n"),
        ),
        "variants",
    )
    roots = _roots(found.filter(F.col("form").isNotNull()))
    rooted = found.join(roots, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
