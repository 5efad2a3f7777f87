"""Grouping of spelling variants by pivotal grams.

Words that differ by one inserted, deleted or replaced code point are near. Of a word's bigrams the three rarest, and whatever
ties with the third, are its prefix in one order of all bigrams. Two disjoint ones of the three, of least total frequency,
are its pivots; dynamic programming over their positions chooses them. One edit leaves one of two disjoint bigrams whole, so of
two near words the one whose prefix ends first in the order has a pivot that stands in the prefix of the other.

The edit then lies wholly behind the shared bigram or wholly before it. That is the position limit: the words agree from
their start through the bigram, or from the bigram to their end. So pivots are indexed with the part on either side, and a
pivot meets only bigrams of prefixes with the same part. Pairs that meet are verified. Where very many words share a part, what
lies beyond it is compared by deletion instead: the rests are equal once a point is taken from both at one place, or
from the longer one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystrata.llm.batches import strings, text_slices, utf8
from keystrata.llm.words import mixed, power
from keystrata.session import written

LEAST_POINTS = 7
MEETING = 256  # words that meet at a part and are compared pair by pair
TIMES = 10
_SIGNS = 90  # a-z and the code points from C0 to FF
_GRAMS = _SIGNS * _SIGNS
_CRC_BYTES = 64

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def crc32_of_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each run of bytes, continued from ``before``; short runs step side by side."""
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    state = before[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    first, size = starts[order], sizes[order]
    long = int(np.searchsorted(-size, -_CRC_BYTES, side="left"))  # runs of more bytes than that come first
    for i in range(long):
        rest = zlib.crc32(data[first[i] : first[i] + size[i]].tobytes(), int(before[order[i]]))
        state[i] = rest ^ 0xFFFFFFFF
    for t in range(int(size[long:].max(initial=0))):
        live = long + int(np.searchsorted(-size[long:], -t, side="left"))
        now = state[long:live]
        state[long:live] = _CRC[(now ^ data[first[long:live] + t]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out = np.empty(len(starts), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _observed(every: int, least: int):
    """Words of the texts as they are observed, and how often."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            raw, offsets = utf8(batch.column("text"))
            data = _LOWER[raw]
            letter = _LETTER[raw]
            letter[1:] |= raw[:-1] == 0xC3
            border = np.zeros(len(data) + 1, bool)
            border[offsets] = True
            starts = np.flatnonzero(letter & (~np.concatenate([[False], letter[:-1]]) | border[:-1]))
            ends = np.flatnonzero(letter & (~np.concatenate([letter[1:], [False]]) | border[1:])) + 1
            leads = np.concatenate([[0], np.cumsum(data & 0xC0 != 0x80)])
            points = leads[ends] - leads[starts]
            wanted = points >= least
            starts, ends, points = starts[wanted], ends[wanted], points[wanted]
            owner = np.searchsorted(offsets, starts, side="right") - 1
            ids = np.array([zlib.crc32(f"{i}:".encode()) for i in strings(batch.column("id"))], np.uint32)
            h = crc32_of_runs(data, starts, ends, ids[owner])
            lose = h % np.uint32(every) == 0
            wanted = points - lose >= least
            starts, ends, points, h, lose = starts[wanted], ends[wanted], points[wanted], h[wanted], lose[wanted]
            sizes = ends - starts
            cuts = np.concatenate([[0], np.cumsum(sizes)])
            place = np.arange(cuts[-1]) + np.repeat(starts - cuts[:-1], sizes)
            kept = np.ones(len(place), bool)
            if lose.any():
                gone = np.where(lose, h % np.maximum(points, 1).astype(np.uint32), -1).astype(np.int64)
                point = leads[place + 1] - 1 - np.repeat(leads[starts], sizes)
                kept = point != np.repeat(gone, sizes)
            cuts = np.concatenate([[0], np.cumsum(kept)])[cuts]
            texts = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data[place[kept]]))
            counted = pc.value_counts(texts)
            yield pa.RecordBatch.from_arrays([counted.field(0).cast(pa.string()), counted.field(1)], names=["word", "n"])

    return work


def observed_words(docs: DataFrame, every: int = 31, least: int = LEAST_POINTS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word`` and ``n``, its occurrences, of all words of at least ``least`` code points.

    Words are runs ``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased. If ``every`` divides the crc32 of ``<id>:<run>``, the run
    loses its code point number crc32 % length; a NULL id counts as empty text.
    """
    rows = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(_observed(every, least), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Spelled:
    """Signs of a list of words one after the other: ``signs[bounds[i]:bounds[i + 1]]``."""

    def __init__(self, words: pa.Array):
        raw, offsets = utf8(words)
        lead = raw & 0xC0 != 0x80
        place = np.flatnonzero(lead)
        second = np.concatenate([raw, [0]])[place + 1].astype(np.int64)
        self.signs = np.where(raw[place] == 0xC3, second - 0x80 + 26, raw[place].astype(np.int64) - 0x61)
        self.bounds = np.concatenate([[0], np.cumsum(lead)])[offsets]
        self.sizes = np.diff(self.bounds)

    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each bigram's code, word and place in the word."""
        word = np.repeat(np.arange(len(self.sizes)), np.maximum(self.sizes - 1, 0))
        size = np.maximum(self.sizes - 1, 0)
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        at = self.bounds[word] + place
        return self.signs[at] * _SIGNS + self.signs[np.minimum(at + 1, len(self.signs) - 1)], word, place


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.bincount(Spelled(batch.column("word")).grams()[0], minlength=_GRAMS)
        there = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(found[there])], names=["gram", "n"])


def cheapest_disjoint(place: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row of bigram places in rising order, the two that share no code point and weigh least together.

    ``one[j]`` is the lightest bigram that ends before bigram j starts; with two to choose that is all the dynamic program keeps.
    """
    rows = np.arange(len(place))
    best, first, second = np.full(len(place), np.inf), np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    for j in range(1, place.shape[1]):
        one = np.where(place[:, :j] <= place[:, [j]] - 2, weight[:, :j], np.inf)
        k = np.argmin(one, axis=1)
        cost = one[rows, k] + weight[:, j]
        better = cost < best
        best, first, second = np.where(better, cost, best), np.where(better, k, first), np.where(better, j, second)
    return first, second


def _signatures(rank: np.ndarray, frequency: np.ndarray):
    """Two rows for each bigram of a word's prefix: it with all before it, and it with all behind it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spelled = Spelled(batch.column("word"))
            gram, word, place = spelled.grams()
            by = np.lexsort((place, rank[gram], word))
            gram, word, place = gram[by], word[by], place[by]
            first = np.searchsorted(word, np.arange(len(spelled.sizes)))
            turn = np.arange(len(word)) - first[word]
            third = rank[gram[first + 2]]  # a word of 7 code points has 6 bigrams
            prefix = (turn < 3) | (rank[gram] == third[word])
            # The three rarest by place, and which two of them are pivots.
            rarest = first[:, None] + np.arange(3)
            rarest = np.take_along_axis(rarest, np.argsort(place[rarest], axis=1), axis=1)
            chosen = cheapest_disjoint(place[rarest], frequency[gram[rarest]].astype(float))
            pivot = np.zeros(len(word), bool)
            for k in chosen:
                pivot[rarest[np.arange(len(rarest)), k]] = True
            word, place, pivot = word[prefix], place[prefix], pivot[prefix]
            begin, end = spelled.bounds[word], spelled.bounds[word + 1]
            at = begin + place
            head, tail = _hashes(spelled.signs, begin, at + 2, 1), _hashes(spelled.signs, at, end, 2)
            rows = pa.array(np.tile(word, 2))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([head, tail]).view(np.int64)),
                    pa.array(np.repeat(np.array([0, 1], np.int32), len(word))),
                    pa.array(np.tile(place, 2)),
                    pa.array(np.tile(pivot, 2)),
                    *(batch.column(c).take(rows) for c in ("id", "word", "n")),
                    pa.array(np.tile(spelled.sizes[word], 2)),
                ],
                names=["part", "side", "place", "pivot", "id", "word", "n", "size"],
            )

    return work


def _sums(signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of signs times powers, and the inverse powers; differences are hashes of parts, equal for equal parts."""
    up, down = power(len(signs))
    return np.concatenate([[np.uint64(0)], np.cumsum((signs + 1).astype(np.uint64) * up[: len(signs)])]), down


def _hashes(signs: np.ndarray, begin: np.ndarray, end: np.ndarray, salt: int) -> np.ndarray:
    sums, down = _sums(signs)
    return mixed(mixed((sums[end] - sums[begin]) * down[begin]) + np.uint64(salt))


def _deletions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies beyond the part: whole, less each of its points, and less each point with the place of that.

    ``role`` 0: whole, met by 1: less a point of a longer word; 2: less a point at a place, met by its like.
    """
    for batch in batches:
        spelled = Spelled(batch.column("word"))
        sums, down = _sums(spelled.signs)
        one_less = down[min(1, len(down) - 1)]
        part, side, place = (batch.column(c).to_numpy() for c in ("part", "side", "place"))
        begin = np.where(side == 0, spelled.bounds[:-1] + place + 2, spelled.bounds[:-1])
        end = np.where(side == 0, spelled.bounds[1:], spelled.bounds[:-1] + place)
        salt = part.view(np.uint64)
        whole = mixed(mixed((sums[end] - sums[begin]) * down[begin]) ^ salt)
        size = end - begin
        row = np.repeat(np.arange(len(size)), size)
        at = begin[row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        less = ((sums[at] - sums[begin[row]]) + (sums[end[row]] - sums[at + 1]) * one_less) * down[begin[row]]
        shorter = mixed(mixed(less) ^ salt[row])
        placed = mixed(shorter + mixed((at - begin[row] + 1).astype(np.uint64)))
        rows = pa.array(np.concatenate([np.arange(len(size)), row, row]))
        roles = np.repeat(np.array([0, 1, 2], np.int32), [len(size), len(row), len(row)])
        keys = np.concatenate([whole, shorter, placed]).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(roles), batch.column("id").take(rows), batch.column("pivot").take(rows)], names=["rest", "role", "id", "pivot"])


def near_words(words: DataFrame, meeting: int = MEETING) -> DataFrame:
    """``word``, ``n``, ``other``, ``other_n``: every two near words, both ways round. ``words`` has ``word`` and ``n``, each word once."""
    words = written(words.withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    grams = words.select("word").mapInArrow(_gram_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()  # 8,100 rows at most
    frequency = np.zeros(_GRAMS, np.int64)
    frequency[grams.column("gram").to_numpy()] = grams.column("n").to_numpy()
    rank = np.empty(_GRAMS, np.int64)
    rank[np.lexsort((np.arange(_GRAMS), frequency))] = np.arange(_GRAMS)

    schema = "part long, side int, place long, pivot boolean, id long, word string, n long, size long"
    index = words.mapInArrow(_signatures(rank, frequency), schema)
    parts = index.groupBy("part").agg(F.count(F.lit(1)).alias("m"), F.count_if("pivot").alias("pivots")).filter("m > 1 and pivots > 0")
    index = written(index.join(parts.select("part", "m"), "part"), "spelling-meetings")
    few, many = index.filter(F.col("m") <= meeting), index.filter(F.col("m") > meeting)

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("part", *(F.col(c).alias(f"{c}_{name}") for c in ("id", "word", "n", "size")))

    one_edit = (F.col("word_a") != F.col("word_b")) & (F.levenshtein("word_a", "word_b", 1) == 1)
    met = side(few.filter("pivot"), "a").join(side(few, "b"), "part").filter("id_a <> id_b and abs(size_a - size_b) <= 1").filter(one_edit)
    found = met.select("word_a", "n_a", "word_b", "n_b")

    # Of very many words with one part only those meet whose rests agree but for one point.
    rests = many.mapInArrow(_deletions, "rest long, role int, id long, pivot boolean")
    rests = written(rests, "spelling-rests")
    a, b = (rests.select("rest", *(F.col(c).alias(f"{c}_{s}") for c in ("role", "id", "pivot"))) for s in "ab")
    inserted = a.filter("role_a = 0").join(b.filter("role_b = 1"), "rest")
    replaced = a.filter("role_a = 2").join(b.filter("role_b = 2"), "rest").filter("id_a < id_b")
    pairs = inserted.union(replaced).filter("(pivot_a or pivot_b) and id_a <> id_b").select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).distinct()
    for s in "ab":
        pairs = pairs.join(words.select(F.col("id").alias(f"id_{s}"), F.col("word").alias(f"word_{s}"), F.col("n").alias(f"n_{s}")), f"id_{s}")
    found = found.union(pairs.filter(one_edit).select("word_a", "n_a", "word_b", "n_b"))

    names = ["word", "n", "other", "other_n"]
    both = found.toDF(*names).union(found.select("word_b", "n_b", "word_a", "n_a").toDF(*names))
    return both.distinct()


def group_spellings(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_n: int = 2, times: int = TIMES, every: int = 31, meeting: int = MEETING
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``: one row per word that occurs at least ``least_n`` times.

    ``form`` is the near word of largest ``n`` (ties: the smallest in code-point order) if it occurs at least ``times`` as
    often, else NULL; ``root`` is where following forms ends, the word itself if it has none. ``n_near`` counts near
    words, 0 if there are none. See `observed_words` for what a word is. A NULL text has no words, a NULL id counts as
    empty text; rows that repeat count each. Other columns are not read, whatever their names. An empty table
    gives an empty result.
    """
    words = written(observed_words(docs, every, LEAST_POINTS, id_column, text_column).filter(F.col("n") >= least_n), "spelling-counts")
    best = near_words(words, meeting).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("best")
    )
    rows = words.join(best, "word", "left").withColumn("form_n", -F.col("best.less"))
    likely = F.col("form_n") >= times * F.col("n")
    rows = written(
        rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(likely, F.col("best.other")).alias("form"), F.when(likely, F.col("form_n")).alias("form_n")),
        "spelling-forms",
    )
    roots = written(rows.filter("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    # Each round doubles how far a root is followed; a form occurs ten times as often, so chains are short.
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = written(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        roots = after.select("word", "root")
        if after.filter("moved").isEmpty():
            break
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
