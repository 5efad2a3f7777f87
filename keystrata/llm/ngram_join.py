"""N-gram Jaccard join by token-combination prefixes.

A text is its set of word shingles. Sets are put in one global order of shingles: those in the low part of the hash
range, rare ones before frequent ones, then the rest; each by hash. If two sets are similar enough, the shortest prefixes of both in
which the rare shingles, plus the frequent ones less one, outnumber the shingles that the set may lack, have a rare
shingle or a pair of frequent ones in common. So rare shingles are indexed alone and frequent ones by pairs; sets so
small that one common shingle may do have all of theirs indexed alone.

Sets that meet in the index are compared by their sizes and by 1024 parity bits, which bound the difference of two
sets from below, and pair by pair by as many parity bits as the sets need. What is left is verified on whole texts:
a meeting with few pairs sends them all, one with many only a spanning forest. First one pair for each set is verified;
then, as long as that brings large groups together, meetings that held pairs back send forests with other sets in the
middle of the trees; and at last every pair that still lies between different components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keystrata.llm.batches import text_slices, utf8
from keystrata.llm.components import components
from keystrata.llm.words import Words, mixed
from keystrata.session import released, written

SKETCH_BITS = 1024
FREQUENT = 1000  # sets that hold a shingle, from which on it is frequent; raised so that at most 2 ** 20 are
MARKS = 1 << 26  # bits by which texts are sorted out before they are moved: 8 MB
MEETING = 4096  # sets that are compared in one place
PAIRS = 1 << 16  # pairs that are sent on together
_SLICE_BYTES = 512 << 10  # texts worked on at once: up to some hundred bytes of numbers are held for each of these
_SKETCHED = 512  # sets whose parity bits are counted together: 4 MB
MANY_PAIRS = 4  # possible pairs for each index row, from which on a meeting sends a forest, and another is verified before all pairs are
ALONE = -1  # the block of rare shingles
_MULTIPLIERS = [pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(64)]


class Shingles:
    """Distinct shingles of each text as sorted 64-bit hashes: ``hashes[bounds[i]:bounds[i + 1]]``.

    A text with fewer than ``k`` words has all of them as its only shingle; one without words has none.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, k: int):
        words = Words(data, offsets)
        h, texts = words.hashes, len(offsets) - 1
        last = len(h) - k + 1
        full = np.zeros(max(last, 0), np.uint64)
        for j in range(k if last > 0 else 0):
            full += h[j : j + last] * np.uint64(_MULTIPLIERS[j])
        inside = words.text_of[:last] == words.text_of[k - 1 :] if last > 0 else np.zeros(0, bool)
        owner, found = words.text_of[:last][inside] if last > 0 else np.zeros(0, np.int64), mixed(full[inside] + np.uint64(k))
        short = np.flatnonzero((words.per_text > 0) & (words.per_text < k))
        if len(short):
            first = np.cumsum(words.per_text) - words.per_text
            sums = np.zeros(len(short), np.uint64)
            for j in range(k - 1):
                has = words.per_text[short] > j
                sums[has] += h[first[short[has]] + j] * np.uint64(_MULTIPLIERS[j])
            owner = np.concatenate([owner, short])
            found = np.concatenate([found, mixed(sums + words.per_text[short].astype(np.uint64))])
            by = np.argsort(owner, kind="stable")
            owner, found = owner[by], found[by]
        ends = np.searchsorted(owner, np.arange(texts + 1))
        for a, b in zip(ends, ends[1:]):
            found[a:b].sort()
        new = np.ones(len(found), bool)
        new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
        self.hashes, self.owner = found[new], owner[new]
        self.bounds = np.searchsorted(self.owner, np.arange(texts + 1))
        self.sizes = np.diff(self.bounds)


def _sums(values: np.ndarray, owner: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[np.uint64(0)], np.cumsum(values)])
    return (total[bounds[1:]] - total[bounds[:-1]]).view(np.int64)


def _sets(k: int, part: float, lack: tuple[int, int]):
    """For each text: size and 128-bit fingerprint of its set, the start of its global order, and its parity bits."""
    border = np.uint64(min(int(part * 2**64), 2**64 - 1))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", _SLICE_BYTES):
            s = Shingles(*utf8(batch.column("text")), k)
            n_low = np.bincount(s.owner[s.hashes < border], minlength=len(s.sizes))
            need = np.minimum(s.sizes, np.maximum(n_low, s.sizes * lack[0] // lack[1] + 2))
            bits = _sketches(s)
            wide = [_wide(s.hashes[a:b]) for a, b in zip(s.bounds, s.bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("h"),
                    pa.array(s.sizes),
                    pa.array(_sums(mixed(s.hashes ^ np.uint64(0x5851F42D4C957F2D)), s.owner, s.bounds)),
                    pa.array(_sums(mixed(s.hashes ^ np.uint64(0x14057B7EF767814F)), s.owner, s.bounds)),
                    pa.array([s.hashes[a : a + m].tobytes() for a, m in zip(s.bounds, need)], pa.binary()),
                    pa.array([row.tobytes() for row in bits], pa.binary()),
                    pa.array(wide, pa.binary()),
                ],
                names=["id", "h", "n", "f1", "f2", "order", "bits", "wide"],
            )

    return work


def _sketches(s: Shingles) -> np.ndarray:
    """The parity bits of each set, a row each. Counts of short texts take far more room than the texts, so only some sets are counted at once."""
    bits = np.zeros((len(s.sizes), SKETCH_BITS // 8), np.uint8)
    for first in range(0, len(s.sizes), _SKETCHED):
        last = min(first + _SKETCHED, len(s.sizes))
        mine = slice(s.bounds[first], s.bounds[last])
        cells = (s.owner[mine] - first) * SKETCH_BITS + (s.hashes[mine] & np.uint64(SKETCH_BITS - 1)).astype(np.int64)
        odd = (np.bincount(cells, minlength=(last - first) * SKETCH_BITS) & 1).astype(np.uint8)
        bits[first:last] = np.packbits(odd.reshape(-1, SKETCH_BITS), axis=1)
    return bits


def _wide(hashes: np.ndarray) -> bytes:
    """Parity bits of a set, 1 to 2 for each of its shingles."""
    size = max(64, 1 << (len(hashes) - 1).bit_length()) if len(hashes) else 64
    return np.packbits(np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size).astype(np.uint8) & 1, bitorder="little").tobytes()


def _narrowed(bits: np.ndarray, size: int) -> np.ndarray:
    """Parity bits as if the set had been given only so many bytes of them."""
    while len(bits) > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def _plausible(above: tuple[int, int]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, m, n in zip(*(batch.column(c).to_pylist() for c in ("wide_a", "wide_b", "n_a", "n_b"))):
                size = min(len(x), len(y))
                differ = int(np.bitwise_count(_narrowed(np.frombuffer(x, np.uint8), size) ^ _narrowed(np.frombuffer(y, np.uint8), size)).sum())
                keep.append(differ * (above[1] + above[0]) <= (above[1] - above[0]) * (m + n))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])

    return work


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = utf8(batch.column("order"))
    return np.frombuffer(raw.tobytes(), np.uint64), offsets // 8


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many sets may index each shingle, in the low part of the hash range or above it."""
    for batch in batches:
        found, n = np.unique(_flat(batch)[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["token", "n"])


def _index(frequent, part: float, lack: tuple[int, int]):
    """Signatures of each set. ``frequent``: sorted frequent shingles and the number of sets that hold each.

    Rare shingles go to block ALONE, what is frequent to as many blocks as its sets need. ``x``: the (first) shingle.
    """
    border = np.uint64(min(int(part * 2**64), 2**64 - 1))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, held = frequent.value
        for batch in batches:
            tokens, offsets = _flat(batch)
            place = np.minimum(np.searchsorted(hot, tokens), max(len(hot) - 1, 0))
            is_hot = hot[place] == tokens if len(hot) else np.zeros(len(tokens), bool)
            sizes = batch.column("n").to_numpy()
            rows, signatures, blocks, firsts = [], [], [], []
            for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
                need = int(sizes[i]) * lack[0] // lack[1] + 1
                hot_here = is_hot[a:b]
                rare, pairs = prefix(hot_here, tokens[a:b] < border, need)
                rows.append(np.full(len(rare), i))
                signatures.append(tokens[a:b][rare])
                blocks.append(np.full(len(rare), ALONE))
                firsts.append(tokens[a:b][rare])
                if len(pairs):
                    x, y = np.triu_indices(len(pairs), 1)
                    one = tokens[a + pairs[x]]
                    signature = mixed(one * np.uint64(_MULTIPLIERS[0]) + tokens[a + pairs[y]] * np.uint64(_MULTIPLIERS[1]))
                    # A frequent pair may be held by as many sets as its rarer half; they are compared block by block.
                    parts = -(-np.minimum(held[place[a + pairs[x]]], held[place[a + pairs[y]]]) // MEETING)
                    if int(sizes[i]) <= need:  # the set ends before its prefix: one shingle in common may do
                        signature, one = (np.concatenate([v, tokens[a + pairs]]) for v in (signature, one))
                        parts = np.concatenate([parts, -(-held[place[a + pairs]] // MEETING)])
                    mine = int(mixed(np.array([batch.column("s")[i].as_py()], np.int64).view(np.uint64))[0])
                    number = np.repeat(np.arange(len(parts)), parts)
                    other = np.arange(len(number)) - np.repeat(np.cumsum(parts) - parts, parts)
                    own = mine % parts[number].astype(np.uint64)
                    low, high = np.minimum(own.astype(np.int64), other), np.maximum(own.astype(np.int64), other)
                    rows.append(np.full(len(number), i))
                    signatures.append(signature[number])
                    firsts.append(one[number])
                    blocks.append(low << 31 | high)
            if not rows:
                continue
            at = pa.array(np.concatenate(rows))
            columns = [pa.array(np.concatenate(signatures).view(np.int64)), pa.array(np.concatenate(blocks)), batch.column("s").take(at), batch.column("n").take(at)]
            columns.append(pa.array(np.concatenate(firsts).view(np.int64)))
            yield pa.RecordBatch.from_arrays(columns, names=["signature", "block", "s", "n", "x"])

    return work


def prefix(is_hot: np.ndarray, is_low: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rare and of the frequent shingles in the shortest prefix with rare + (frequent - 1) >= need.

    The order is: rare shingles in the first part of the hash range, frequent ones there, the rest; each by hash. Of
    the rest both kinds are taken as they come: whole sets are not at hand, to tell which of their shingles are rare.
    """
    rare = np.flatnonzero(is_low & ~is_hot)[:need]
    if len(rare) >= need:
        return rare, rare[:0]
    frequent = np.flatnonzero(is_low & is_hot)[: need - len(rare) + 1]
    missing = need - len(rare) - max(0, len(frequent) - 1)
    rest = np.flatnonzero(~is_low)
    # The first frequent shingle does not count.
    rest = rest[: missing + (missing > 0 and not len(frequent) and bool(is_hot[rest[:missing]].any()))]
    return np.concatenate([rare, rest[~is_hot[rest]]]), np.concatenate([frequent, rest[is_hot[rest]]])


def _meetings(above: tuple[int, int], forest: bool, turn: int = 0):
    """Pairs of each signature that may be similar and lie between different components. Rows come sorted by (signature, block).

    ``forest``: a meeting with more than MANY_PAIRS of these pairs for each set, four times as many in each later turn, sends
    only a spanning forest of the components, from the sets that come first: in turn 0 those of smallest number, in each later
    one others. Its signature and block follow in a row of their own, as it held pairs back. Else all pairs.
    """
    numerator, denominator = above

    def pairs_of(s, n, bits, c):
        s, first = np.unique(s, return_index=True)
        n, bits, c = n[first], bits[first], c[first]
        if turn:
            order = np.argsort(mixed(s.view(np.uint64) * np.uint64(_MULTIPLIERS[turn % 64]) + np.uint64(turn)))
            s, n, bits, c = s[order], n[order], bits[order], c[order]
        tree = np.unique(c, return_inverse=True)[1]
        room, kept = MANY_PAIRS * 4**turn * len(s), []  # all pairs, as long as they are few

        def joining(i, later):
            new = []
            for j in later.tolist():
                if tree[i] != tree[j]:
                    tree[tree == tree[j]] = tree[i]
                    new.append(j)
            return np.full(len(new), s[i]), s[np.array(new, np.int64)]

        for i in range(len(s) - 1):
            later = np.flatnonzero(tree[i + 1 :] != tree[i]) + i + 1
            small, large = np.minimum(n[i], n[later]), np.maximum(n[i], n[later])
            later = later[denominator * small >= numerator * large]
            # |x ^ y| <= (1 - t) / (1 + t) * (|x| + |y|) for Jaccard t, and the parity bits differ in no more places.
            differ = np.bitwise_count(bits[later] ^ bits[i]).sum(axis=1, dtype=np.int64)
            later = later[differ * (denominator + numerator) <= (denominator - numerator) * (n[i] + n[later])]
            if not len(later):
                continue
            if not forest:
                yield np.full(len(later), s[i]), s[later]
                continue
            kept.append((i, later))
            room -= len(later)
            if room < 0:
                yield from (joining(*pairs) for pairs in kept)
                kept = []
        if room < 0:
            yield None
        else:
            yield from ((np.full(len(later), s[i]), s[later]) for i, later in kept)

    def sent(found: list[tuple[np.ndarray, np.ndarray]], held_back: list[tuple[int, int]] = ()) -> pa.RecordBatch:
        n, m = sum(len(pair[0]) for pair in found), len(held_back)
        pairs = [pa.array(np.concatenate([np.zeros(0, np.int64), *(pair[k] for pair in found)])) for k in (0, 1)]
        places = [pa.array([place[k] for place in held_back], pa.int64()) for k in (0, 1)]
        columns = [*([x, pa.nulls(m, pa.int64())] for x in pairs), *([pa.nulls(n, pa.int64()), x] for x in places)]
        return pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in columns], names=["a", "b", "signature", "block"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _and_end(batches):
            rows = None if batch is None else [batch.column(k).to_numpy() for k in ("signature", "block", "s", "n", "c")]
            if rows is not None:
                rows.append(utf8(batch.column("bits"))[0].reshape(-1, SKETCH_BITS // 8).view(np.uint64))
                rest = rows if rest is None else [np.concatenate([x, y]) for x, y in zip(rest, rows)]
            if rest is None or not len(rest[0]):
                continue
            change = np.flatnonzero((rest[0][1:] != rest[0][:-1]) | (rest[1][1:] != rest[1][:-1])) + 1
            edges = np.concatenate([[0], change, [len(rest[0])]] if batch is None else [[0], change])
            sizes = np.diff(edges)
            found, held_back, n = [], [], 0
            for a, m in zip(edges[:-1][sizes > 1], sizes[sizes > 1]):
                for pairs in pairs_of(*(rest[k][a : a + m] for k in (2, 3, 5, 4))):
                    if pairs is None:
                        held_back.append((int(rest[0][a]), int(rest[1][a])))
                        continue
                    found.append(pairs)
                    n += len(pairs[0])
                    if n >= PAIRS:  # all pairs of one meeting may be millions
                        yield sent(found)
                        found, n = [], 0
            rest = [x[edges[-1] :] for x in rest]
            yield sent(found, held_back)

    return work


def _and_end(batches):
    yield from batches
    yield None


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for part in text_slices(batches, "text", _SLICE_BYTES):
        texts = [pack.compress(t.as_buffer()) for t in part.column("text").cast(pa.large_binary())]
        yield pa.RecordBatch.from_arrays([part.column("s"), pa.array(texts, pa.binary())], names=["s", "z"])


def _verified(k: int, above: tuple[int, int]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()

        def shingles(z: pa.Scalar) -> np.ndarray:
            text = np.frombuffer(unpack.decompress(z.as_buffer()), np.uint8)
            return Shingles(text, np.array([0, len(text)]), k).hashes

        for batch in batches:
            similar = []
            for x, y in zip(batch.column("z_a"), batch.column("z_b")):
                a, b = shingles(x), shingles(y)
                both = len(np.intersect1d(a, b, assume_unique=True))
                similar.append(above[1] * both >= above[0] * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(similar, pa.bool_())], names=["a", "b", "similar"])

    return work


def _marked(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts whose hash falls on a bit that a wanted one sets, so that few others are moved for the join.

    The bits are a table of at most MARKS / 32,768 rows of 4 kB, whatever the input; more wanted texts let more others by.
    """
    mark = F.pmod(F.xxhash64("h"), F.lit(MARKS))
    bits = wanted.select(F.bitmap_bucket_number(mark).alias("bucket"), F.bitmap_bit_position(mark).alias("bit"))
    bits = written(bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")), "ngram-join-marks")
    placed = texts.withColumn("bucket", F.bitmap_bucket_number(mark)).withColumn("bit", F.bitmap_bit_position(mark))
    is_set = F.expr("getbit(cast(conv(hex(substring(bits, cast(bit div 8 as int) + 1, 1)), 16, 10) as bigint), cast(bit % 8 as int)) = 1")
    return placed.join(F.broadcast(bits), "bucket").filter(is_set).select(*texts.columns)


def dealt(index: DataFrame, most: int = MEETING, carried: tuple[str, ...] = ()) -> DataFrame:
    """Signature, block, set and the columns that are ``carried``; shingles indexed alone by more than ``most`` sets (``m``) are spread over blocks, too.

    Rare ones are that many only where the bound of frequent ones had to be raised above ``most``.
    """
    parts = F.when((F.col("block") == ALONE) & (F.col("m") > most), F.ceil(F.col("m") / most)).otherwise(1)
    own = F.pmod(F.xxhash64("s"), "parts")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other")
    rows = index.withColumn("parts", parts.cast("long")).select("signature", "block", "s", *carried, "parts", own.alias("own"), other)
    pair = F.shiftleft(F.least("own", "other"), 31).bitwiseOR(F.greatest("own", "other"))
    return rows.select("signature", F.when(F.col("parts") > 1, pair).otherwise(F.col("block")).alias("block"), "s", *carried)


def ngram_join(
    docs: DataFrame,
    k: int = 5,
    above: tuple[int, int] = (80, 100),
    id_column: str = "doc_id",
    text_column: str = "text",
    frequent_from: int = FREQUENT,
) -> DataFrame:
    """One row per input row: id, ``n_shingles`` and ``component_id``.

    Two rows are linked when the intersection of their sets of ``k``-word shingles is at least ``above`` (as a
    fraction) of their union; ``component_id`` is the smallest id that links reach, the row's own included. Words are
    runs without white space, A-Z lower-cased. Texts that are NULL or have no words are empty sets and linked with
    nothing. Rows with equal sets are linked; ids may repeat. A row with a NULL id links like others, and its component_id is
    NULL only if no row it reaches has an id. Other columns are not read, whatever their names.
    """
    above = tuple(int(v) for v in above)
    lack = (above[1] - above[0], above[1])  # the share of its shingles that a set may lack
    part = min(1.0, 1.6 * lack[0] / lack[1])
    kind = docs.schema[id_column].dataType.simpleString()
    given = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")).withColumn("h", F.md5("text"))
    rows = given.select("id", "h", "text").mapInArrow(_sets(k, part, lack), f"id {kind}, h string, n long, f1 long, f2 long, order binary, bits binary, wide binary")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "ngram-join-sets")

    # Rows with equal sets are one set from here on, known by the smallest row number.
    sets = rows.filter("n > 0").groupBy("n", "f1", "f2").agg(F.min("row").alias("s"))
    members = written(rows.select("row", "id", "n", "f1", "f2").join(sets, ["n", "f1", "f2"], "left").select("row", "id", "n", "s"), "ngram-join-members")
    first = members.filter("row = s").select("s")
    alone = written(rows.select(F.col("row").alias("s"), "h", "n", "order", "bits", "wide").join(first, "s", "left_semi"), "ngram-join-distinct")
    released(rows)

    spark = docs.sparkSession
    counted = written(alone.select("order").mapInArrow(_counted, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).filter(f"n >= {int(frequent_from)}"), "ngram-join-frequent")
    bound = int(alone.agg(F.coalesce(F.sum(F.length("order")), F.lit(0))).first()[0]) // 8 // (1 << 20)
    hot = counted.filter(F.col("n") > bound).toArrow()  # at most 2 ** 20 shingles can each have more than the 2 ** 20th part
    tokens, held = hot.column("token").to_numpy().view(np.uint64), hot.column("n").to_numpy()
    by = np.argsort(tokens)
    frequent = spark.sparkContext.broadcast((tokens[by], held[by]))

    # Most shingles are in one set alone, and most sets that meet by chance differ in size: only sets go on that meet one
    # of a size which allows the similarity. If any set does, the next in the order of sizes does.
    met = Window.partitionBy("signature", "block")
    by_size = met.orderBy("n")
    index = alone.select("s", "n", "order").mapInArrow(_index(frequent, part, lack), "signature long, block long, s long, n long, x long")
    index = index.select("*", F.lag("n").over(by_size).alias("less"), F.lead("n").over(by_size).alias("more")).withColumn("m", F.count(F.lit(1)).over(met))
    fits = (above[1] * F.col("less") >= above[0] * F.col("n")) | (above[1] * F.col("n") >= above[0] * F.col("more"))
    index = written(dealt(index.filter(fits), carried=("x",)), "ngram-join-index")

    def meet(rows: DataFrame, forest: bool, turn: int = 0) -> DataFrame:
        """Pairs of the sets that meet in these rows, and whose components ``c`` differ, that may be similar, and meetings that held some back."""
        near = rows.join(alone.select("s", "n", "bits"), "s").repartition("signature", "block").sortWithinPartitions("signature", "block")
        return written(near.mapInArrow(_meetings(above, forest, turn), "a long, b long, signature long, block long").distinct(), "ngram-join-pairs")

    def pairs_in(sent: DataFrame) -> DataFrame:
        return sent.filter("a is not null").select("a", "b")

    def still_apart(rows: DataFrame, found: DataFrame, sent: DataFrame) -> tuple[DataFrame, int, int]:
        """Rows of meetings that held pairs back and hold several components, and how many pairs between them and rows there are."""
        rows = rows.select("signature", "block", "s", "x").join(found.select(F.col("node").alias("s"), F.col("component").alias("c")), "s", "left")
        rows = rows.withColumn("c", F.coalesce("c", "s"))
        # A meeting that held pairs back has a row without a set here. Meetings are small enough for one place.
        rows = rows.unionByName(sent.filter("signature is not null").select("signature", "block"), allowMissingColumns=True).repartition("signature", "block")
        rows = rows.withColumns({"back": F.max(F.col("s").isNull()).over(met), "m": F.count("s").over(met), "low": F.min("c").over(met), "high": F.max("c").over(met)})
        rows = rows.filter("s is not null and back and low < high").withColumn("same", F.count(F.lit(1)).over(Window.partitionBy("signature", "block", "c")))
        rows = written(rows.select("signature", "block", "s", "x", "c", "m", "same"), "ngram-join-apart")
        pairs, size = rows.agg(F.coalesce(F.sum(F.col("m") - F.col("same")), F.lit(0)) / 2, F.count(F.lit(1))).first()
        return rows, int(pairs), int(size)

    def by_shingle(rows: DataFrame) -> DataFrame:
        """The rows, where meetings of pairs of shingles become one of all their sets by the first shingle if that is less to compare.

        Sets of a large group meet at every pair of frequent shingles they share, that is as often as the square of these.
        """
        sets = rows.groupBy("x", "s").agg(F.min("c").alias("c"), F.sum("m").alias("compared"))
        fewer = sets.groupBy("x").agg(F.count(F.lit(1)).alias("m"), F.sum("compared").alias("compared")).filter("m * m <= compared")
        fewer = written(fewer.select("x", "m"), "ngram-join-shingles")
        joined = dealt(sets.join(fewer, "x").withColumns({"signature": F.col("x"), "block": F.lit(ALONE).cast("long")}), carried=("x", "c"))
        rest = rows.join(fewer, "x", "left_anti").select(joined.columns)
        found = written(joined.union(rest), "ngram-join-together")
        released(fewer)
        return found

    def plausible(pairs: DataFrame) -> DataFrame:
        side = lambda c: alone.select(F.col("s").alias(c), F.col("n").alias(f"n_{c}"), F.col("wide").alias(f"wide_{c}"))
        return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_plausible(above), "a long, b long")

    sent = meet(index.withColumn("c", F.col("s")), forest=True)
    # Every set with any pair is in one that is sent, so texts are fetched once, for all rounds, and other sets are done with.
    wanted = written(alone.select("s", "h").join(pairs_in(sent).select(F.explode(F.array("a", "b")).alias("s")).distinct(), "s"), "ngram-join-wanted")
    # Equal texts would give one row each; any of them serves.
    texts = _marked(given.select("h", "text"), wanted).join(wanted, "h").groupBy("s").agg(F.min("text").alias("text"))
    texts = written(texts.mapInArrow(_packed, "s long, z binary"), "ngram-join-texts")

    def verify(pairs: DataFrame) -> DataFrame:
        side = lambda c: texts.select(F.col("s").alias(c), F.col("z").alias(f"z_{c}"))
        return written(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_verified(k, above), "a long, b long, similar boolean"), "ngram-join-verified")

    def one_each(pairs: DataFrame, turn: int = 0) -> DataFrame:
        """One pair for each set that is not in the middle of a tree, in each turn with another set; the smaller set first."""
        first = F.min_by("a", F.xxhash64("a", F.lit(turn))) if turn else F.min("a")
        one = plausible(pairs).groupBy("b").agg(first.alias("a"))
        return written(one.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "ngram-join-forest")

    def unchecked(pairs: DataFrame) -> DataFrame:
        done = reduce(DataFrame.union, checked).select("a", "b")
        return pairs.join(done.union(done.select("b", "a")), ["a", "b"], "left_anti")

    def similar() -> DataFrame:
        return reduce(DataFrame.union, checked).filter("similar").select("a", "b")

    checked = [verify(one_each(pairs_in(sent)))]
    joined = components(similar())
    pairs_sent = [sent]
    earlier, pairs, size = still_apart(index, joined, sent)
    rows = by_shingle(earlier)
    released(index, earlier)
    turn, before = 1, None
    # Each set of a large group gets another partner, until hardly any is left apart or partners no longer help.
    while pairs > MANY_PAIRS * size and (before is None or 10 * pairs < 9 * before):
        sent = meet(rows, forest=True, turn=turn)
        pairs_sent.append(sent)
        checked.append(verify(one_each(unchecked(pairs_in(sent)), turn)))
        earlier, before = rows, pairs
        joined = components(similar())
        rows, pairs, size = still_apart(earlier, joined, sent)
        released(earlier)
        turn += 1
    if pairs:
        pairs_sent.append(meet(rows, forest=False))
    # All pairs of every meeting have been sent by now, unless links join their sets already.
    side = lambda c: joined.select(F.col("node").alias(c), F.col("component").alias(f"c_{c}"))
    apart = reduce(DataFrame.union, map(pairs_in, pairs_sent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    apart = apart.join(side("a"), "a", "left").join(side("b"), "b", "left").filter(F.coalesce("c_a", "a") != F.coalesce("c_b", "b"))
    more = written(plausible(unchecked(apart.select("a", "b"))), "ngram-join-more")
    released(rows, *pairs_sent)
    if not more.isEmpty():
        checked.append(verify(more))
        joined = components(similar())
    classes = members.join(joined.select(F.col("node").alias("s"), "component"), "s", "left")
    classes = written(classes.select("id", "n", F.coalesce("component", "s").alias("c"), "row"), "ngram-join-classes")
    released(members, alone, counted, wanted, texts, *checked, more)
    smallest = classes.filter("c is not null").groupBy("c").agg(F.min("id").alias("component_id"))
    return classes.join(smallest, "c", "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.when(F.col("c").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    )
