"""Removal of repeated byte strings by multi-document Burrows-Wheeler construction.

Every string of ``length`` bytes is assigned to its smallest run of ``ANCHOR`` bytes by hash, the leftmost of equal ones. Equal
strings have equal anchors at equal places, so only pieces of text around equal anchors need to be compared. A piece
is what all strings around one anchor cover; equal pieces repeat all their strings. Different pieces around
equal anchors form small collections. The Burrows-Wheeler transform of a collection and its longest common
prefixes are built column by column: each round inserts one symbol of every piece, from the right, where the
symbol before leads. Where neighbours share ``length`` bytes, the string repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystrata.llm.batches import text_slices, utf8
from keystrata.llm.words import mixed, power
from keystrata.session import released, written

LENGTH = 200
ANCHOR = 64
SLICE_BYTES = 512 << 10  # texts worked on at once: up to some hundred bytes of numbers are held for each of these
COLLECTION_BYTES = 192 << 10  # pieces that are inserted together; the pieces of one anchor stay together
BLOCK = 8192  # different pieces of one anchor beyond which they are compared block by block


def anchored(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int):
    """Text, first start, last start, the anchor's place in the piece, anchor hash and piece hash of each run of strings with one anchor."""
    size, spread = len(data), length - anchor + 1
    empty = np.zeros(0, np.int64)
    if size < length:
        return empty, empty, empty, empty, empty, empty
    up, down = power(size)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:size], out=sums[1:])
    hashes = mixed((sums[anchor:] - sums[:-anchor]) * down[: size - anchor + 1])
    # The place breaks ties, so that the minimum is the leftmost.
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while 2 * reach <= spread:
        least = np.minimum(least[: len(least) - reach], least[reach:])
        reach *= 2
    least = np.minimum(least[: size - length + 1], least[spread - reach : spread - reach + size - length + 1])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    texts = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(place)]
    inside = np.arange(len(place)) + length <= offsets[texts + 1]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (texts[1:] != texts[:-1])
    first = np.flatnonzero(new & inside)
    if not len(first):
        return empty, empty, empty, empty, empty, empty
    ends = np.flatnonzero(inside & np.append(new[1:] | ~inside[1:], True))
    piece = mixed(mixed((sums[ends + length] - sums[first]) * down[first]) + (ends - first).astype(np.uint64))
    return texts[first], first - offsets[texts[first]], ends - offsets[texts[first]], place[first] - first, hashes[place[first]].view(np.int64), piece.view(np.int64)


_NEAR = 64
_RANKED = 256  # places whose symbols are counted together


def _block_of(upto: np.ndarray, symbol: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The block with each symbol's occurrence of that number (from 1), by bisection."""
    low, high = np.zeros(len(symbol), np.int64), np.full(len(symbol), len(upto) - 1)
    for _ in range(len(upto).bit_length()):
        middle = (low + high) >> 1
        reached = upto[middle, symbol] >= number
        high = np.where(reached, middle, high)
        low = np.where(reached, low, np.minimum(middle + 1, high))
    return high


def _places(bwt: np.ndarray, at: np.ndarray, symbol: np.ndarray, kinds: int):
    """For each place: how often its symbol occurs before it, and the nearest places with it before and behind (or -1);
    and how often each symbol occurs at all. Symbols of places are not 0."""
    blocks = len(bwt) // _RANKED + 1
    padded = np.zeros((blocks + 2) * _RANKED, bwt.dtype)
    padded[_RANKED : _RANKED + len(bwt)] = bwt
    cells = padded[_RANKED:-_RANKED].reshape(blocks, _RANKED) + np.arange(0, blocks * kinds, kinds, dtype=np.int32)[:, None]
    upto = np.cumsum(np.bincount(cells.ravel(), minlength=blocks * kinds).reshape(blocks, kinds), axis=0)
    upto[:, 0] -= blocks * _RANKED - len(bwt)  # only the last row of it is used
    near = np.lib.stride_tricks.sliding_window_view(padded, _NEAR)
    wide = np.lib.stride_tricks.sliding_window_view(padded, _RANKED)
    wanted = symbol[:, None]
    block, rest = at // _RANKED, at % _RANKED
    # The last places before ``at`` down to the start of its block.
    back = wide[at] == wanted
    rank = np.where(block > 0, upto[block - 1, symbol], 0) + np.count_nonzero(back & (np.arange(_RANKED) >= (_RANKED - rest)[:, None]), axis=1)
    before = np.where(back.any(axis=1), at - 1 - back[:, ::-1].argmax(axis=1), -1)
    ahead = near[at + _RANKED + 1] == wanted
    behind = np.where(ahead.any(axis=1), at + 1 + ahead.argmax(axis=1), -1)
    total = upto[-1]
    # Symbols that are rare hereabouts: their block is found by its counts.
    far = np.flatnonzero((before < 0) & (rank > 0))
    if len(far):
        b = _block_of(upto, symbol[far], rank[far])
        hit = wide[(b + 1) * _RANKED] == wanted[far]
        before[far] = b * _RANKED + _RANKED - 1 - hit[:, ::-1].argmax(axis=1)
    far = np.flatnonzero((behind < 0) & (rank + 1 < total[symbol]))
    if len(far):
        b = _block_of(upto, symbol[far], rank[far] + 2)
        start = np.where(b == block[far], at[far] + 1, b * _RANKED)  # later in the own block, or the first of another
        behind[far] = start + (wide[start + _RANKED] == wanted[far]).argmax(axis=1)
    return rank, before, behind, total


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece, whether the string of ``length`` bytes at each start occurs at another place in the pieces too."""
    m = len(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, m)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    if not len(data):
        return [np.zeros(0, bool)] * m
    ends = np.cumsum(sizes)
    used = np.flatnonzero(np.bincount(data, minlength=256))
    code = np.zeros(256, np.uint8 if len(used) < 256 else np.uint16)
    code[used] = np.arange(1, len(used) + 1)
    symbols = code[data]
    # The transform, the common prefix of each suffix with the one before, and where each piece's last suffix stands.
    bwt = np.where(sizes > 0, symbols[np.maximum(ends - 1, 0)], 0).astype(code.dtype)
    common = np.zeros(m + 1, np.uint16)  # one more at the end, for open ranges
    active = np.flatnonzero(sizes > 0)
    at = active.copy()
    kinds = len(used) + 1
    for t in range(1, int(sizes.max(initial=0)) + 1):
        by = np.argsort(at)
        active, at = active[by], at[by]
        leading = bwt[at]
        rank, before, behind, total = _places(bwt, at, leading, kinds)
        less = np.cumsum(total) - total
        # The suffix before the leading symbol moves on to m + the number of suffixes that start smaller.
        target = m + less[leading] - total[0] + rank
        ranges = np.stack([np.where(before >= 0, before + 1, at), at + 1, np.where(behind >= 0, behind, at) + 1], axis=1)
        least = np.minimum.reduceat(common, ranges.ravel()).reshape(-1, 3) + np.uint16(1)
        going = sizes[active] > t
        fresh = np.where(going, symbols[np.maximum(ends[active] - t - 1, 0)], 0).astype(code.dtype)
        old = np.ones(len(bwt) + len(at), bool)
        old[target] = False
        wider, longer = np.empty(len(old), code.dtype), np.zeros(len(old) + 1, np.uint16)
        wider[old], wider[target] = bwt, fresh
        longer[:-1][old] = common[:-1]
        longer[target] = np.where(before >= 0, least[:, 0], 0)
        longer[target[behind >= 0] + 1] = least[behind >= 0, 1]
        bwt, common = wider, longer
        active, at = active[going], target[going]
    shares = np.append(common[:-1] >= length, False)
    shares[:-1] |= shares[1:]
    order = np.argsort(bwt, kind="stable")
    index = np.empty(len(order), np.int64)
    index[order] = np.arange(len(order))
    done = int(np.count_nonzero(bwt == 0))
    found = [np.zeros(max(0, n - length + 1), bool) for n in sizes.tolist()]
    flags = np.zeros(len(data), bool)
    active = np.flatnonzero(sizes > 0)
    at = active.copy()
    for t in range(1, int(sizes.max(initial=0)) + 1):
        at = m + index[at] - done
        flags[ends[active] - t] = shares[at]
        going = sizes[active] > t
        active, at = active[going], at[going]
    for i, end in enumerate(ends.tolist()):
        found[i] = flags[end - sizes[i] : end - sizes[i] + len(found[i])]
    return found


def _intervals(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of True."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in text_slices(batches, "text", SLICE_BYTES):
        raw, offsets = utf8(batch.column("text"))
        blob = memoryview(raw.tobytes())
        texts = pa.array([pack.compress(blob[a:b]) for a, b in zip(offsets, offsets[1:])], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.diff(offsets)), texts], names=["id", "n_bytes", "z"])


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes]]]:
    """Parts of a batch, of about a slice of text each."""
    unpack = zstandard.ZstdDecompressor()
    sizes = batch.column("n_bytes").to_numpy()
    part = np.cumsum(sizes) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    packed = batch.column("z")
    for a, b in zip(cuts, cuts[1:]):
        yield a, b, [unpack.decompress(z.as_py()) if n else b"" for z, n in zip(packed[a:b], sizes[a:b])]


def _runs(length: int, anchor: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in _texts(batch):
                data = np.frombuffer(b"".join(texts), np.uint8)
                owner, first, last, place, anchors, pieces = anchored(data, np.cumsum([0, *map(len, texts)]), length, anchor)
                rows = batch.column("row").slice(a, b - a).take(pa.array(owner))
                columns = [rows, *(pa.array(c) for c in (first, last, place, anchors, pieces))]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "first", "last", "place", "anchor", "piece"])

    return work


def _pieces(length: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in _texts(batch):
                out = []
                for text, wanted in zip(texts, batch.column("wanted")[a:b].to_pylist()):
                    for w in wanted:
                        bytes_ = text[w["first"] : w["last"] + length]
                        mine = (w["piece"] & 0x7FFFFFFF) % w["parts"]
                        out += [(w["anchor"], min(mine, p), max(mine, p), w["piece"], w["place"], bytes_) for p in range(w["parts"])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[k] for o in out], pa.binary() if k == 5 else pa.int64()) for k in range(6)], names=["anchor", "low", "high", "piece", "place", "bytes"]
                )

    return work


def _longest_shared(strings: list[bytes]) -> list[int]:
    """For each string, the longest prefix that it has in common with another one."""
    order = sorted(range(len(strings)), key=strings.__getitem__)
    shared = [0] * len(strings)
    for i, j in zip(order, order[1:]):
        x, y = strings[i], strings[j]
        low, high = 0, min(len(x), len(y))
        while low < high:
            middle = (low + high + 1) // 2
            if x[:middle] == y[:middle]:
                low = middle
            else:
                high = middle - 1
        shared[i], shared[j] = max(shared[i], low), max(shared[j], low)
    return shared


def _trimmed(rows: list[tuple], length: int) -> list[tuple]:
    """(anchor, piece, first start, bytes) of the pieces of one anchor, cut to what they can have in common with others.

    A string that two pieces share lies alike around their anchors, so it cannot reach further on either side than any
    two of them agree.
    """
    left = _longest_shared([r[5][: r[4]][::-1] for r in rows])
    right = _longest_shared([r[5][r[4] :] for r in rows])
    return [(r[0], r[3], r[4] - a, r[5][r[4] - a : r[4] + b]) for r, a, b in zip(rows, left, right) if a + b >= length]


def _repeats(length: int):
    def found(rows: list[tuple]) -> pa.RecordBatch:
        out = []
        for (anchor, piece, start, _), flags in zip(rows, repeated_starts([r[3] for r in rows], length)):
            out += [(anchor, piece, int(a) + start, int(b) + start) for a, b in zip(*_intervals(flags))]
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(4)], names=["anchor", "piece", "a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meeting, rows, size, last = [], [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "low", "high", "piece", "place", "bytes"))):
                if meeting and row[:3] != meeting[-1][:3]:
                    anchor, kept = meeting[0][0], _trimmed(meeting, length)
                    # Blocks of one anchor share pieces, so they must not lie in one collection.
                    if rows and (size >= COLLECTION_BYTES or anchor == last):
                        yield found(rows)
                        rows, size = [], 0
                    rows, size, last, meeting = rows + kept, size + sum(len(r[3]) for r in kept), anchor, []
                meeting.append(row)
        kept = _trimmed(meeting, length)
        if rows and meeting and meeting[0][0] == last:
            yield found(rows)
            rows = []
        if rows or kept:
            yield found(rows + kept)

    return work


def _removed(length: int, whole_characters: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in _texts(batch):
                kept, spans = [], []
                for text, marks in zip(texts, batch.column("marks")[a:b].to_pylist()):
                    cover = np.zeros(len(text) + 1, np.int32)
                    for m in marks or ():
                        cover[m["a"]] += 1
                        cover[m["b"] + length] -= 1
                    gone = np.cumsum(cover[:-1]) > 0
                    if whole_characters and gone.any():
                        raw = np.frombuffer(text, np.uint8)
                        start = np.flatnonzero((raw & 0xC0) != 0x80)
                        gone = np.repeat(np.logical_and.reduceat(gone, start), np.diff(np.append(start, len(raw))))
                    first, last = _intervals(gone)
                    spans.append([{"start": int(x), "end": int(y) + 1} for x, y in zip(first, last)])
                    kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes() if len(first) else text)
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                ids = batch.column("id").slice(a, b - a)
                sizes = batch.column("n_bytes").slice(a, b - a)
                yield pa.RecordBatch.from_arrays([ids, sizes, pa.array(spans, kind), pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"])

    return work


def suffix_dedup(
    docs: DataFrame,
    length: int = LENGTH,
    anchor: int = ANCHOR,
    whole_characters: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``spans`` (removed, from ``start`` to before ``end``) and ``kept`` bytes.

    A byte goes when a string of ``length`` bytes that covers it also starts at another place, in the same or in
    another text. Texts are UTF-8 bytes; no string reaches over the end of a text. All is judged on the input,
    so every copy goes. With ``whole_characters`` a character stays unless all its bytes go, and ``kept`` is valid
    UTF-8. A NULL text counts as empty; a text shorter than ``length`` stays. Ids may be NULL or repeat: each row gets its own
    result. Other columns are not read, whatever their names. Equal strings are told by 64-bit hashes of pieces with
    equal 64-bit anchor hashes, or byte by byte where pieces differ.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    given = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    # Rows get their numbers where they are written, once.
    texts = given.mapInArrow(_packed, f"id {kind}, n_bytes long, z binary").withColumn("row", F.monotonically_increasing_id())
    texts = written(texts, "suffix-dedup-texts")

    runs = texts.filter(F.col("n_bytes") >= length).select("row", "n_bytes", "z").mapInArrow(_runs(length, anchor), "row long, first long, last long, place long, anchor long, piece long")
    runs = written(runs.select("row", *(F.col(c).cast("int") for c in ("first", "last", "place")), "anchor", "piece"), "suffix-dedup-runs")
    met = written(runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "suffix-dedup-anchors")
    shared = written(runs.join(met, "anchor"), "suffix-dedup-shared")
    released(runs, met)

    pieces = shared.groupBy("anchor", "piece").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "first", "last", "place")).alias("one"))
    pieces = written(pieces.select("anchor", "piece", "n", "one.*"), "suffix-dedup-pieces")
    different = pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    compared = pieces.join(different, "anchor").withColumn("parts", F.ceil(F.col("kinds") / block).cast("int"))
    wanted = compared.groupBy("row").agg(F.collect_list(F.struct("anchor", "piece", "first", "last", "place", "parts")).alias("wanted"))
    cut = texts.select("row", "n_bytes", "z").join(wanted, "row").mapInArrow(_pieces(length), "anchor long, low long, high long, piece long, place long, bytes binary")
    placed = cut.repartition("anchor", "low", "high").sortWithinPartitions("anchor", "low", "high")
    partly = placed.mapInArrow(_repeats(length), "anchor long, piece long, a long, b long")
    whole = pieces.filter("n > 1").select("anchor", "piece", F.lit(0).cast("long").alias("a"), (F.col("last") - F.col("first")).cast("long").alias("b"))
    repeats = written(partly.union(whole), "suffix-dedup-repeats")
    released(pieces)

    marks = shared.join(repeats, ["anchor", "piece"]).select("row", (F.col("first") + F.col("a")).cast("int").alias("a"), (F.col("first") + F.col("b")).cast("int").alias("b"))
    by_row = marks.groupBy("row").agg(F.collect_list(F.struct("a", "b")).alias("marks"))
    result = texts.join(by_row, "row", "left").select("id", "n_bytes", "z", "marks")
    found = result.mapInArrow(_removed(length, whole_characters), f"id {kind}, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary")
    return found.withColumnRenamed("id", id_column)
