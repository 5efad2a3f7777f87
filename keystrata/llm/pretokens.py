"""Text pieces between which no byte pair is merged, for whole batches of texts at once.

The piece pattern of the public byte-level vocabularies is evaluated on arrays of code points instead of by a
regular expression engine; pieces are then known by a 64-bit hash, so that an encoder sees each of them once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Collection
from functools import lru_cache

import numpy as np
import regex

_OTHER, _LETTER, _NUMBER, _SPACE, _EDGE = range(5)
_BORDER = 0x110000  # stands between texts
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LONG = 32


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    table = np.zeros(_BORDER + 1, np.uint8)
    points = "".join(chr(i) for i in range(0xD800)) + " " * 0x800 + "".join(chr(i) for i in range(0xE000, _BORDER))
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, points):
            table[m.start() : m.end()] = kind
    table[0xD800:0xE000] = _OTHER
    table[_BORDER] = _EDGE
    return table


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> list[np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2 ** 64."""
    if len(_powers[0]) <= n:
        for k, base in enumerate((_BASE, _INVERSE)):
            whole = np.full((n // (1 << 18) + 1) << 18, base, np.uint64)
            whole[0] = 1
            _powers[k] = np.multiply.accumulate(whole)
    return _powers


def points_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts with a border before each and after the last, and the places of the borders."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    borders = np.concatenate([[0], np.cumsum(sizes + 1)])
    points = np.empty(borders[-1] + 1, np.int32)
    inside = np.ones(len(points), bool)
    inside[borders] = False
    points[inside] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32)
    points[borders] = _BORDER
    return points, borders


def piece_starts(points: np.ndarray) -> np.ndarray:
    """Places where a piece or a border starts.

    Letters, numbers and other signs form runs that take one blank before them along. Of a run of white space all
    but the last character form a piece unless the text ends there; the last is a piece of its own unless the next
    run takes it. An apostrophe that starts a piece takes s, t, m, d, re, ve or ll along and nothing else.
    """
    kind = _classes()[points]
    before, after = np.empty_like(kind), np.empty_like(kind)
    before[0], before[1:] = _EDGE, kind[:-1]
    after[-1], after[:-1] = _EDGE, kind[1:]
    blank_before = np.zeros(len(points), bool)
    blank_before[1:] = points[:-1] == 0x20
    space = kind == _SPACE
    start = (kind != before) & ~(blank_before & ~space & (kind != _EDGE))
    start |= space & (after != _SPACE) & (after != _EDGE)
    start |= kind == _EDGE
    at = np.flatnonzero((points == 0x27) & start & (after == _LETTER))
    if len(at):
        padded = np.append(points, [_BORDER, _BORDER])
        one, two = padded[at + 1], padded[at + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for places, size in ((at[short], 1), (at[pair], 2)):
            start[places + 1] = False
            start[places + 1 + size] = True
    return np.flatnonzero(start)


def piece_starts_around(points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """`piece_starts` where the spans from ``begin`` to ``end`` are whole pieces, and texts end before and start behind them."""
    cuts = np.unique(np.concatenate([begin, end]))
    starts = piece_starts(np.insert(points, cuts, _BORDER))
    extra = cuts + np.arange(len(cuts))  # places of the inserted borders
    starts = starts[~np.isin(starts, extra)]
    starts = starts - np.searchsorted(extra, starts)
    span = np.searchsorted(begin, starts, side="left") - 1  # the last that begins before
    return starts[(span < 0) | (starts >= end[span])]


class Pieces:
    """The pieces of a list of texts: ``bounds`` (code points), ``hashes``, and the text each belongs to.

    ``added`` tokens are pieces of their own, and what stands between them is split as if it were a text.
    """

    def __init__(self, texts: list[str], added: Collection[str] = ()):
        points, borders = points_of(texts)
        pattern = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        spans = [(borders[i] + 1 + m.start(), borders[i] + 1 + m.end()) for i, text in enumerate(texts) if any(a in text for a in added) for m in pattern.finditer(text)]
        starts = piece_starts_around(points, *np.array(spans, np.int64).T) if spans else piece_starts(points)
        ends = np.append(starts[1:], len(points))
        real = points[starts] != _BORDER
        self.points, self.starts, self.ends = points, starts[real], ends[real]
        self.text_of = np.searchsorted(borders, self.starts, side="right") - 1
        power, inverse = _power(len(points))
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum((points + 1).astype(np.uint64) * power[: len(points)], out=sums[1:])
        h = (sums[self.ends] - sums[self.starts]) * inverse[self.starts]
        h ^= h >> np.uint64(32)
        self.hashes = h
        for i in np.flatnonzero(self.ends - self.starts > _LONG):  # few; a plain power sum is weak on long ones
            self.hashes[i] = int.from_bytes(hashlib.blake2b(self.piece(i).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")

    def piece(self, i: int) -> str:
        return self.points[self.starts[i] : self.ends[i]].tobytes().decode("utf-32-le", "surrogatepass")


class CachedEncoder:
    """Encodes texts through an encoder of single pieces, which is asked once for each different piece.

    The cache holds at most ``most`` pieces; beyond that it starts afresh. ``added`` tokens are encoded apart from the
    text around them.
    """

    def __init__(self, encode: Callable[[list[str]], list], most: int = 1 << 20, added: Collection[str] = ()):
        self.encode, self.most, self.added = encode, most, added
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key among the known ones, -1 where it is not."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[place] == keys, place, -1)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts in a row, and the offsets of the texts in them."""
        pieces = Pieces(texts, self.added)
        unique, index, inverse = np.unique(pieces.hashes, return_index=True, return_inverse=True)
        place = self._place(unique)
        if len(self.keys) + int((place < 0).sum()) > self.most:
            self._clear()
            place = self._place(unique)
        new = np.flatnonzero(place < 0)
        if len(new):
            found = self.encode([pieces.piece(i) for i in index[new]])
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter((t for x in found for t in x), np.int32, int(sizes.sum()))
            keys = np.concatenate([self.keys, unique[new]])
            first = np.concatenate([self.first, len(self.ids) + np.cumsum(sizes) - sizes])
            size = np.concatenate([self.size, sizes])
            self.ids = np.concatenate([self.ids, ids])
            order = np.argsort(keys, kind="stable")
            self.keys, self.first, self.size = keys[order], first[order], size[order]
            place = self._place(unique)
        at = place[inverse]
        sizes = self.size[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.first[at] - (ends - sizes), sizes) + np.arange(total)]
        per_text = np.bincount(pieces.text_of + 1, weights=sizes, minlength=len(texts) + 1).astype(np.int64)
        return ids, np.cumsum(per_text)
