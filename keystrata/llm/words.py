"""Words of whole batches of texts, as arrays over their UTF-8 bytes."""

from __future__ import annotations

import hashlib

import numpy as np

_LONG = 32  # bytes; the sum of powers takes some different longer words for equal
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def power(n: int) -> list[np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2 ** 64."""
    if len(_powers[0]) <= n:
        for k, base in enumerate((_BASE, _INVERSE)):
            whole = np.full((n // (1 << 18) + 1) << 18, base, np.uint64)
            whole[0] = 1
            _powers[k] = np.multiply.accumulate(whole)
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads all bits of 64-bit numbers over all others."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of texts that lie one after the other, A-Z lower-cased.

    ``starts``, ``ends``: places in ``data``; ``text_of``: the text of each word; ``hashes``: 64 bits of its bytes.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = _LOWER[data]
        space = _SPACE[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        first = first[:-1]  # a text starts here
        before = np.ones(len(data), bool)
        before[1:] = space[:-1]
        self.starts = np.flatnonzero(~space & (before | first))
        after = np.ones(len(data), bool)
        after[:-1] = space[1:] | first[1:]
        self.ends = np.flatnonzero(~space & after) + 1
        self.text_of = np.searchsorted(offsets, self.starts, side="right") - 1
        self.per_text = np.bincount(self.text_of, minlength=len(offsets) - 1).astype(np.int64)

    @property
    def hashes(self) -> np.ndarray:
        up, down = power(len(self.data))
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], out=sums[1:])
        found = mixed((sums[self.ends] - sums[self.starts]) * down[self.starts])
        for i in np.flatnonzero(self.ends - self.starts > _LONG):
            found[i] = int.from_bytes(hashlib.blake2b(self.word(i), digest_size=8).digest(), "little")
        return found

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()
