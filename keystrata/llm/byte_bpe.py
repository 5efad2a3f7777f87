"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

Each different piece of text is one row of a group of equally wide rows. A segment tree over the byte positions of
every row stores the leftmost minimum pair rank; a merge reads it at the root, joins two live neighbours and
updates the leaves of the at most three positions it touches, in logarithmic time. All rows of a group take a merge
at once, as array operations.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from keystrata.llm.batches import strings, text_slices
from keystrata.llm.pretokens import CachedEncoder

_NONE = np.int64(1) << 62
_CELLS = 1 << 19


class ByteBPE:
    """Ranks as in a tiktoken file: a line per token, its bytes in base64 and its rank, which is its id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)

    @classmethod
    def from_file(cls, path: str) -> ByteBPE:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the pair has none."""
        if not len(self.pair_keys):
            return np.full(len(left), -1, np.int64)
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def encode_pieces(self, pieces: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(pieces)
        groups: dict[int, list[int]] = {}
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        for i, piece in enumerate(raw):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = (whole,)
            else:
                groups.setdefault(max(2, 1 << (len(piece) - 1).bit_length()), []).append(i)
        for width, members in groups.items():
            step = max(1, _CELLS // width)
            for a in range(0, len(members), step):
                part = members[a : a + step]
                for i, ids in zip(part, self._merge([raw[i] for i in part], width)):
                    out[i] = ids
        return out

    def _merge(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        rows = len(pieces)
        flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(rows, width)
        sizes = np.fromiter(map(len, pieces), np.int64, rows)
        ids = self.byte_ids[flat]
        place = np.arange(width)
        following = np.broadcast_to(place + 1, (rows, width)).copy()
        leading = np.broadcast_to(place - 1, (rows, width)).copy()
        tree = np.full((rows, 2 * width), _NONE, np.int64)
        inner = place[None, :-1] + 1 < sizes[:, None]
        rank = np.full((rows, width), -1, np.int64)
        rank[:, :-1][inner] = self._rank(ids[:, :-1][inner], ids[:, 1:][inner])
        leaves = np.where(rank >= 0, rank * width + place, _NONE)  # the position breaks ties: the leftmost wins
        tree[:, width:] = leaves
        level = width
        while level > 1:
            np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2], out=tree[:, level // 2 : level])
            level //= 2
        live = np.flatnonzero(tree[:, 1] < _NONE)
        while len(live):
            top = tree[live, 1]
            at = top % width
            right = following[live, at]
            ids[live, at] = top // width  # the rank of a pair is the id of its merger
            ids[live, right] = -1
            after = following[live, right]
            following[live, at] = after
            has_after, before = after < sizes[live], leading[live, at]
            leading[live[has_after], after[has_after]] = at[has_after]
            has_before = before >= 0
            tree[live, width + right] = _NONE
            self._leaf(tree, ids, live, at, after, has_after, width)
            self._leaf(tree, ids, live[has_before], before[has_before], at[has_before], np.ones(int(has_before.sum()), bool), width)
            self._lift(tree, live, right, width)
            self._lift(tree, live, at, width)
            self._lift(tree, live[has_before], before[has_before], width)
            live = live[tree[live, 1] < _NONE]
        return [row[:n][row[:n] >= 0] for row, n in zip(ids, sizes)]

    def _leaf(self, tree, ids, rows, at, right, has_right, width) -> None:
        rank = np.full(len(rows), -1, np.int64)
        rank[has_right] = self._rank(ids[rows[has_right], at[has_right]], ids[rows[has_right], right[has_right]])
        tree[rows, width + at] = np.where(rank >= 0, rank * width + at, _NONE)

    @staticmethod
    def _lift(tree, rows, at, width) -> None:
        node = (width + at) // 2
        for _ in range(width.bit_length() - 1):
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            node //= 2

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def _loaded(path: str) -> tuple[ByteBPE, CachedEncoder]:
    bpe = ByteBPE.from_file(path)
    return bpe, CachedEncoder(bpe.encode_pieces)


def encode(docs: DataFrame, ranks_path: str, id_column: str = "doc_id", text_column: str = "text", decoded: bool = False) -> DataFrame:
    """Id, ``ids`` (array of int) and, if asked for, ``decoded`` (the ids' bytes again) of every row.

    ``ranks_path`` names a rank file that every executor has, such as that of an installed package. Special tokens
    are ordinary text. A NULL text counts as empty and has no ids; ids may be NULL or repeat. Other columns are not
    read, whatever their names.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = _loaded(ranks_path)
        for part in text_slices(batches, "text"):
            ids, offsets = encoder(strings(part.column("text")))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            columns, names = [part.column("id"), lists], [id_column, "ids"]
            if decoded:
                plain = [bpe.decode(ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:])]
                columns, names = [*columns, pa.array(plain, pa.binary())], [*names, "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.selectExpr(f"`{id_column}` as id", f"`{text_column}` as text")
    return rows.mapInArrow(work, f"`{id_column}` {kind}, ids array<int>" + ", decoded binary" * decoded)


def decode(rows: DataFrame, ranks_path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """Id and ``decoded``: the bytes of an array of token ids. NULL ids give NULL; an unknown id is an error."""
    kind = rows.schema[id_column].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = _loaded(ranks_path)
        for batch in batches:
            plain = [None if x is None else bpe.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(plain, pa.binary())], names=[id_column, "decoded"])

    given = rows.selectExpr(f"`{id_column}` as id", f"`{ids_column}` as ids")
    return given.mapInArrow(work, f"`{id_column}` {kind}, decoded binary")
