"""Best-fit packing of token sequences with a fixed number of open bins.

Every task packs the documents of its own input split, so nothing is shuffled. Pieces are placed as their texts are
read: those of one slice of texts from the longest to the shortest, each into the open bin whose free space fits it
most closely. The free spaces of the open bins are the bits of one integer, so the best fit is its lowest bit at or
above the length. When all bins are open and none fits, the fullest closes. Task and counter name a sequence;
a task that runs again reads the same split in the same order and gives the same numbers.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from keystrata.llm.batches import strings, text_slices
from keystrata.llm.pretokens import CachedEncoder

OPEN_BINS = 1024


class BestFit:
    """Bounded-space online best fit of lengths 1 .. ``capacity``."""

    def __init__(self, capacity: int, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by free space
        self.free = 0  # bit f is set when some open bin has f left
        self.count = self.opened = 0

    def _take(self, space: int) -> int:
        found = self.bins[space].pop()
        if not self.bins[space]:
            self.free ^= 1 << space
        self.count -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset for the next length."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            if self.count >= self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)
            number, space = self.opened, self.capacity
            self.opened += 1
        if space > length:
            rest = space - length
            self.bins[rest].append(number)
            self.free |= 1 << rest
            self.count += 1
        return number, self.capacity - space


@lru_cache(maxsize=2)
def _encoder(path: str) -> CachedEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as lines:
        added = json.load(lines).get("added_tokens") or []
    return CachedEncoder(
        lambda pieces: [e.ids for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)], added={t["content"]: t["id"] for t in added}
    )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 1024,
    end_id: int = 2,
    open_bins: int = OPEN_BINS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``tokens``, ``sequence_id``, ``offset``.

    A document is its token ids, as the library gives them without added special tokens, and then ``end_id``; a special
    token that stands in the text counts as the library takes it by default. A NULL text counts as empty and gives ``end_id`` alone. Only
    documents longer than ``capacity`` are cut: their first piece has the remainder, the others are full. ``tokens``
    are the ids of the piece as little-endian unsigned 32-bit numbers. Places in a sequence are gapless from 0 and
    no sequence is longer than ``capacity``. Ids may be NULL or repeat: each row is a document of its own. Other
    columns are not read, whatever their names. An empty table gives an empty result.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, fit = _encoder(tokenizer_path), BestFit(capacity, open_bins)
        base = TaskContext.get().partitionId() << 40
        for part in text_slices(batches, "text"):
            ids, offsets = encoder(strings(part.column("text")))
            tokens = np.insert(ids.astype("<u4"), offsets[1:], end_id)
            offsets = offsets + np.arange(len(offsets))
            sizes = np.diff(offsets)
            pieces = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            head = (sizes - 1) % capacity + 1
            start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
            length = np.where(piece == 0, head[row], capacity)
            sequence, offset = np.empty(len(row), np.int64), np.empty(len(row), np.int64)
            for i in np.argsort(-length, kind="stable").tolist():
                sequence[i], offset[i] = fit.place(int(length[i]))
            # A document's pieces lie one after the other in its tokens, so their cuts lie one after the other too.
            cuts = np.append(offsets[row] + start, len(tokens)) * 4
            blobs = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(tokens)])
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), blobs.cast(pa.binary()), pa.array(base + sequence), pa.array(offset)],
                names=[id_column, "piece", "start", "length", "tokens", "sequence_id", "offset"],
            )

    rows = docs.selectExpr(f"`{id_column}` as id", f"`{text_column}` as text")
    return rows.mapInArrow(work, f"`{id_column}` {kind}, piece int, start long, length long, tokens binary, sequence_id long, offset long")
