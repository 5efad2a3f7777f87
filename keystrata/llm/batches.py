"""Arrow batches of texts, cut so that the work on one slice stays small however long the texts are."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once. A longer single text makes a slice of its own.
SLICE_BYTES = 2 << 20


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, in slices of about ``most`` bytes of the column."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        part = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def strings(array: pa.Array) -> list[str]:
    """Python texts; NULL is empty."""
    return pc.fill_null(array, "").to_pylist()


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary array in a row, and the offsets of its texts; NULL is empty."""
    array = pc.fill_null(array.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]
