"""Embedding whitening with a bit-sliced scatter matrix.

Vectors are turned into whole numbers, and each different vector is fitted once. A task takes its vectors in blocks. In a
block every dimension is shifted to start at 0 and cut into bit planes, which are packed across the rows into words of 64
bits. The product of two dimensions, summed over the rows, is the sum of popcounts of ANDed planes, each weighted
by the power of two that its planes stand for: exact, without a multiplication per row. Blocks and tasks add up whole
numbers; the sums are centred as whole numbers, too, and only then become doubles for the eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystrata.llm.batches import utf8
from keystrata.session import written

BLOCK_ROWS = 1 << 14
_LARGEST = 2.0**62  # of a scaled entry
_LIMB, _LIMBS = 40, 5  # sums travel as 5 numbers of 40 bits, so that any number of them adds up in 64 bits


def whole_vectors(column: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows whose vectors take part, the length of each, and the entries floor(scale * c) of them all in a row."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_list(pa.float64()))
    rows = np.flatnonzero(np.asarray(column.is_valid()))
    sizes = np.diff(np.asarray(column.offsets))[rows].astype(np.int64)
    entries = column.flatten().to_numpy(zero_copy_only=False)  # NULL rows have no entries; NULL entries become NaN
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(scale * entries)
        good = np.abs(scaled) < _LARGEST
    bad = np.bincount(np.repeat(np.arange(len(rows)), sizes), weights=~good, minlength=len(rows))
    keep = (bad == 0) & (sizes > 0)
    return rows[keep], sizes[keep], scaled[np.repeat(keep, sizes)].astype(np.int64)


def _packed(x: np.ndarray) -> list[bytes]:
    """Each row as bytes: how wide its numbers are, and the numbers. Equal rows give equal bytes."""
    wide = np.full(len(x), 8)
    low, high = x.min(axis=1), x.max(axis=1)
    for width in (4, 2, 1):
        wide[(low >= -(1 << 8 * width - 1)) & (high < 1 << 8 * width - 1)] = width
    out = [b""] * len(x)
    for width in (1, 2, 4, 8):
        for i, row in zip(np.flatnonzero(wide == width).tolist(), x[wide == width].astype(f"<i{width}")):
            out[i] = bytes([width]) + row.tobytes()
    return out


def _unpacked(column: pa.Array, d: int) -> np.ndarray:
    raw, offsets = utf8(column)
    sizes, out = np.diff(offsets), np.empty((len(column), d), np.int64)
    for width in (1, 2, 4, 8):
        rows = np.flatnonzero(sizes == 1 + width * d)
        out[rows] = raw[offsets[rows][:, None] + np.arange(1, 1 + width * d)].view(f"<i{width}")
    return out


def bit_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of non-negative columns: words of 64 rows for each plane, its dimension and its bit. Empty planes are left out."""
    rows, d = y.shape
    padded = np.zeros((-(-rows // 64) * 64, d), np.int64)
    padded[:rows] = y
    bits = [int(m).bit_length() for m in padded.max(axis=0)]
    dimension = np.repeat(np.arange(d), bits)
    bit = np.concatenate([np.arange(b) for b in bits]) if sum(bits) else np.zeros(0, np.int64)
    planes = np.empty((len(bit), len(padded) // 64), np.uint64)
    for p, (j, b) in enumerate(zip(dimension, bit)):
        planes[p] = np.packbits((padded[:, j] >> b & 1).astype(np.uint8), bitorder="little").view(np.uint64)
    return planes, dimension, bit


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of each column of whole numbers and of the products of every two columns, as Python integers."""
    rows, d = x.shape
    low = x.min(axis=0)
    planes, dimension, bit = bit_planes(x - low)
    counts = np.zeros((len(bit), len(bit)), np.int64)
    for p in range(len(bit)):
        counts[p, p:] = np.bitwise_count(planes[p:] & planes[p]).sum(axis=1, dtype=np.int64)
    ones = counts.diagonal().copy()
    counts = counts + np.triu(counts, 1).T
    exact = 2 * int(bit.max(initial=0)) + 2 * d.bit_length() + rows.bit_length() < 62
    kind = np.int64 if exact else object  # of sums within the block
    weight = np.array([1 << int(b) for b in bit], kind)
    first = np.searchsorted(dimension, np.arange(d + 1))
    total, product = np.zeros(d, kind), np.zeros((d, d), kind)
    by_plane = np.zeros((len(bit), d), kind)
    for j in np.unique(dimension).tolist():  # columns that are not constant
        mine = slice(first[j], first[j + 1])
        total[j] = (ones[mine].astype(kind) * weight[mine]).sum()
        by_plane[:, j] = counts[:, mine].astype(kind) @ weight[mine]
    for i in np.unique(dimension).tolist():
        mine = slice(first[i], first[i + 1])
        product[i] = weight[mine] @ by_plane[mine]
    total, product = total.astype(object), product.astype(object)
    shift = low.astype(object)
    # Undo the shift: sum (y + s)(z + t) = sum yz + s sum z + t sum y + n s t.
    product = product + np.outer(shift, total) + np.outer(total, shift) + rows * np.outer(shift, shift)
    return total + rows * shift, product


def _limbs(value: int) -> list[int]:
    mask = (1 << _LIMB) - 1
    return [value >> _LIMB * k & mask for k in range(_LIMBS - 1)] + [value >> _LIMB * (_LIMBS - 1)]


def _scatter(d: int, block_rows: int):
    """Partial sums of a task: a row per pair of dimensions; dimension -1 stands for the constant 1."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, product = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in _blocks(batches, block_rows):
            x = _unpacked(batch, d)
            s, p = cross_products(x)
            n, total, product = n + len(x), total + s, product + p
        if not n:
            return
        a, b = np.triu_indices(d)
        values = [n, *total, *product[a, b]]
        limbs = np.array([_limbs(int(v)) for v in values], np.int64).T
        first = np.concatenate([[-1], np.full(d, -1), a])
        second = np.concatenate([[-1], np.arange(d), b])
        yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(second), *map(pa.array, limbs)], names=["a", "b", *(f"l{k}" for k in range(_LIMBS))])

    return work


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Array]:
    """The vectors of a task in blocks of so many rows."""
    held, n = [], 0
    for batch in batches:
        column = batch.column("x")
        while n + len(column) >= rows:
            yield pa.concat_arrays([*held, column.slice(0, rows - n)])
            column, held, n = column.slice(rows - n), [], 0
        if len(column):
            held.append(column)
            n += len(column)
    if held:
        yield pa.concat_arrays(held)


@dataclass(frozen=True)
class Whitening:
    """``n`` vectors with ``sums`` per dimension; the first components, their eigenvalues and their share of the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray  # a column each
    explained: np.ndarray

    @classmethod
    def of_sums(cls, n: int, sums: list[int], products: dict[tuple[int, int], int], most: int) -> Whitening:
        """From exact sums; the covariance is centred and divided as whole numbers."""
        d = len(sums)
        v = np.empty((d, d))
        for (a, b), p in products.items():
            v[a, b] = v[b, a] = (n * p - sums[a] * sums[b]) / (n * n)
        values, vectors = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")[:most]
        trace = sum(n * products[a, a] - sums[a] ** 2 for a in range(d)) / (n * n)
        values = values[order]
        # What is left of a direction without variance is rounding.
        values = np.where(values > max(float(values.max(initial=0)), 0.0) * d * np.finfo(float).eps, values, 0.0)
        explained = values / trace if trace > 0 else np.zeros(len(order))
        return cls(n, list(sums), values, vectors[:, order], explained)

    @property
    def deviates(self) -> np.ndarray:
        """Which components have any variance."""
        return self.values > 0

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows, NaN in a component without variance."""
        mean = np.array([s / self.n for s in self.sums])
        with np.errstate(divide="ignore", invalid="ignore"):
            out = (x - mean) @ self.components / np.sqrt(self.values)
        out[:, ~self.deviates] = np.nan
        return out

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S) ** 2; None where 64 bits do not hold it."""
        reach = max((self.n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, self.sums))) if x.size else 0, 1)
        if reach * reach * x.shape[1] < 1 << 63:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((self.n * x.astype(object) - np.array(self.sums, object)) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in exact]


def fit(vectors: DataFrame, d: int, most: int, block_rows: int = BLOCK_ROWS) -> Whitening | None:
    """Fitted on packed different vectors ``x`` of length ``d``. The driver gets a row per pair of dimensions, whatever the input."""
    partial = vectors.select("x").mapInArrow(_scatter(d, block_rows), "a long, b long, " + ", ".join(f"l{k} long" for k in range(_LIMBS)))
    sums = partial.groupBy("a", "b").agg(*(F.sum(f"l{k}").alias(f"l{k}") for k in range(_LIMBS))).toArrow().to_pylist()
    if not sums:
        return None
    found = {(r["a"], r["b"]): sum(r[f"l{k}"] << _LIMB * k for k in range(_LIMBS)) for r in sums}
    n = found.pop((-1, -1))
    totals = [found.pop((-1, j)) for j in range(d)]
    return Whitening.of_sums(n, totals, found, most)


def whiten(
    vectors: DataFrame, most: int = 4, scale: float = 256.0, id_column: str = "vec_id", vector_column: str = "embedding", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Id, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error`` for each row and component up to ``most``.

    Entries c become x = floor(scale * c). The fit takes each different x vector once: ``n`` vectors with sums S.
    ``deviation`` is the exact sum over dimensions of (n x - S)^2, NULL where 64 bits do not hold it; ``whitened`` is x - S/n projected
    on the component and divided by the root of its eigenvalue; ``explained`` the eigenvalue's share of the trace. ``identity_error`` is
    measured on the whitened fit vectors: the largest entry of their covariance minus the identity.

    Vectors that are NULL or empty, hold a NULL or an entry that is not finite, or reach 2^62 once scaled take no part. Only
    vectors of one length can be whitened together: the length that most rows have, ties to the longer; rows of other
    lengths take no part. A component without variance has NULL in ``whitened`` and 0 in ``explained`` and does not count in
    ``identity_error``, which is NULL if none has any. Vectors with fewer than ``most`` dimensions have a component for each.
    Ids may be NULL or repeat: every row is whitened. Other columns are not read, whatever their names. An empty table
    gives an empty result.
    """
    kind = vectors.schema[id_column].dataType.simpleString()
    given = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, sizes, entries = whole_vectors(batch.column("v"), scale)
            lengths, packed = [], []
            at = np.cumsum(sizes) - sizes
            for d in np.unique(sizes).tolist():
                mine = at[sizes == d]
                packed += _packed(entries[mine[:, None] + np.arange(d)])
                lengths += [d] * len(mine)
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64()), pa.array(packed, pa.binary())], names=["d", "x"])

    # Equal vectors are joined before they are moved, so one that a third of all rows hold is a row per task.
    different = written(given.select("v").mapInArrow(pack, "d long, x binary").groupBy("d", "x").agg(F.count(F.lit(1)).alias("held")), "whitening-vectors")
    lengths = different.groupBy("d").agg(F.sum("held").alias("held")).orderBy(F.col("held").desc(), F.col("d").desc()).first()
    d = lengths["d"] if lengths else 1
    fitted = different.filter(F.col("d") == d)
    model = fit(fitted, d, most, block_rows)
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], f"{schema}, identity_error double".replace("id ", f"`{id_column}` ", 1))
    error = _identity_error(fitted, d, model)
    k = len(model.values)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, entries = whole_vectors(batch.column("v"), scale)
            at = (np.cumsum(sizes) - sizes)[sizes == d]
            x = entries[at[:, None] + np.arange(d)]
            m = len(x)
            whitened = model.project(x).ravel()
            columns = [
                batch.column("id").take(pa.array(np.repeat(rows[sizes == d], k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n)),
                pa.array(model.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(whitened, mask=np.isnan(whitened)),
                pa.array(np.tile(model.explained, m)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "component", "n", "deviation", "whitened", "explained"])

    found = given.mapInArrow(work, schema).withColumn("identity_error", F.lit(error).cast("double"))
    return found.withColumnRenamed("id", id_column)


def _identity_error(fitted: DataFrame, d: int, model: Whitening) -> float | None:
    """Largest entry of the covariance of the whitened fit vectors minus the identity, measured on these vectors."""
    used = np.flatnonzero(model.deviates).tolist()
    if not used:
        return None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whitened = model.project(_unpacked(batch.column("x"), d))
            yield pa.RecordBatch.from_arrays([pa.array(whitened[:, j]) for j in used], names=[f"w{j}" for j in used])

    rows = fitted.select("x").mapInArrow(work, ", ".join(f"w{j} double" for j in used))
    pairs = [(i, j) for i in used for j in used if i <= j]
    found = rows.agg(*(F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
