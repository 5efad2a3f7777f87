import math
from fractions import Fraction

import numpy as np
import pytest

from keystrata.llm.whitening import Whitening, _unpacked, _packed, bit_planes, cross_products, whiten, whole_vectors
import pyarrow as pa

SCHEMA = "vec_id long, embedding array<double>, n string, x int"


def brute(rows, most=4):
    """By the definition, in exact fractions up to the eigenvectors."""
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    centred = [[Fraction(x[j]) - Fraction(s[j], n) for j in range(d)] for x in fit]
    v = np.array([[float(sum(c[a] * c[b] for c in centred) / n) for b in range(d)] for a in range(d)])
    values, vectors = np.linalg.eigh(v)
    by = np.argsort(-values)[:most]
    out = {}
    for i, x in kept:
        deviation = sum((n * x[j] - s[j]) ** 2 for j in range(d))
        for c, k in enumerate(by, start=1):
            w = float(np.array([float(Fraction(x[j]) - Fraction(s[j], n)) for j in range(d)]) @ vectors[:, k] / math.sqrt(values[k]))
            out.setdefault((i, c), []).append((n, deviation, abs(w), values[k] / values.sum()))
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, x, "s", 1) for i, x in rows], SCHEMA)
    return whiten(df, **options).collect()


def vectors(count, d, seed, copies=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(count, d)) * np.linspace(3, 0.5, d)
    x[: count // copies] = x[0]
    return [(i, x[i].tolist()) for i in range(count)]


BAD = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0, 4.0]), (903, [math.inf] * 5), (904, [math.nan] * 5), (905, [1.0, 2.0])]


@pytest.mark.parametrize("block_rows", [1 << 14, 17])
def test_against_the_definition(spark, block_rows):
    rows = vectors(150, 5, 1)
    rows += [(7, rows[20][1]), (None, rows[30][1])]
    found = run(spark, rows + BAD, block_rows=block_rows)
    expected = brute(rows)
    assert len(found) == 4 * len(rows)
    got = {}
    for r in found:
        got.setdefault((r.vec_id, r.component), []).append((r.n, r.deviation, abs(r.whitened), r.explained))
        assert r.identity_error < 1e-9
    assert got.keys() == expected.keys()
    for key, rows_ in got.items():
        for a, b in zip(sorted(rows_), sorted(expected[key])):
            assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], abs=1e-9)
    signs = {}
    by_vector = {(r.vec_id, r.component): r.whitened for r in found if r.vec_id in (0, 1, 2)}
    assert by_vector[0, 1] == by_vector[1, 1] == by_vector[2, 1]


def test_cross_products_are_exact():
    rng = np.random.default_rng(3)
    for x in (rng.integers(-300, 300, (1000, 7)), rng.integers(-(2**61), 2**61, (70, 3)), np.full((5, 2), -4), np.array([[2**61, -(2**61)], [0, 5]])):
        total, product = cross_products(x)
        exact = x.astype(object)
        assert total.tolist() == exact.sum(axis=0).tolist()
        assert product.tolist() == (exact.T @ exact).tolist()


def test_planes_hold_the_numbers():
    y = np.random.default_rng(4).integers(0, 1000, (130, 3))
    y[:, 1] = 0
    planes, dimension, bit = bit_planes(y)
    assert set(dimension.tolist()) == {0, 2} and planes.shape[1] == 3
    bits = np.unpackbits(planes.view(np.uint8), axis=1, bitorder="little")[:, :130].astype(np.int64)
    for j in (0, 2):
        assert ((bits[dimension == j] << bit[dimension == j][:, None]).sum(axis=0) == y[:, j]).all()


def test_packing_round_trip_and_negative_zero():
    x = np.array([[1, -2], [300, 4], [70_000, -1], [2**40, 0], [-128, 127], [-129, 0]])
    assert _unpacked(pa.array(_packed(x), pa.binary()), 2).tolist() == x.tolist()
    _, _, entries = whole_vectors(pa.array([[-0.0, 0.0], [1e300, 0.0], [0.001, -0.001]]), 256.0)
    assert entries.tolist() == [0, 0, 0, -1]


def test_empty_single_and_flat_tables(spark):
    assert run(spark, []) == [] and run(spark, BAD[:5]) == []
    one = run(spark, [(1, [1.0, 2.0])])
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(one)] == [
        (1, 1, 1, 0, None, 0.0, None), (1, 2, 1, 0, None, 0.0, None)
    ]
    flat = run(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(5)])
    assert {r.component: (r.whitened is None, round(r.explained, 9)) for r in flat} == {1: (False, 1.0), 2: (True, 0.0), 3: (True, 0.0)}
    assert all(r.identity_error < 1e-9 for r in flat)


def test_large_numbers():
    model = Whitening.of_sums(2, [2**61, 0], {(0, 0): 2**121, (0, 1): 0, (1, 1): 2}, 2)
    assert model.deviation(np.array([[2**60, 0], [2**61, 1]])) == [0, None]
    assert model.deviation(np.array([[2**60 + 3, 1]])) == [36 + 4]
