import math

import numpy as np
import pytest

from keystrata.llm.topk import BallTree, search, top_k

SCHEMA = "vec_id long, embedding array<double>, score string, rank int"


def brute(rows, query, k):
    usable = [(i, [math.floor(256 * c) for c in x]) for i, x in rows if i is not None and x and all(c is not None and math.isfinite(c) for c in x)]
    out = []
    for i, x in dict((i, x) for i, x in usable if query(i)).items():
        scores = sorted((-sum(a * b for a, b in zip(x, y)), j) for j, y in usable if j != i and len(x) == len(y))[:k]
        out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scores)]
    return sorted(out)


def run(spark, rows, query, k, **options):
    df = spark.createDataFrame([(i, x, "s", 1) for i, x in rows], SCHEMA)
    return sorted(tuple(r) for r in top_k(df, df.filter(query), k, **options).select("query_id", "rank", "vec_id", "score").collect())


def vectors(n, d, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).round(1)
    x[: n // 3] = x[0]  # a third are copies: ties
    return [(i, x[i].tolist()) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"shard_rows": 40, "group_queries": 10}])
def test_against_brute_force(spark, options):
    rows = vectors(300, 6, 1) + [(1000, None), (1010, []), (1020, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (1030, [math.inf] * 6), (1040, [math.nan] * 6), (None, [1.0] * 6), (1050, [1.0, 2.0]), (1060, [3.0, -1.0])]
    assert run(spark, rows, "vec_id % 10 = 0", 5, **options) == brute(rows, lambda i: i % 10 == 0, 5)


def test_fewer_than_k_and_empty(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    assert run(spark, rows, "vec_id = 0", 5) == brute(rows, lambda i: i == 0, 5)
    assert run(spark, rows[:1], "vec_id = 0", 5) == []
    assert run(spark, [], "vec_id = 0", 5) == []
    assert run(spark, rows, "vec_id = 9", 5) == []


def test_bounds_hold_and_large_numbers_are_exact():
    rng = np.random.default_rng(2)
    rows, queries = np.floor(rng.normal(size=(500, 8)) * 100), np.floor(rng.normal(size=(20, 8)) * 100)
    tree = BallTree(rows, 16)
    upper = tree.bounds(queries)
    for i, (a, b, _) in enumerate(tree.nodes):
        assert ((queries @ rows[tree.order[a:b]].T).max(axis=1) <= upper[:, i]).all()
    big = np.array([[2.0**31, 1], [2.0**31, 0], [1, 2.0**31]])
    q, r, s = search(big[:1], np.array([0]), np.array([np.iinfo(np.int64).min + 1]), big, np.arange(3), 2)
    assert list(zip(r, s)) == [(1, 2**62), (2, 2**32)]
