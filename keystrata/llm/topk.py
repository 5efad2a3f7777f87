"""Exact top-k search by inner product: ball trees per shard, searched by branch and bound.

Vectors are dealt to shards of bounded size by a hash of their id, and queries to groups of bounded size. A first
wave searches every query in one shard; its k-th score goes along into the second wave, over all other shards,
where it cuts off nodes, and often whole shards, before any vector is read. Within a shard the k-th score rises from
node to node. A task holds one shard and one group of queries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keystrata.session import written

SHARD_ROWS = 8192
GROUP_QUERIES = 4096
LEAF_ROWS = 64
_EXACT = float(1 << 53)


class BallTree:
    """Balls around halves of the rows, split at the median of the widest component."""

    def __init__(self, rows: np.ndarray, leaf: int = LEAF_ROWS):
        self.order = np.arange(len(rows))
        self.rows, self.leaf = rows, leaf
        self.nodes: list[tuple[int, int, int]] = []  # first row, end, parent
        stack = [(0, len(rows), -1)]
        self.is_leaf = []
        while stack:
            a, b, parent = stack.pop()
            me = len(self.nodes)
            self.nodes.append((a, b, parent))
            self.is_leaf.append(b - a <= leaf)
            if b - a > leaf:
                part = rows[self.order[a:b]]
                axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
                middle = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(part[:, axis], middle, kind="introselect")]
                stack += [(a, a + middle, me), (a + middle, b, me)]
        self.centers = np.stack([rows[self.order[a:b]].mean(axis=0) for a, b, _ in self.nodes])
        self.radii = np.array([np.sqrt(((rows[self.order[a:b]] - c) ** 2).sum(axis=1).max()) for (a, b, _), c in zip(self.nodes, self.centers)])

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of the inner product of each query with any row of each node, rounding included."""
        norms = np.sqrt((queries**2).sum(axis=1))[:, None]
        size = np.sqrt((self.centers**2).sum(axis=1))[None] + self.radii[None]
        upper = queries @ self.centers.T + norms * self.radii[None] + norms * size * 1e-9 + 1e-9
        for i, (_, _, parent) in enumerate(self.nodes):  # parents come before their children
            if parent >= 0:
                np.minimum(upper[:, i], upper[:, parent], out=upper[:, i])
        return upper


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers that are held as doubles."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if most < _EXACT:
        return (queries @ rows.T).astype(np.int64)
    exact = [[sum(int(a) * int(b) for a, b in zip(q, r)) for r in rows] for q in queries]
    return np.array(exact, object).astype(np.int64).reshape(len(queries), len(rows))


def search(queries, query_ids, floor, rows, row_ids, k: int, leaf: int = LEAF_ROWS):
    """(query place, row place, score) of each query's k best rows that reach its ``floor``; ties to smaller ids."""
    least = np.iinfo(np.int64).min
    tree = BallTree(rows, leaf)
    leaves = np.flatnonzero(tree.is_leaf)
    upper = tree.bounds(queries)[:, leaves]
    best_first = np.argsort(-upper, axis=1, kind="stable")
    score = np.full((len(queries), k), least)
    place = np.full((len(queries), k), -1)
    own = np.append(row_ids, np.iinfo(np.int64).max)  # place -1: no row yet
    for turn in range(len(leaves)):
        node = best_first[:, turn]
        kth = np.maximum(score[:, -1], floor)
        active = np.flatnonzero(upper[np.arange(len(queries)), node] >= kth.astype(np.float64) - np.abs(kth) * 1e-12)
        if not len(active):
            break  # later nodes have smaller bounds
        for at in np.unique(node[active]):
            who = active[node[active] == at]
            a, b, _ = tree.nodes[leaves[at]]
            members = tree.order[a:b]
            new = _products(queries[who], rows[members])
            new[row_ids[members][None] == query_ids[who][:, None]] = least
            new[new < floor[who][:, None]] = least
            scores = np.concatenate([score[who], new], axis=1)
            places = np.concatenate([place[who], np.where(new > least, members[None], -1)], axis=1)
            order = np.lexsort((own[places], ~scores), axis=-1)[:, :k]  # ~ turns the order round without overflow
            score[who], place[who] = np.take_along_axis(scores, order, 1), np.take_along_axis(places, order, 1)
    query, slot = np.nonzero(place >= 0)
    return query, place[query, slot], score[query, slot]


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: float = 256.0,
    shard_rows: int = SHARD_ROWS,
    group_queries: int = GROUP_QUERIES,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), id, ``score`` of the ``k`` vectors with the largest inner product per query.

    Each component x counts as floor(scale * x). Vectors that are NULL or empty, or hold a NULL or a component that
    is not finite, and rows whose id is NULL take no part, neither as query nor as candidate. A query is compared
    with vectors of its own length only, and not with rows of its own id. Ties go to the smaller id; rows repeated under
    one id count each. Queries that repeat under one id count once. Other columns are not read, whatever their names.
    Scores must fit 64 bits.
    """
    def usable(df: DataFrame) -> DataFrame:
        x = F.col(vector_column)
        bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
        kept = df.filter(F.col(id_column).isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~F.coalesce(bad, F.lit(True)))
        return kept.select(F.col(id_column).cast("long").alias("id"), x.cast("array<double>").alias("x"), F.size(x).alias("d"))

    rows, asked = usable(vectors), usable(queries).dropDuplicates(["id"])
    shards = max(1, -(-vectors.count() // shard_rows))
    groups = max(1, -(-queries.count() // group_queries))
    spread = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(n)).cast("int")
    rows = rows.withColumn("shard", spread(shards, 1)).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = asked.withColumn("g", spread(groups, 2)).withColumn("home", spread(shards, 3))

    def work(key, mine: pa.Table, theirs: pa.Table) -> pa.Table:
        names = ["id", "score", "vec"]
        if not mine.num_rows or not theirs.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        matrix = lambda t: np.floor(scale * t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1))
        ids, row_ids = (t.column("id").to_numpy() for t in (theirs, mine))
        floor = theirs.column("floor").to_numpy()
        q, r, s = search(matrix(theirs), ids, floor, matrix(mine), row_ids, k)
        return pa.table({"id": ids[q], "score": s, "vec": row_ids[r]})

    def wave(asked: DataFrame) -> DataFrame:
        keys = ["shard", "g", "d"]
        joined = rows.select(*keys, "id", "x").groupBy(*keys).cogroup(asked.select(*keys, "id", "x", "floor").groupBy(*keys))
        return joined.applyInArrow(work, "id long, score long, vec long")

    lowest = F.lit(np.iinfo(np.int64).min + 1).cast("long")
    first = written(wave(asked.withColumn("shard", F.col("home")).withColumn("floor", lowest)), "top-k-first")
    kth = first.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
    # k-th score so far; a query that found fewer than k rows at home has none yet.
    floors = asked.join(kth, "id", "left").withColumn("floor", F.when(F.col("n") >= k, F.col("kth")).otherwise(lowest))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("home"))
    second = wave(floors.withColumn("shard", F.explode(others)))
    order = Window.partitionBy("id").orderBy(F.col("score").desc(), "vec")
    ranked = first.unionByName(second).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("id").alias("query_id"), "rank", F.col("vec").alias(id_column), "score")
