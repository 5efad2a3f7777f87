"""Neighbours in one order of all rows, without a task that holds a whole key.

A window by key gives a key with a third of all rows to one task. Here rows are dealt to tasks by ranges of the
order, so such a key is cut between tasks, and what stands at the edge of a range is looked up in a table with
one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keystrata.functions.hashing import quoted
from keystrata.session import written

_ID, _PART = "__seq_id", "__seq_part"


def in_order(df: DataFrame, order: Sequence[str | Column], name: str = "sequence") -> DataFrame:
    """The rows, written once in this order, for `with_neighbour`. NULL comes first."""
    columns = [quoted(c) if isinstance(c, str) else c for c in order]
    placed = df.repartitionByRange(*columns).sortWithinPartitions(*columns).withColumn(_ID, F.monotonically_increasing_id())
    return written(placed, name).withColumn(_PART, F.shiftright(_ID, 33))


def with_neighbour(placed: DataFrame, name: str, columns: Sequence[str], after: bool = False) -> DataFrame:
    """Add a struct of the columns of the row before, or ``after``, each row; NULL where there is none.

    Rows may have been filtered since `in_order`: the neighbour is the nearest row that is left.
    """
    value = F.struct(*map(quoted, columns))
    within, across = Window.partitionBy(_PART).orderBy(_ID), Window.orderBy(_PART)
    look = F.lead if after else F.lag
    edge = F.min_by(value, _ID) if after else F.max_by(value, _ID)
    edges = placed.groupBy(_PART).agg(edge.alias("__edge")).select(_PART, look("__edge").over(across).alias("__beyond"))
    rows = placed.withColumn(name, look(value).over(within)).join(F.broadcast(edges), _PART, "left")  # a row per task
    return rows.withColumn(name, F.coalesce(quoted(name), "__beyond")).drop("__beyond")


def without_order(placed: DataFrame) -> DataFrame:
    return placed.drop(_ID, _PART)
