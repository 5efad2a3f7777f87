"""Row counts that come from the write itself.

An append is observed: Spark counts the rows of each source while it writes them. The counts are kept in a small table beside
the target, ``<table>_COUNTS``, whose sums are the counts of the target; the target is not scanned to be counted.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from keystrata.functions.hashing import quoted
from keystrata.operators.columns import select_target
from keystrata.operators.counts import COUNT_LOG
from keystrata.session import written
from keystrata.sources.tables import Lake

_LEDGER = "source string, row_count bigint, load_id string, finished boolean"


def _ledger(table: str) -> str:
    return f"{table}_COUNTS"


def _recount(lake: Lake, table: str, by: str, area: str) -> None:
    """Count the table itself: once when counting begins, and after an append that broke off."""
    found = lake.read(table, area).groupBy(quoted(by).cast("string").alias("source")).agg(F.count(F.lit(1)).alias("row_count"))
    lake.swap(_ledger(table), found.withColumns({"load_id": F.lit("recount"), "finished": F.lit(True)}), area)


def _ready(lake: Lake, table: str, by: str, area: str) -> None:
    if not lake.exists(_ledger(table), area):
        lake.create(_ledger(table), _LEDGER, area=area)
        _recount(lake, table, by, area)
        return
    loads = lake.read(_ledger(table), area).groupBy("load_id").agg(F.bool_or("finished").alias("done"))
    if not loads.filter("not done").isEmpty():
        _recount(lake, table, by, area)


def append_counted(lake: Lake, table: str, rows: DataFrame, sources: Sequence[str] = (), area: str = "rawvault", by: str = "RECORD_SOURCE") -> int:
    """Append rows and note how many came from each source; returns how many there were.

    ``sources`` are the values of ``by`` that the batch may have, few enough to be a column of the observation each. Should
    rows of another source or of none turn up, the batch, written beforehand, is counted by groups instead; so it
    is when no sources are given.
    """
    _ready(lake, table, by, area)
    load = uuid.uuid4().hex
    note = lambda df, done: lake.append(_ledger(table), df.withColumns({"load_id": F.lit(load), "finished": F.lit(done)}), area)
    begun = lake.spark.createDataFrame([(None, 0)], "source string, row_count bigint")
    note(begun.coalesce(1), False)
    rows = select_target(rows, lake.columns(table, area))
    if not sources:
        rows = written(rows, "counted-batch")
    observation = Observation()
    metrics = [F.count_if(quoted(by) == s).alias(f"s{i}") for i, s in enumerate(sources)]
    lake.append(table, rows, area, lambda df: df.observe(observation, F.count(F.lit(1)).alias("all"), *metrics))
    seen = observation.get
    counts = [(s, seen[f"s{i}"]) for i, s in enumerate(sources) if seen[f"s{i}"]]
    if sum(n for _, n in counts) == seen["all"]:
        found = lake.spark.createDataFrame(counts or [(None, 0)], "source string, row_count bigint")
    else:
        found = rows.groupBy(quoted(by).cast("string").alias("source")).agg(F.count(F.lit(1)).alias("row_count"))
    note(found.coalesce(1), True)
    return seen["all"]


def counts_by_source(lake: Lake, table: str, area: str = "rawvault", by: str = "RECORD_SOURCE") -> DataFrame:
    """``(source, row_count)`` of a table from the noted counts."""
    _ready(lake, table, by, area)
    noted = lake.read(_ledger(table), area).groupBy("source").agg(F.sum("row_count").alias("row_count"))
    return noted.filter("row_count > 0")


def logged_counts(lake: Lake, table: str, area: str = "rawvault") -> DataFrame:
    """Rows per source as a count log, without a scan of the table."""
    return counts_by_source(lake, table, area).select(F.col("source").alias("FileName"), F.col("row_count").cast("string").alias("Count")).to(COUNT_LOG)
