"""Dimensions of type 2: every version of a key with the time it holds.

A version holds from its start up to the next one's, the newest without end. A batch may bring several versions of a key,
and late ones that split the time of a stored version. A version that says the same as the one before it
is not stored. Open rows are one partition; what a load closes is a partition of its own, which later loads leave
alone unless a late version falls into it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystrata.functions.hashing import quoted
from keystrata.functions.times import moment
from keystrata.operators.columns import Moment
from keystrata.operators.latest import one_per_key
from keystrata.operators.sequence import in_order, with_neighbour, without_order
from keystrata.plans.contracts import Contract, conform, with_surrogate_keys
from keystrata.session import written
from keystrata.sources.partitions import finish_switch, in_listed, replace_partitions, touched_partitions
from keystrata.sources.tables import Lake

# The validity columns that all dimensions share, and how an open version is marked.
KEY, DIFF = "HSH_KEY", "HSH_DIFF"
START, END, CURRENT = "ROW_EFFECTIVE_DTM", "ROW_EXPIRATION_DTM", "CURRENT_RECORD_FLAG"
INSERTED, UPDATED = "RECORD_INSERT_DTM", "RECORD_UPDATE_DTM"
NO_END = dt.datetime(9999, 12, 31)

#: Not declared by a contract: the load that closed a row, as the second partition column.
CLOSED_BY, STILL_OPEN = "CLOSED_BY", "open"
_PARTITIONS = [CURRENT, CLOSED_BY]


@dataclass(frozen=True)
class Applied:
    """Rows that a load added, and stored rows whose end or contents it changed."""

    added: int = 0
    changed: int = 0


def create_dimension(lake: Lake, contract: Contract, area: str = "dimlayer") -> None:
    """Drop the dimension if it exists and create it, partitioned by open and closed rows and the closing load."""
    lake.create(contract.table, contract.schema.add(CLOSED_BY, "string"), _PARTITIONS, area)


def dimension_rows(lake: Lake, contract: Contract, area: str = "dimlayer") -> DataFrame:
    """Rows of the dimension in the declared columns and order."""
    return lake.read(contract.table, area).select(*(quoted(f.name) for f in contract.fields))


def _at(load_ts: Moment):
    return moment(load_ts).cast("timestamp_ntz")


def batch_versions(batch: DataFrame, contract: Contract, load_ts: Moment) -> DataFrame:
    """A batch in the declared types, one row per key and start; without a start a version holds from the load on."""
    rows = conform(batch, contract).withColumn(START, F.coalesce(quoted(START), F.date_trunc("second", _at(load_ts)).cast("timestamp_ntz")))
    rows = written(one_per_key(rows, [KEY, START]), "dimension-batch")
    if not rows.filter(quoted(KEY).isNull() | quoted(DIFF).isNull()).isEmpty():
        raise ValueError(f"{contract.table}: a version without {KEY} or {DIFF}")
    return rows


def stored_versions(table: DataFrame, versions: DataFrame) -> DataFrame:
    """Stored rows of the batch's keys that the batch can change.

    Closed rows are read only for keys that have a version from before their open row.
    """
    # A dimension's rows have many columns, most of them NULL: of a few columns Spark would guess far too small a size
    # and broadcast millions of keys. Written alone, their size is known.
    is_open = quoted(CURRENT) == "Y"
    keys = written(versions.select(KEY).distinct(), "dimension-keys")
    open_rows = table.filter(is_open).join(keys, KEY, "left_semi")
    since = written(open_rows.select(KEY, quoted(START).alias("__since")), "dimension-since")
    starts = written(versions.select(KEY, START), "dimension-starts")
    late = written(starts.join(since, KEY).filter(quoted(START) < F.col("__since")).select(KEY).distinct(), "dimension-late")
    if late.isEmpty():
        return open_rows
    return open_rows.unionByName(table.filter(~is_open).join(late, KEY, "left_semi"))


def chained(stored: DataFrame, versions: DataFrame) -> DataFrame:
    """``(HSH_KEY, ROW_EFFECTIVE_DTM, is_stored, corrected, CLOSED_BY, old_end, new_end)`` of stored and new versions of the batch's keys.

    A batch version at the start of a stored one corrects that row if it says something else. Of the others those stay out
    that say the same as the version before them, stored or not.
    """
    at = [KEY, START]
    given = versions.select(*at, quoted(DIFF).alias("__given")).hint("merge")
    old = stored.select(*at, DIFF, quoted(END).alias("old_end"), CLOSED_BY).join(given, at, "left")
    old = old.withColumn("corrected", F.coalesce(F.col("__given") != quoted(DIFF), F.lit(False)))
    old = old.withColumn(DIFF, F.coalesce("__given", quoted(DIFF))).drop("__given").withColumn("is_stored", F.lit(True))
    new = versions.select(*at, DIFF).join(stored.select(*at).hint("merge"), at, "left_anti").withColumns({"is_stored": F.lit(False), "corrected": F.lit(False)})
    placed = in_order(old.unionByName(new, allowMissingColumns=True), at, "dimension-chain")
    before = with_neighbour(placed, "before", [KEY, DIFF])
    repeats = F.coalesce((F.col("before")[KEY] == quoted(KEY)) & (F.col("before")[DIFF] == quoted(DIFF)), F.lit(False))
    kept = with_neighbour(before.filter(F.col("is_stored") | ~repeats), "after", at, after=True)
    end = F.when(F.col("after")[KEY] == quoted(KEY), F.col("after")[START]).otherwise(F.lit(NO_END).cast("timestamp_ntz"))
    return without_order(kept).select(*at, "is_stored", "corrected", CLOSED_BY, "old_end", end.alias("new_end"))


def scd2_apply(lake: Lake, contract: Contract, batch: DataFrame, load_ts: Moment, area: str = "dimlayer") -> Applied:
    """Merge a batch of versions into a dimension made by `create_dimension`.

    ``batch`` has the contract's columns, as far as it knows them, with ``HSH_KEY``, ``HSH_DIFF`` and the start. New rows are numbered on
    from the largest surrogate key by key and start; stored rows keep theirs, and their start. A load that is repeated changes
    nothing. One that broke off is completed before the next. Joins between the batch, the stored rows of its keys and what
    changes of them are never broadcast: all are as large as the batch, and wide rows are far larger in memory than in files.
    """
    finish_switch(lake, contract.table, area)
    table = lake.read(contract.table, area)
    versions = batch_versions(batch, contract, load_ts)
    stored = written(stored_versions(table, versions), "dimension-stored")
    at, stamp = [KEY, START], _at(load_ts)
    chain = written(chained(stored, versions).filter("not is_stored or corrected or old_end <> new_end"), "dimension-changes")
    counts = chain.groupBy("is_stored").count().collect()
    applied = Applied(**{"changed" if r.is_stored else "added": r["count"] for r in counts})
    if applied == Applied():
        return applied

    ends = F.col("new_end") == F.lit(NO_END).cast("timestamp_ntz")
    closing = F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")
    validity = {
        END: F.col("new_end"),
        CURRENT: F.when(ends, "Y").otherwise("N"),
        CLOSED_BY: F.when(ends, STILL_OPEN).when(F.coalesce(CLOSED_BY, F.lit(STILL_OPEN)) == STILL_OPEN, closing).otherwise(quoted(CLOSED_BY)),
        UPDATED: stamp,
    }
    own = {contract.identity, *at, END, CURRENT, INSERTED, UPDATED, CLOSED_BY}
    contents = [f.name for f in contract.fields if f.name not in own]

    added = versions.drop(contract.identity or "").join(chain.filter("not is_stored").select(*at, "new_end", CLOSED_BY).hint("merge"), at)
    if contract.identity:
        last = table.agg(F.coalesce(F.max(quoted(contract.identity)), F.lit(0))).first()[0]
        place = F.concat_ws(" ", KEY, F.date_format(START, "yyyy-MM-dd HH:mm:ss"))
        added = with_surrogate_keys(added.withColumn("__place", place), contract.identity, last, "__place").drop("__place")
    added = added.withColumns(validity | {INSERTED: stamp})

    new_contents = versions.select(*at, F.struct(*map(quoted, contents)).alias("__contents")).hint("merge")
    changed = stored.drop(CLOSED_BY).join(chain.filter("is_stored").select(*at, "corrected", "new_end", CLOSED_BY).hint("merge"), at).join(new_contents, at, "left")
    changed = changed.withColumns({c: F.when(F.col("corrected"), F.col("__contents")[c]).otherwise(quoted(c)) for c in contents} | validity)
    columns = table.columns
    fresh = written(added.select(*columns).unionByName(changed.select(*columns)), "dimension-rows")

    # Partitions that rows leave or enter are replaced; closed ones only if a late version fell into them.
    left = chain.filter("is_stored").select(F.when(quoted(CLOSED_BY) == STILL_OPEN, "Y").otherwise("N").alias(CURRENT), CLOSED_BY)
    touched = touched_partitions(left.union(fresh.select(*_PARTITIONS)), _PARTITIONS)
    replaced = written(chain.filter("is_stored").select(*at), "dimension-replaced")
    kept = table.filter(in_listed(table.schema, touched)).join(replaced, at, "left_anti")
    replace_partitions(lake, contract.table, kept.select(*columns).unionByName(fresh), touched, area)
    return applied


def as_of(rows: DataFrame, time: Moment) -> DataFrame:
    """The version of each key that holds at a time."""
    return rows.filter((quoted(START) <= _at(time)) & (_at(time) < quoted(END)))
