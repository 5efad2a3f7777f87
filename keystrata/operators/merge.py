"""Merges as joins: what a transactional table does in place, these return as rows to append or a new state.

Targets are plain parquet tables. An insert-only merge returns the rows to append. An upsert returns the whole
new state, which `keystrata.sources.tables.swap` puts in place.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystrata.functions.hashing import quoted
from keystrata.operators.latest import latest_by, one_per_key, top_row
from keystrata.session import written


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks, one per key.

    The source is cut to one row per key before it meets the target; both steps share the key partitioning.
    Only the key columns of the target are read.
    """
    return one_per_key(source, keys).join(target.select(*map(quoted, keys)), list(keys), "left_anti")


def current_hashes(target: DataFrame, key: str, diff: str, order_by: str = "EXTRACT_DATE_TIME", of: DataFrame | None = None) -> DataFrame:
    """Key and change hash of the current version of every key, or of the keys that ``of`` holds.

    With a batch as ``of`` the target is cut to the batch's keys before anything is ranked: a small batch is
    broadcast, and the history of other keys is neither shuffled nor sorted.
    """
    narrow = target.select(quoted(key), quoted(diff), quoted(order_by))
    if of is not None:
        narrow = narrow.join(of.select(quoted(key)).distinct(), key, "left_semi")
    return latest_by(narrow, [key], order_by).select(quoted(key), quoted(diff))


def new_versions(source: DataFrame, known: DataFrame, key: str, diff: str) -> DataFrame:
    """Source rows, one per (key, change hash), that ``known`` does not hold.

    With `current_hashes` as ``known`` a value that returns (A, B, A) is loaded again; with all versions of
    the touched partitions (`in_partitions`) it is not.
    """
    return one_per_key(source, [key, diff]).join(known.select(quoted(key), quoted(diff)), [key, diff], "left_anti")


def partition_values(source: DataFrame, column: str, kind: T.DataType, text_format: str | None = None) -> DataFrame:
    """Distinct values of a batch for a target column of the given type, without NULL.

    Text is parsed by ``text_format`` when there is one; what does not parse matches nothing.
    """
    value = quoted(column)
    if text_format and isinstance(source.schema[column].dataType, T.StringType) and not isinstance(kind, T.StringType):
        value = F.try_to_timestamp(value, F.lit(text_format))
    return source.select(value.try_cast(kind.simpleString()).alias(column)).distinct().na.drop()


def _value_range(values: DataFrame, column: str, kind: T.DataType) -> Column | None:
    """Condition that all values meet, for pruning only; None if there are none or they have no useful range."""
    if not isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType, T.IntegralType)):
        return F.lit(True)
    low, high = values.agg(F.min(quoted(column).cast("string") if isinstance(kind, T.StringType) else quoted(column)).cast("string"), F.max(quoted(column)).cast("string")).first()
    if low is None:
        return None
    low, high = F.lit(low).cast(kind), F.lit(high).cast(kind)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):  # as text, an hour of the clock change is ambiguous
        low, high = low - F.expr("interval 1 day"), high + F.expr("interval 1 day")
    return (quoted(column) >= low) & (quoted(column) <= high)


def in_partitions(target: DataFrame, source: DataFrame, columns: str | Mapping[str, str | None]) -> DataFrame:
    """Target rows in the partitions that the batch touches in any of the columns.

    ``columns`` names a column, or columns with the format of their values where the batch has them as text. Values
    are compared in the target's type by a join; the range of the batch's values is a static condition that prunes
    the scan of a table partitioned by the column. NULL never matches.
    """
    formats = {columns: None} if isinstance(columns, str) else dict(columns)
    touched, ranges = {}, []
    for column, text_format in formats.items():
        values = partition_values(source, column, target.schema[column].dataType, text_format)
        near = _value_range(values, column, target.schema[column].dataType)
        if near is not None:
            touched[column] = values
            ranges.append(near)
    if not touched:
        return target.filter(F.lit(False))
    rows = target.filter(reduce(or_, ranges))
    if len(touched) == 1:
        [(column, values)] = touched.items()
        return rows.join(values, column, "left_semi").select(*map(quoted, target.columns))
    flags = []
    for i, (column, values) in enumerate(touched.items()):  # distinct values: no row is doubled
        rows = rows.join(values.withColumn(f"__in{i}", F.lit(True)), column, "left")
        flags.append(F.col(f"__in{i}").isNotNull())
    return rows.filter(reduce(or_, flags)).select(*map(quoted, target.columns))


def _with_null_key(keys: Sequence[str]) -> Column:
    return reduce(or_, (quoted(k).isNull() for k in keys))


def matched_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys that both sides hold.

    The target is only filtered here: with a source small enough to be broadcast it is not shuffled.
    """
    names = [*map(quoted, keys)]
    return target.select(*names).join(source.select(*names), list(keys), "left_semi").distinct()


def has_duplicate_match(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a target row is matched by several source rows."""
    repeated = source.groupBy(*map(quoted, keys)).count().filter("count > 1")
    return not matched_keys(target, repeated, keys).isEmpty()


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Mapping[str, str | Column],
    insert: Mapping[str, str | Column],
    on_duplicate: str = "error",
    newest: Sequence[Column] = (),
) -> DataFrame:
    """New state of the target: matched rows updated, unmatched source rows inserted.

    ``source`` carries the key columns under the target's names. ``update`` and ``insert`` map target columns
    to source columns or expressions over the source; they may differ. Keys compare with ``=``, so a NULL key
    never matches: such source rows are inserted, such target rows are kept.

    ``on_duplicate='error'`` refuses several source rows for one target row, as a merge does;
    ``'last'`` takes the first source row per key by ``newest``.
    """
    if on_duplicate == "last":
        full = source.filter(~_with_null_key(keys))
        source = top_row(full, keys, list(newest)).unionByName(source.filter(_with_null_key(keys)))
    elif on_duplicate != "error":
        raise ValueError(f"on_duplicate must be 'error' or 'last', not {on_duplicate!r}")

    columns = target.columns
    types = {f.name: f.dataType for f in target.schema.fields}

    def value(expression: str | Column) -> Column:
        return quoted(expression) if isinstance(expression, str) else expression

    batch = source.select(
        *map(quoted, keys),
        F.struct(*(value(e).cast(types[c]).alias(c) for c, e in update.items())).alias("__update"),
        F.struct(
            *((value(insert[c]) if c in insert else F.lit(None)).cast(types[c]).alias(c) for c in columns)
        ).alias("__insert"),
    )
    # Several branches below read the batch.
    shaped = written(batch, "upsert")
    if on_duplicate == "error" and has_duplicate_match(target, shaped, keys):
        raise ValueError("several source rows match one target row")
    # NULL keys would all meet in one task of a join and cannot match anyway.
    known, batch = target.filter(~_with_null_key(keys)), shaped.filter(~_with_null_key(keys))
    # Not one full outer join: that could neither broadcast a small batch nor split a frequent key.
    updated = known.join(batch.select(*map(quoted, keys), "__update"), list(keys), "left")
    hit = F.col("__update").isNotNull()
    state = updated.select(
        *(
            F.when(hit, F.col("__update")[c]).otherwise(quoted(c)).alias(c) if c in update else quoted(c)
            for c in columns
        )
    )
    fresh = batch.join(matched_keys(known, batch, keys), list(keys), "left_anti")
    added = fresh.unionByName(shaped.filter(_with_null_key(keys)))
    inserted = added.select(*(F.col("__insert")[c].alias(c) for c in columns))
    return state.unionByName(target.filter(_with_null_key(keys))).unionByName(inserted)
