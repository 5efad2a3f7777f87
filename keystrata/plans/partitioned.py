"""Upserts into partitioned tables: only partitions that the batch touches are read in full and replaced."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from keystrata.functions.hashing import quoted
from keystrata.operators.merge import upsert
from keystrata.session import written
from keystrata.sources.partitions import finish_switch, in_listed, replace_partitions, touched_partitions
from keystrata.sources.tables import Lake


def _column(value: str | Column) -> Column:
    return quoted(value) if isinstance(value, str) else value


def partitions_of_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Mapping[str, str | Column], insert: Mapping[str, str | Column], columns: Sequence[str]
) -> list[Row]:
    """Partitions that an upsert changes: where matched rows are, where they go, and where new rows go.

    Of the target only keys and partition columns are read, the latter without opening a column.
    """
    kinds = {f.name: f.dataType for f in target.schema.fields}
    value = lambda given, c: (_column(given[c]) if c in given else F.lit(None)).cast(kinds[c])
    to_update = F.struct(*(value(update, c).alias(c) for c in columns)).alias("__update")
    to_insert = F.struct(*(value(insert, c).alias(c) for c in columns)).alias("__insert")
    batch = source.select(*map(quoted, keys), to_update, to_insert)
    here = target.select(*map(quoted, keys), F.struct(*map(quoted, columns)).alias("__here"))
    matched = batch.join(here, list(keys), "left")
    there = F.struct(*((F.col("__update")[c] if c in update else F.col("__here")[c]).alias(c) for c in columns))
    places = F.when(F.col("__here").isNull(), F.array("__insert")).otherwise(F.array("__here", there))
    return touched_partitions(matched.select(F.explode(places).alias("p")).select("p.*"), columns)


def upsert_partitions(
    lake: Lake,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    update: Mapping[str, str | Column],
    insert: Mapping[str, str | Column],
    area: str = "rawvault",
    on_duplicate: str = "error",
    newest: Sequence[Column] = (),
    moves: bool = True,
) -> list[Row]:
    """Upsert into a partitioned table; returns the partitions it replaced.

    Rules are those of `upsert`. A row whose partition changes leaves the old one and enters the new one, and a
    partition that loses its last row is left empty. With ``moves=False`` the caller states that a key is only ever in
    the partition that ``insert`` gives; keys of other partitions are then not looked at. A run that broke off is
    completed by the next one; repeating an upsert whose inserts have full keys changes nothing.
    """
    finish_switch(lake, table, area)
    columns, target = lake.partition_columns(table, area), lake.read(table, area)
    if not columns:
        raise ValueError(f"{table} has no partitions; use Lake.swap")
    source = written(source, "partitioned-upsert")
    if moves:
        touched = partitions_of_upsert(target, source, keys, update, insert, columns)
    else:
        kinds = {f.name: f.dataType for f in target.schema.fields}
        given = source.select(*((_column(insert[c]) if c in insert else F.lit(None)).cast(kinds[c]).alias(c) for c in columns))
        touched = touched_partitions(given, columns)
    if not touched:
        return []
    state = upsert(target.filter(in_listed(target.schema, touched)), source, keys, update, insert, on_duplicate, newest)
    return replace_partitions(lake, table, state, touched, area)
