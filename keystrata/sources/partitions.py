"""Replacing some partitions of a table, all the others untouched.

The new contents of the partitions are written to a new folder first; then each partition is pointed at its part of it.
Readers see a partition's old rows until that moment. What is to be switched is noted in a table beforehand, so a
run that breaks off between two partitions is completed before anything else is done to the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystrata.functions.hashing import quoted
from keystrata.sources.tables import Lake

_PLACE = "__place"
_NOTE = "place string, location string"


def partition_texts(columns: Sequence[str]) -> list[Column]:
    """Partition values as the catalog names them; an empty text is NULL there."""
    return [F.nullif(quoted(c).cast("string"), F.lit("")).alias(c) for c in columns]


def touched_partitions(rows: DataFrame, columns: Sequence[str]) -> list[Row]:
    """The different partitions of the rows, as texts. A list of partitions, not of rows, comes to the driver."""
    return rows.select(*partition_texts(columns)).distinct().collect()


def in_listed(schema: T.StructType, partitions: Sequence[Row]) -> Column:
    """Condition for rows of these partitions; as it is static, a scan reads no others."""
    if not partitions:
        return F.lit(False)
    names = partitions[0].__fields__

    def value(name: str, text: str) -> Column:
        return F.lit(text).cast(schema[name].dataType)

    if len(names) == 1:
        given = [value(names[0], p[0]) for p in partitions if p[0] is not None]
        tests = [quoted(names[0]).isin(*given)] if given else []
        return reduce(or_, tests + [quoted(names[0]).isNull()] * any(p[0] is None for p in partitions))
    one = lambda p: reduce(and_, (quoted(n).isNull() if p[n] is None else quoted(n) == value(n, p[n]) for n in names))
    return reduce(or_, map(one, partitions))


def _spec(columns: Sequence[str], texts: Sequence[str | None]) -> str:
    def literal(text: str | None) -> str:
        if text is None:
            return "null"
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    return "PARTITION (" + ", ".join(f"`{c}` = {literal(t)}" for c, t in zip(columns, texts)) + ")"


def _note(table: str) -> str:
    return f"{table}_switching"


def replace_partitions(lake: Lake, table: str, rows: DataFrame, touched: Sequence[Row], area: str = "rawvault") -> list[Row]:
    """Make ``rows`` the contents of the partitions they name and of the ``touched`` ones; returns all of these.

    ``rows`` may read the table itself. A touched partition without rows becomes empty. Old folders remain.
    """
    finish_switch(lake, table, area)
    columns = lake.partition_columns(table, area)
    schema, folder = lake.read(table, area).schema, lake.new_folder(table, area)
    typed = rows.select(*(quoted(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))
    place = F.sha1(F.concat_ws("/", *(F.coalesce(t, F.lit("\0")) for t in partition_texts(columns))))
    typed.withColumn(_PLACE, place).hint("rebalance", *columns).write.partitionBy(_PLACE).parquet(folder)
    fresh = lake.spark.read.schema(T.StructType([*schema.fields, T.StructField(_PLACE, T.StringType())])).parquet(folder)
    found = fresh.select(*partition_texts(columns), _PLACE).distinct().collect()
    switched = {tuple(r[c] for c in columns): f"{folder}/{_PLACE}={r[_PLACE]}" for r in found}
    for p in map(tuple, touched):
        if p not in switched:  # a folder of its own that is there, so that rows can be appended later
            switched[p] = f"{folder}/empty-{len(switched)}"
            fresh.drop(_PLACE).limit(0).write.parquet(switched[p])
    if switched:
        noted = [(_spec(columns, texts), location) for texts, location in switched.items()]
        lake.create(_note(table), _NOTE, area=area)
        lake.append(_note(table), lake.spark.createDataFrame(noted, _NOTE).coalesce(1), area)
        finish_switch(lake, table, area)
    return [Row(*columns)(*texts) for texts in switched]


def finish_switch(lake: Lake, table: str, area: str = "rawvault") -> bool:
    """Point partitions at the folders noted for them, if any are; whether there were.

    The note is written in one piece before the first partition is switched, and switching twice does no harm.
    """
    if not lake.exists(_note(table), area):
        return False
    name = lake.name(table, area)
    for place, location in lake.read(_note(table), area).collect():
        lake.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {place} LOCATION '{location}'")
        lake.spark.sql(f"ALTER TABLE {name} {place} SET LOCATION '{location}'")
    lake.spark.catalog.refreshTable(name)
    lake.drop(_note(table), area)
    return True
