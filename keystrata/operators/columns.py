"""Naming, metadata columns, key mapping and row filters of staged data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystrata.functions.hashing import quoted
from keystrata.functions.times import business_date, file_time, moment

# Replication columns that are not loaded.
TECHNICAL_COLUMNS = ("DM_TXID", "DM_USER", "_adfFilePath")
SOURCE_FILE = "_srcFileName"

Moment = str | dt.datetime | Column


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Real names for ``Prop_0..n``; spare names are ignored, missing names are an error."""
    if len(names) < len(df.columns):
        raise ValueError(f"{len(df.columns)} columns but only {len(names)} names")
    return df.toDF(*names[: len(df.columns)])


def drop_technical(df: DataFrame) -> DataFrame:
    return df.drop(*TECHNICAL_COLUMNS)


def fill_missing(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Add columns the source lacks, as the number 0."""
    names = columns.split(",") if isinstance(columns, str) else columns
    return df.withColumns({name.strip(): F.lit(0) for name in names if name.strip()})


def with_client_id(df: DataFrame, settings: Mapping[str, Any]) -> DataFrame:
    """Add ``CLIENT_ID = 100`` when the feed loads equipment."""
    return df.withColumn("CLIENT_ID", F.lit(100)) if "HUB_EQUIPMENT" in settings.values() else df


def delta_metadata(df: DataFrame, record_source: str, load_ts: Moment) -> DataFrame:
    """Replicated source: the extract time is the replication time."""
    return df.withColumns(
        {
            "RECORD_SOURCE": F.lit(record_source),
            "LOAD_DATE_TIME": moment(load_ts),
            "EXTRACT_DATE_TIME": quoted("DM_TIMESTAMP"),
        }
    )


def file_metadata(df: DataFrame, record_source: str, load_ts: Moment, digits: str = "tempdate") -> DataFrame:
    """File source: the extract time comes from the digits of the file name, every row is an insert."""
    return df.withColumns(
        {
            "EXTRACT_DATE_TIME": file_time(quoted(digits)),
            "RECORD_SOURCE": F.lit(record_source),
            "LOAD_DATE_TIME": moment(load_ts),
            "CHANGE_TYPE": F.lit("I"),
        }
    )


def history_metadata(df: DataFrame, load_ts: Moment, extract: Column) -> DataFrame:
    """History load: the record source is the file, every row is an insert."""
    return df.withColumns(
        {
            "RECORD_SOURCE": quoted(SOURCE_FILE),
            "LOAD_DATE_TIME": moment(load_ts),
            "CHANGE_TYPE": F.lit("I"),
            "EXTRACT_DATE_TIME": extract,
        }
    )


def replicated_history_metadata(df: DataFrame, load_ts: Moment, date_column: str | None) -> DataFrame:
    return history_metadata(df, load_ts, business_date(df, date_column))


def reference_metadata(df: DataFrame, record_source: str, load_ts: Moment, extract_ts: Moment) -> DataFrame:
    return df.withColumns(
        {
            "RECORD_SOURCE": F.lit(record_source),
            "LOAD_DATE_TIME": moment(load_ts),
            "EXTRACT_DATE_TIME": moment(extract_ts),
        }
    )


def source_from_file(df: DataFrame) -> DataFrame:
    return df.withColumn("RECORD_SOURCE", quoted(SOURCE_FILE))


def map_keys(df: DataFrame, mapping: Mapping[str, str], record_source: str) -> DataFrame:
    """Copy source columns to the key columns of a hub."""
    if not mapping:
        return df
    return df.withColumns(
        {**{key: quoted(source) for source, key in mapping.items()}, "RECORD_SOURCE": F.lit(record_source)}
    )


def map_same_as_keys(df: DataFrame, mapping: Mapping[str, str], record_source: str) -> DataFrame:
    """Several source columns may feed one key column: one row per spelling of the key.

    The record source names the column a row came from. Spellings unfold in place, so the input is read once.
    """
    spellings: list[tuple[dict[str, str], str]] = [({}, "")]
    seen: set[str] = set()
    for source, key in mapping.items():
        named = [({**keys, key: source}, source) for keys, _ in spellings]
        spellings = spellings + named if key in seen else named
        seen.add(key)
    if not seen:
        return df
    choices = [
        F.struct(*(quoted(keys[k]).alias(k) for k in sorted(seen)), F.lit(f"{record_source}.{source}").alias("__label"))
        for keys, source in spellings
    ]
    unfolded = df.withColumn("__spelling", F.explode(F.array(*choices)))
    return unfolded.withColumns(
        {**{k: F.col("__spelling")[k] for k in seen}, "RECORD_SOURCE": F.col("__spelling.__label")}
    ).drop("__spelling")


def drop_before_images(df: DataFrame) -> DataFrame:
    """Rows without a change mark are dropped too."""
    return df.filter(quoted("CHANGE_TYPE") != "B")


def drop_deleted(df: DataFrame, column: str = "CHANGE_TYPE", mark: str = "D") -> DataFrame:
    return df.filter(quoted(column) != mark)


def subset_for(df: DataFrame, split: Mapping[str, Mapping[str, Any]], table: str) -> DataFrame:
    """Rows of one target when several targets share a source; only the first split column counts."""
    column, values = next(iter(split.items()))
    return df.filter(quoted(column) == values[table]) if table in values else df


def require(df: DataFrame, columns: Sequence[str], sentinel: str | None = None) -> DataFrame:
    """Rows in which all columns are filled and none holds the sentinel."""
    df = df.dropna(subset=list(columns))
    for column in columns if sentinel is not None else ():
        df = df.filter(quoted(column) != sentinel)
    return df


def select_target(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Target columns in target order; others are ignored, missing ones fail the analysis."""
    return df.select(*map(quoted, columns))
