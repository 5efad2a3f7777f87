"""Landed CSV files to staging parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystrata.functions.times import archive_folder
from keystrata.operators.columns import Moment
from keystrata.sources.files import FILE_PATH, ledger, measured_lines, numbered_records, parse_numbered, write_parquet


def staged_lines(spark: SparkSession, paths: str | Sequence[str], width: int | None = None, multi_line: bool = False) -> DataFrame:
    """Text columns ``Prop_0..n`` where the last is the line number, and the file of each row.

    There are as many fields as the widest line has, or ``width`` if that is more. With ``multi_line`` quoted fields may
    hold line breaks, and the number is that of the record's first line.
    """
    if multi_line:
        records, most = numbered_records(spark, paths)
        return parse_numbered(records, max(width or 1, most))
    numbered, splits = measured_lines(spark, paths)
    return parse_numbered(numbered, max(width or 1, splits.agg(F.max("width")).first()[0] or 1))


def with_file_day(df: DataFrame, name: str = "file_day") -> DataFrame:
    """``yyyy/MM/dd`` of the Julian date in the file name."""
    return df.withColumn(name, archive_folder(F.element_at(F.split(FILE_PATH, "/"), -1)))


def land(
    spark: SparkSession, paths: str | Sequence[str], staging: str, load_ts: Moment, by_file_day: bool = False, multi_line: bool = False
) -> DataFrame:
    """Write landed files to a staging folder and return the rows per file, counted from what was written."""
    df = staged_lines(spark, paths, multi_line=multi_line)
    if by_file_day:
        write_parquet(with_file_day(df), staging, ["file_day"])
    else:
        write_parquet(df, staging)
    return ledger(spark.read.parquet(staging), load_ts)
