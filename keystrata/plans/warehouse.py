"""Vault to warehouse staging and to an operational database."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystrata.functions.hashing import key_list, quoted, with_warehouse_hashes
from keystrata.functions.text import too_long
from keystrata.plans.template import job_params, run_sql, run_sql_file
from keystrata.sources.jdbc import ReadSplit, read_jdbc, write_jdbc
from keystrata.sources.tables import Lake

# Fixed value: longest text the warehouse staging accepts.
MAX_TEXT = 2_000


def staging_rows(df: DataFrame, business_keys: str | list[str] | None) -> DataFrame:
    """Hash key and change hash are added only when the job names business keys."""
    return with_warehouse_hashes(df, business_keys) if key_list(business_keys) else df


def long_texts(df: DataFrame, limit: int = MAX_TEXT) -> DataFrame:
    """Rows with a text above the limit, and the names of those columns."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return df.withColumn("long_columns", F.array().cast("array<string>")).limit(0)
    tests = [too_long(quoted(n), limit) for n in names]
    found = F.array_compact(F.array(*(F.when(t, F.lit(n)) for t, n in zip(tests, names))))
    return df.filter(reduce(or_, tests)).withColumn("long_columns", found)


def refuse_long_texts(df: DataFrame, limit: int = MAX_TEXT) -> DataFrame:
    """The same rows; the job that reads them fails at a text above the limit."""

    def checked(field: T.StructField):
        column = quoted(field.name)
        if not isinstance(field.dataType, T.StringType):
            return column
        message = F.lit(f"{field.name}: text of more than {limit} characters")
        return F.when(too_long(column, limit), F.raise_error(message).cast("string")).otherwise(column).alias(field.name)

    return df.select(*map(checked, df.schema.fields))


def write_staging(
    lake: Lake, table: str, df: DataFrame, business_keys: str | list[str] | None = None, buckets: int | None = None, area: str = "dimlayer"
) -> None:
    """Overwrite a staging table. With keys and ``buckets`` rows are laid out by hash key, else as they come."""
    rows = refuse_long_texts(staging_rows(df, business_keys))
    layout = (buckets, ["HSH_KEY"]) if buckets and key_list(business_keys) else None
    lake.replace(table, rows, area, layout)


def _rows_of(lake: Lake, settings: Mapping[str, Any], params: Mapping[str, Any]) -> DataFrame:
    if "Sql" in settings:
        return run_sql(lake.spark, settings["Sql"], params)
    return run_sql_file(lake.spark, settings["SqlFilePath"], params)


def to_warehouse(
    lake: Lake, settings: Mapping[str, Any], given_date: str, today: dt.date | None = None, buckets: int | None = None
) -> None:
    """Run a job's SQL template over the vault and overwrite its staging table."""
    params = job_params(settings, given_date, today or dt.date.today())
    df = _rows_of(lake, settings, params)
    write_staging(lake, settings["StagingTable"], df, settings.get("BusinessKeys"), buckets)


def to_database(lake: Lake, settings: Mapping[str, Any], given_date: str, url: str, driver: str | None = None) -> None:
    """Run a job's SQL template over the vault and write the rows to a database table."""
    params = job_params(settings, given_date, dt.date.today(), migration=False)
    write_jdbc(_rows_of(lake, settings, params), url, settings["StagingTable"], settings["WriteMode"], driver)


def from_database(
    lake: Lake, url: str, source: str, table: str, driver: str | None = None, split: ReadSplit | None = None, area: str = "transform"
) -> None:
    """Copy a database table to the lake, replacing the earlier copy."""
    lake.replace(table, read_jdbc(lake.spark, url, source, driver, split), area)
