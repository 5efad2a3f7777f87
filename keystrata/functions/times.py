"""Time parsing, business dates, local time and integer date keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystrata.functions.hashing import quoted

# The accepted text forms of a business date, first match wins.
BUSINESS_DATE_FORMATS = ("yyyyMMdd", "yyyyMMddHHmmss", "yyyyMMddHHmmss.SSSSSSS")
# The accepted text forms of an extract time when its day is taken.
EXTRACT_TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd")
FILE_TIME_FORMAT = "yyyyMMddHHmmss"
JULIAN_DAY_FORMAT = "yyyyDDD"
REPORT_ZONE = "Australia/Melbourne"
WAREHOUSE_ZONE = "Australia/Sydney"

NTZ = "timestamp_ntz"


def moment(value: str | dt.datetime | Column) -> Column:
    """A wall-clock timestamp literal that does not depend on the session time zone."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(NTZ)


def parse_moment(column: Column, *formats: str) -> Column:
    """First format that fits, as ``timestamp_ntz``; NULL when none does (also under ANSI)."""
    # A seventh fraction digit is below Spark's microseconds: it is matched, then dropped.
    return F.coalesce(*(F.try_to_timestamp(_fit(column, f), F.lit(_six_digits(f))).cast(NTZ) for f in formats))


def _six_digits(fmt: str) -> str:
    return fmt.replace("SSSSSSS", "SSSSSS")


def _fit(column: Column, fmt: str) -> Column:
    if "SSSSSSS" not in fmt:
        return column
    return F.regexp_extract(column, r"^(\d{14}\.\d{6})\d$", 1)


def business_date(df: DataFrame, column: str | None, fallback: str = "DM_TIMESTAMP") -> Column:
    """Extract time of a history row.

    Text columns are parsed by the accepted forms and fall back to the replication time; timestamp columns
    are taken as they are; without a column the replication time is used.
    """
    if column is None:
        return quoted(fallback)
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        back = quoted(fallback)
        if isinstance(df.schema[fallback].dataType, T.StringType):
            back = back.try_cast(NTZ)
        return F.coalesce(parse_moment(quoted(column), *BUSINESS_DATE_FORMATS), back.cast(NTZ))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return quoted(column)
    raise TypeError(f"business date column {column} must be text or a timestamp, not {kind.simpleString()}")


def file_time(digits: Column) -> Column:
    """``20200101101112`` to a timestamp."""
    return parse_moment(digits, FILE_TIME_FORMAT)


def julian_file_date(file_name: Column) -> Column:
    """Date in the second dot-part of ``NAME.D2021137.T025235883``."""
    part = F.try_element_at(F.split(file_name, r"\."), F.lit(2))
    return F.try_to_timestamp(F.replace(part, F.lit("D"), F.lit("")), F.lit(JULIAN_DAY_FORMAT)).cast("date")


def archive_folder(file_name: Column) -> Column:
    """``yyyy/MM/dd`` folder of a landed file."""
    return F.date_format(julian_file_date(file_name), "yyyy/MM/dd")


def extract_day(column: Column, kind: T.DataType) -> Column:
    """Start of the day of an extract time held as text, date or timestamp."""
    if isinstance(kind, T.StringType):
        return F.date_trunc("day", parse_moment(column, *EXTRACT_TIME_FORMATS)).cast(NTZ)
    return F.date_trunc("day", column).cast(NTZ)


def extract_hour_start(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        column = parse_moment(column, *EXTRACT_TIME_FORMATS)
    return F.date_trunc("hour", column).cast(NTZ)


def local_time(column: Column, zone: str = REPORT_ZONE, kind: T.DataType | None = None) -> Column:
    """UTC to the wall-clock time of a zone; needs no session time zone for ``timestamp_ntz`` input."""
    if isinstance(kind, T.TimestampType):
        return F.from_utc_timestamp(column, zone)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), column.cast(NTZ))


def local_time_compat(column: Column, zone: str = WAREHOUSE_ZONE) -> Column:
    """UTC to local time with the offset looked up at the UTC value read as local time.

    This is what the warehouse function does; it is an hour off for some hours after each clock change.
    `local_time` is the exact conversion.
    """
    column = column.cast(NTZ)
    return column + (column - F.convert_timezone(F.lit(zone), F.lit("UTC"), column))


def date_key(column: Column) -> Column:
    """Integer ``yyyymmdd``."""
    return (F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)).cast("int")
