"""Column transforms chosen by feed configuration.

`apply_staging` runs before hubs and links are loaded, `apply_satellite` after them and before satellites, so
that keys are hashed from clear values and satellites store masked ones.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystrata.functions.hashing import quoted
from keystrata.functions.text import unescape
from keystrata.functions.times import NTZ, extract_day, extract_hour_start

# Text columns of these names keep their escapes.
UNESCAPE_EXCLUDES = ("CHANGETYPE", "MANDT", "CLIENT")


def raw_type(df: DataFrame, column: str) -> DataFrame:
    """Base64 text to upper-case hexadecimal text."""
    return df.withColumn(column, F.hex(F.unbase64(quoted(column))))


def trim_leading_zero(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.ltrim(F.trim(quoted(column)), F.lit("0")), F.lit("")))


def trim_decimal(df: DataFrame, column: str) -> DataFrame:
    """Cut from the first dot to the end of the line."""
    return df.withColumn(column, F.regexp_replace(quoted(column).cast("string"), r"\..*$", ""))


def prefix(df: DataFrame, column: str, spec: Mapping[str, Any]) -> DataFrame:
    """Split a leading part off into the target column and keep the rest."""
    source = quoted(column)
    rest = F.substr(source, F.lit(spec["prefix_init"]), F.length(source) - F.lit(spec["pos"]))
    return df.withColumns({spec["targetcolumn"]: source.substr(spec["init"], spec["length"]), column: rest})


def checksum(df: DataFrame, column: str, spec: Mapping[str, Any]) -> DataFrame:
    """Move the check digits into the target column; ``init`` is their width and the start of the rest."""
    source = quoted(column)
    return df.withColumns(
        {
            spec["targetcolumn"]: source.substr(spec["checksuminit"], spec["init"]),
            column: source.substr(spec["init"], spec["length"]),
        }
    )


def substring(df: DataFrame, column: str, spec: Mapping[str, Any]) -> DataFrame:
    return df.withColumn(spec["targetcolumn"], quoted(column).substr(spec["init"], spec["length"]))


def regexp(df: DataFrame, column: str, spec: Mapping[str, Any]) -> DataFrame:
    """One group of the first match; no match gives the empty text."""
    return df.withColumn(
        spec["targetcolumn"], F.regexp_extract(quoted(column), spec["pattern"], int(spec["matchGroup"]))
    )


def regexp_extract_all(df: DataFrame, column: str, spec: Mapping[str, Any]) -> DataFrame:
    """All matches as an array, or joined to one text with ``joinAll = Y``.

    Feeds write this pattern, unlike that of `regexp`, as a SQL text, where two backslashes stand for one.
    """
    pattern = spec["pattern"].replace("\\\\", "\\")
    found = F.regexp_extract_all(quoted(column), F.lit(pattern), F.lit(int(spec["matchGroup"])))
    return df.withColumn(spec["targetcolumn"], F.array_join(found, "") if spec.get("joinAll") == "Y" else found)


def parse_file_date(df: DataFrame, column: str, spec: Mapping[str, Any]) -> DataFrame:
    """Digits of a file name, by first match or (``matchAll = Y``) by all matches."""
    return (regexp_extract_all if spec.get("matchAll") == "Y" else regexp)(df, column, spec)


def mask(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Replace personal data by constants."""
    return df.withColumns({column: F.lit(value) for column, value in values.items()})


def hourly_partition(df: DataFrame, column: str = "EXTRACT_DATE_TIME") -> DataFrame:
    start = extract_hour_start(quoted(column), df.schema[column].dataType)
    return df.withColumns({"Extract_hour": F.hour(start), "EXTRACT_DATE_PARTITION": start})


def partition_column(df: DataFrame, target: str, column: str = "EXTRACT_DATE_TIME") -> DataFrame:
    """Day of the extract time as a timestamp, plus the same day as a date helper column."""
    day = extract_day(quoted(column), df.schema[column].dataType)
    return df.withColumns({"temp_extract_date_partition": day.cast("date"), target: day})


def default_partition(df: DataFrame, target: str) -> DataFrame:
    return df.withColumn(target, F.lit(None).cast(NTZ))


def clean_strings(df: DataFrame) -> DataFrame:
    """Remove the backslash before escaped characters in all text columns, in one projection."""

    def cleaned(field: T.StructField) -> Column:
        keep = not isinstance(field.dataType, T.StringType) or field.name in UNESCAPE_EXCLUDES
        return quoted(field.name) if keep else unescape(quoted(field.name)).alias(field.name)

    return df.select(*map(cleaned, df.schema.fields))


_PLAIN: dict[str, Callable[[DataFrame, str], DataFrame]] = {
    "TRANSFORM_RAWTYPE": raw_type,
    "TRANSFORM_TRIM_LEADING_ZERO": trim_leading_zero,
    "TRANSFORM_TRIM_DECIMAL": trim_decimal,
    "TRANSFORM_PARTITION_COL": partition_column,
    "TRANSFORM_DEFAULT_PARTITION": default_partition,
}
_WITH_SPEC: dict[str, Callable[[DataFrame, str, Mapping[str, Any]], DataFrame]] = {
    "TRANSFORM_PREFIX": prefix,
    "TRANSFORM_CHECKSUM": checksum,
    "TRANSFORM_SUBSTRING": substring,
    "TRANSFORM_REGEXP": regexp,
    "TRANSFORM_REGEXP_EXTRACT_ALL": regexp_extract_all,
    "TRANSFORM_PARSE_FILEDATE": parse_file_date,
}
# Order of the transforms on staged rows.
STAGING_ORDER = (
    "TRANSFORM_RAWTYPE",
    "TRANSFORM_PREFIX",
    "TRANSFORM_TRIM_LEADING_ZERO",
    "TRANSFORM_CHECKSUM",
    "TRANSFORM_SUBSTRING",
    "TRANSFORM_REGEXP",
    "TRANSFORM_TRIM_DECIMAL",
    "TRANSFORM_REGEXP_EXTRACT_ALL",
)
SATELLITE_ORDER = (
    "TRANSFORM_PII",
    "TRANSFORM_HOURLY_PARTITION",
    "TRANSFORM_DEFAULT_PARTITION",
    "TRANSFORM_PARTITION_COL",
)
NAMES = frozenset(_PLAIN) | frozenset(_WITH_SPEC) | frozenset(SATELLITE_ORDER)

Settings = Sequence[str] | Mapping[str, Any]


def transform(df: DataFrame, name: str, settings: Settings) -> DataFrame:
    """Apply one transform to all columns its settings name; an unknown name is an error."""
    if name == "TRANSFORM_PII":
        return mask(df, settings)
    if name == "TRANSFORM_HOURLY_PARTITION":
        return hourly_partition(df)
    if name in _PLAIN:
        for column in settings:
            df = _PLAIN[name](df, column)
        return df
    if name in _WITH_SPEC:
        for column, spec in settings.items():
            df = _WITH_SPEC[name](df, column, spec)
        return df
    raise ValueError(f"unknown transform {name}")


def _check(transforms: Mapping[str, Settings]) -> None:
    unknown = sorted(set(transforms) - NAMES)
    if unknown:
        raise ValueError(f"unknown transforms: {', '.join(unknown)}")


def apply_staging(df: DataFrame, transforms: Mapping[str, Settings]) -> DataFrame:
    _check(transforms)
    df = clean_strings(df)
    for name in STAGING_ORDER:
        if name in transforms:
            df = transform(df, name, transforms[name])
    return df


def apply_satellite(df: DataFrame, transforms: Mapping[str, Settings]) -> DataFrame:
    _check(transforms)
    for name in SATELLITE_ORDER:
        if name == "TRANSFORM_PARTITION_COL" and "TRANSFORM_DEFAULT_PARTITION" in transforms:
            continue
        if name in transforms:
            df = transform(df, name, transforms[name])
    return df
