"""SHA-1 keys and change hashes of the vault and the warehouse.

The hashed text is ``value:value:...:`` - the values joined by a colon plus one closing colon.
Three text rules exist and differ only in how a column becomes text:

* vault keys (`hash_key`): trimmed, NULL becomes the empty string;
* raw keys (`hash_raw`): untouched, NULLs are left out of the list;
* satellite change hash (`hash_diff`): as vault keys, but numbers lose insignificant zeros.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that never take part in a change hash, matched as parts of the column name.
SATELLITE_DIFF_EXCLUDES = (
    "HSH_",
    "ETL_INSERT_DATETIME",
    "LOAD_DATE_TIME",
    "RECORD_SOURCE",
    "EXTRACT_DATE_PARTITION",
)
WAREHOUSE_DIFF_EXCLUDES = (
    "HSH_",
    "RUN_DTM",
    "RECORD_INSERT_DTM",
    "RECORD_UPDATE_DTM",
    "TIMELINE_FROM_",
)


def quoted(name: str) -> Column:
    """Column by exact name, so that blanks and dots in a name need no care."""
    return F.col("`" + name.replace("`", "``") + "`")


def _sha1_of(texts: Iterable[Column]) -> Column:
    return F.sha1(F.concat(F.concat_ws(":", *texts), F.lit(":")))


def key_text(column: Column) -> Column:
    return F.coalesce(F.trim(column.cast("string")), F.lit(""))


def hash_key(columns: Sequence[str]) -> Column:
    """Hub or link hash key over the named columns, in the given order."""
    return _sha1_of(key_text(quoted(c)) for c in columns)


def hash_raw(columns: Sequence[str], null: str = "skip") -> Column:
    """Hash over untrimmed values.

    ``null='skip'`` is the compatible rule: ``(NULL, 'a')`` and ``('a', NULL)`` give the same hash.
    ``null='empty'`` keeps the position of a NULL and so tells the two apart.
    """
    texts = [quoted(c).cast("string") for c in columns]
    if null == "empty":
        texts = [F.coalesce(t, F.lit("")) for t in texts]
    elif null != "skip":
        raise ValueError(f"null must be 'skip' or 'empty', not {null!r}")
    return _sha1_of(texts)


def _cut(text: Column) -> Column:
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))


def shortest_text(column: Column) -> Column:
    """Text of a double with the fewest digits from which the same double is read, the nearest of them, as Java lays it out.

    That is ``12.5`` from 1e-3 up to 1e7 and ``1.25E-7`` elsewhere. Before Java 19 a cast gives at times more digits than it takes,
    and rounded ones. The JSON library that Spark itself brings along has the exact way (Schubfach), on any Java. Spark
    takes the call for not deterministic, though it is: name the text in a select first to join or group by it. Where
    one digit would do (up to 1e-322) it is of two, as 9.9E-324.
    """
    writer = F.lit("com.fasterxml.jackson.core.io.NumberOutput"), F.lit("toString")
    text = F.reflect(*writer, F.coalesce(column, F.lit(0.0)), F.lit(True))  # a NULL cannot be passed
    return F.when(column.isNotNull(), text)


def double_text(column: Column) -> Column:
    """Shortest round-trip text of a double, positional between 1e-4 and 1e16, else ``1.5e+16`` style."""
    size, text = F.abs(column), shortest_text(column)
    one_digit = F.format_string("%.0e", column)

    def scientific(power: str, python_power: str) -> Column:
        return F.replace(F.replace(text, F.lit(".0E"), F.lit("E")), F.lit(power), F.lit(python_power))

    # The text is made where it is used, and each branch uses it once.
    return (
        F.when(F.isnan(column), F.lit("nan"))
        .when(size == float("inf"), F.when(column > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(size == 0, text)
        .when((size >= 1e-3) & (size < 1e7), _cut(text))
        .when((size >= 1e-4) & (size < 1e16), _cut(text.try_cast("decimal(38,21)").cast("string")))
        .when(size >= 1e16, scientific("E", "e+"))
        .when(size >= 1e-9, scientific("E-", "e-0"))
        .when((size <= 1e-322) & (one_digit.try_cast("double") == column), one_digit)
        .otherwise(scientific("E-", "e-"))
    )


def number_text(column: Column, source_type: T.DataType | None = None) -> Column:
    """Text of a number without insignificant zeros; NULL becomes the text ``None``.

    Trailing zeros are cut only from texts with a decimal point: ``100.00`` and ``100`` give ``100``.
    """
    if isinstance(source_type, T.DoubleType):
        text, size = double_text(column), F.abs(column)
        # Positional texts are cut already; asking them for a point would make them twice.
        return F.coalesce(F.when((size >= 1e-4) & (size < 1e16), text).when(text.contains("."), _cut(text)).otherwise(text), F.lit("None"))
    if isinstance(source_type, T.DecimalType) and source_type.scale > 6:
        # Below 1e-6 a decimal prints as 1.2E-7; a cast does so only without ANSI mode.
        text = F.when(column.isNotNull(), F.format_string("%s", column))
    else:
        text = column.cast("string")
    return F.coalesce(F.when(text.contains("."), _cut(text)).otherwise(text), F.lit("None"))


def is_number_target(target_type: T.DataType | str) -> bool:
    name = target_type if isinstance(target_type, str) else target_type.simpleString()
    return "decimal" in name or "double" in name


def instant_text(column: Column) -> Column:
    """Text of an instant in UTC, whatever the session's zone."""
    seconds = (F.unix_micros(column).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return (F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)).cast("string")


def change_text(column: Column, source_type: T.DataType | None) -> Column:
    return F.coalesce(instant_text(column), F.lit("")) if isinstance(source_type, T.TimestampType) else key_text(column)


def hash_diff(
    columns: Sequence[str],
    target_types: Mapping[str, T.DataType | str],
    source_types: Mapping[str, T.DataType] | None = None,
) -> Column:
    """Satellite change hash; the *target* type of a column decides whether it is a number.

    With ``source_types`` a column of instants (``timestamp``) is hashed as its text in UTC, so that another session zone
    does not make every version look changed. Hash keys are text as it is; name instants there in a fixed form.
    """
    source_types = source_types or {}
    return _sha1_of(
        number_text(quoted(c), source_types.get(c)) if is_number_target(target_types[c]) else change_text(quoted(c), source_types.get(c))
        for c in columns
    )


def _without(names: Iterable[str], excludes: Sequence[str]) -> list[str]:
    return [n for n in names if not any(part in n for part in excludes)]


def satellite_diff_columns(target_columns: Iterable[str]) -> list[str]:
    """Attributes of a satellite that enter its change hash, in target order; the extract time does."""
    return _without(target_columns, SATELLITE_DIFF_EXCLUDES)


def warehouse_diff_columns(columns: Iterable[str]) -> list[str]:
    return _without(columns, WAREHOUSE_DIFF_EXCLUDES)


def key_list(business_keys: str | Sequence[str] | None) -> list[str]:
    """``'a, b'`` or a list to a list of names."""
    if business_keys is None:
        return []
    if isinstance(business_keys, str):
        business_keys = business_keys.split(",")
    return [k.strip() for k in business_keys if k.strip()]


def with_warehouse_hashes(df, business_keys: str | Sequence[str] | None, null: str = "skip"):
    """Add ``HSH_KEY`` over the business keys (empty text without keys) and ``HSH_DIFF`` over the rest."""
    keys = key_list(business_keys)
    return df.withColumns(
        {
            "HSH_KEY": hash_raw(keys, null) if keys else F.lit(""),
            "HSH_DIFF": hash_raw(warehouse_diff_columns(df.columns), null),
        }
    )
