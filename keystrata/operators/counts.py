"""Row counts and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystrata.functions.hashing import quoted

# Layout of a count log.
COUNT_LOG = T.StructType([T.StructField("FileName", T.StringType()), T.StructField("Count", T.StringType())])


def count_by(df: DataFrame, column: str = "RECORD_SOURCE") -> DataFrame:
    """Rows per value as a count log."""
    return df.groupBy(quoted(column).alias("FileName")).agg(F.count(F.lit(1)).cast("string").alias("Count"))


def count_as(df: DataFrame, name: str) -> DataFrame:
    """Row count of one table as a count log."""
    return df.agg(F.count(F.lit(1)).cast("string").alias("Count")).select(F.lit(name).alias("FileName"), "Count")


def extend_log(new: DataFrame, earlier: DataFrame) -> DataFrame:
    """Positional union, so the logs may name their columns differently."""
    return new.toDF(*COUNT_LOG.names).union(earlier)


def reconcile(daily: DataFrame, history: DataFrame, merged: DataFrame) -> DataFrame:
    """One row ``(daily_count, history_count, total_count, ok)``; each input is counted once."""
    marked = [d.select(F.lit(n).alias("part")) for n, d in (("d", daily), ("h", history), ("m", merged))]
    all_rows = marked[0].union(marked[1]).union(marked[2])
    counts = [F.count_if(F.col("part") == p).alias(n) for p, n in zip("dhm", ("daily_count", "history_count", "total_count"))]
    return all_rows.agg(*counts).withColumn("ok", F.expr("total_count = daily_count + history_count"))


def row_text(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A text that two rows share only if all their values are equal; NULL differs from every value."""

    def text(field: T.StructField) -> Column:
        value = quoted(field.name)
        if isinstance(field.dataType, T.BinaryType):
            value = F.hex(value)
        elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
            value = F.when(value.isNotNull(), F.to_json(F.struct(value)))
        value = value.cast("string")
        return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("~"))

    return F.concat(*(text(f) for f in df.schema.fields if columns is None or f.name in columns))


def fingerprint_metrics(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Count, sums and exclusive ors of 128-bit row hashes: aggregates that no order of the rows changes.

    One row lost and another doubled leave the count as it is, but not the sums.
    """
    h = F.md5(row_text(df, columns))
    halves = {"high": F.substring(h, 1, 16), "low": F.substring(h, 17, 16)}
    # Sums of half a hash stay below 38 digits for 10 ** 18 rows.
    sums = [F.coalesce(F.sum(F.conv(x, 16, 10).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias(f"sum_{n}") for n, x in halves.items()]
    xors = [F.coalesce(F.bit_xor(F.conv(x, 16, -10).cast("bigint")), F.lit(0)).alias(f"xor_{n}") for n, x in halves.items()]
    return [F.count(F.lit(1)).alias("row_count"), *sums, *xors]


@dataclass(frozen=True)
class Fingerprint:
    """What a multiset of rows leaves of itself; those of two parts add up to that of the whole."""

    row_count: int = 0
    sum_high: int = 0
    sum_low: int = 0
    xor_high: int = 0
    xor_low: int = 0

    @classmethod
    def of(cls, df: DataFrame, columns: Sequence[str] | None = None) -> Fingerprint:
        return cls(*map(int, df.agg(*fingerprint_metrics(df, columns)).first()))

    def __add__(self, other: Fingerprint) -> Fingerprint:
        sums = (getattr(self, n) + getattr(other, n) for n in ("row_count", "sum_high", "sum_low"))
        return Fingerprint(*sums, self.xor_high ^ other.xor_high, self.xor_low ^ other.xor_low)


def reconcile_contents(daily: DataFrame, history: DataFrame, merged: DataFrame) -> DataFrame:
    """One row per part (``daily``, ``history``, ``total``) with its fingerprint as text, and ``ok``: the first two make up the third.

    Columns are those of ``merged``, by name and in its types.
    """
    kinds = {f.name: f.dataType for f in merged.schema.fields}
    typed = lambda df: df.select(*(quoted(c).cast(t).alias(c) for c, t in kinds.items()))
    parts = {"daily": typed(daily), "history": typed(history), "total": merged}
    found = [df.agg(*fingerprint_metrics(df)).withColumn("part", F.lit(n)) for n, df in parts.items()]
    rows = found[0].unionByName(found[1]).unionByName(found[2])
    total = F.col("part") == "total"
    names = ("row_count", "sum_high", "sum_low")
    added = [F.sum(F.when(~total, F.col(n))) == F.sum(F.when(total, F.col(n))) for n in names]
    added += [F.bit_xor(f"xor_{n}") == 0 for n in ("high", "low")]  # equal parts cancel out
    ok = rows.agg(*(a.alias(f"a{i}") for i, a in enumerate(added))).select(F.expr(" and ".join(f"a{i}" for i in range(len(added)))).alias("ok"))
    xor = F.concat(*(F.lpad(F.lower(F.hex(f"xor_{n}")), 16, "0") for n in ("high", "low")))
    texts = rows.select("part", "row_count", F.col("sum_high").cast("string").alias("sum_high"), F.col("sum_low").cast("string").alias("sum_low"), xor.alias("xor"))
    return texts.join(F.broadcast(ok))  # one row
