"""JDBC source and sink."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Batching of the warehouse writer.
BATCH_SIZE = 400_000
WRITE_PARTITIONS = 100


@dataclass(frozen=True)
class ReadSplit:
    """Range of a numeric, date or timestamp column that is read in parallel slices."""

    column: str
    lower: str | int
    upper: str | int
    partitions: int


def read_options(url: str, table: str, driver: str | None = None, split: ReadSplit | None = None) -> dict[str, str]:
    options = {"url": url, "dbtable": table}
    if driver:
        options["driver"] = driver
    if split:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession, url: str, table: str, driver: str | None = None, split: ReadSplit | None = None, view: str | None = None
) -> DataFrame:
    """Table of a database. Without ``split`` one task reads it all, so give one for anything large."""
    df = spark.read.format("jdbc").options(**read_options(url, table, driver, split)).load()
    if view:
        df.createOrReplaceTempView(view)
    return df


def write_options(url: str, table: str, driver: str | None = None, **extra: str) -> dict[str, str]:
    """``truncate`` keeps the definition of the target table on overwrite. ``extra`` holds driver options."""
    options = {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "batchsize": str(BATCH_SIZE),
        "numPartitions": str(WRITE_PARTITIONS),
    }
    if driver:
        options["driver"] = driver
    return options | extra


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", driver: str | None = None, **extra: str) -> None:
    df.write.format("jdbc").mode(mode).options(**write_options(url, table, driver, **extra)).save()
