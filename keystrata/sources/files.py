"""File sources and sinks: parquet, CSV, numbered landing lines."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystrata.functions.times import moment
from keystrata.operators.counts import COUNT_LOG
from keystrata.session import written

FILE_PATH = "_adfFilePath"


def positional_names(count: int) -> list[str]:
    return [f"Prop_{i}" for i in range(count)]


def read_parquet(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One path or a list of files."""
    return spark.read.parquet(*([paths] if isinstance(paths, str) else paths))


def read_csv_with_header(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, named by the header; names may hold blanks."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_csv_positional(spark: SparkSession, paths: str | Sequence[str], with_path: bool = True) -> DataFrame:
    """Header-less CSV as text columns ``Prop_0..n``, with the file of each row.

    There are as many columns as the widest line of all files has fields; shorter rows are filled with NULL.
    """
    schema = ", ".join(f"`{n}` string" for n in positional_names(csv_width(spark, paths)))
    rows = spark.read.schema(schema).option("header", False).csv(paths)
    return (rows.withColumn(FILE_PATH, F.col("_metadata.file_path")) if with_path else rows)


def read_count_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COUNT_LOG).csv(path)


def append_count_log(log: DataFrame, path: str) -> None:
    """Add a batch of counts. The log is never read and overwritten in place, which would lose it."""
    log.write.mode("append").csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a folder. The folder is the unit: rows are not pulled into one file."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def numbered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of text files with their numbers; see `measured_lines`."""
    return measured_lines(spark, paths)[0]


def measured_lines(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Lines of text files as ``(value, _adfFilePath, line)`` with the 1-based line number in each file.

    Files are split as usual, also a file that holds most of the data. One pass writes every line with its split
    and its place there to the shared folder; splits may be cut differently in another pass, so the lines in
    earlier splits of a file are counted on that copy too. Their known size lets Spark broadcast these counts
    (a row per split) when they are small and join them by shuffle when they are not. Lines themselves are never
    shuffled to be counted. The second result has a row per split with the fields of its widest line as ``width``,
    from the same pass that counts lines.
    """
    lines = _lines_by_split(spark, paths)
    per_split = lines.groupBy(FILE_PATH, "__start").agg(
        F.min("__id").alias("__first"), F.count("*").alias("__lines"), F.max(field_count()).alias("width")
    )
    offsets = per_split.select(FILE_PATH, "__start", (_earlier("__lines") - F.col("__first")).alias("__shift"), "width")
    offsets = written(offsets, "line-offsets")
    numbered = lines.join(offsets, [FILE_PATH, "__start"])
    return numbered.select("value", FILE_PATH, (F.col("__id") + F.col("__shift") + 1).alias("line")), offsets


def _lines_by_split(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    lines = spark.read.text([paths] if isinstance(paths, str) else list(paths)).select(
        "value",
        F.col("_metadata.file_path").alias(FILE_PATH),
        F.col("_metadata.file_block_start").alias("__start"),
        # Within a task the id counts rows, and a split is read by one task from its start to its end.
        F.monotonically_increasing_id().alias("__id"),
    )
    return written(lines, "landed-lines")


def _earlier(column: str) -> Column:
    """Sum over the earlier splits of the file."""
    splits = Window.partitionBy(FILE_PATH).orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(splits), F.lit(0))


def opens_or_closes(line: str = "value") -> Column:
    """Whether a line has an odd number of quotes, those after a backslash not counted."""
    bare = F.regexp_replace(F.col(line), r"\\.", "")
    return (F.length(bare) - F.length(F.replace(bare, F.lit('"')))) % 2 == 1


def numbered_records(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, int]:
    """Records as ``(value, _adfFilePath, line)`` where quoted fields may hold line breaks, and the fields of the widest.

    ``line`` is the 1-based number of the line at which the record starts. Lines are read as by `measured_lines`, in
    splits of any size; a record may lie in several. Lines with an odd number of quotes open and close records
    in turn, so each one's rank in its file, from counts per split and its rank there, tells which it does. The other lines
    of such records are marked by a bit each (4 kB for 32,768 lines, only where there are any), and only marked
    lines are shuffled, to be put together. Breaks of any kind come back as a line feed.

    A quote counts wherever it stands; files with single quotes inside plain fields are to be read as lines. A
    quote that nothing closes up to the end of its file leaves its line and the later ones as they are.
    """
    lines = _lines_by_split(spark, paths)
    odd = opens_or_closes()
    per_split = lines.groupBy(FILE_PATH, "__start").agg(
        F.min("__id").alias("__first"), F.count("*").alias("__lines"), F.count_if(odd).alias("__odd")
    )
    offsets = per_split.select(
        FILE_PATH, "__start", (_earlier("__lines") - F.col("__first") + 1).alias("__shift"), _earlier("__odd").alias("__odd_before")
    )
    offsets = written(offsets, "line-offsets")
    line = (F.col("__id") + F.col("__shift")).alias("line")
    # Numbers only, and a split at a time: a file that is one long series of such records stays dealt.
    rank = F.row_number().over(Window.partitionBy(FILE_PATH, "__start").orderBy("__id"))
    turns = lines.filter(odd).select(FILE_PATH, "__start", "__id").withColumn("__rank", rank).join(offsets, [FILE_PATH, "__start"])
    turns = turns.select(FILE_PATH, line, F.floor((F.col("__rank") + F.col("__odd_before") - 1) / 2).alias("__pair"))
    spans = turns.groupBy(FILE_PATH, "__pair").agg(F.min("line").alias("first"), F.max("line").alias("last")).filter("first < last")
    parts = written(spans.select(FILE_PATH, "first", F.explode(F.sequence("first", "last")).alias("line")), "record-lines")
    bucket, bit = F.bitmap_bucket_number("line").alias("__bucket"), F.bitmap_bit_position("line").alias("__bit")
    marks = parts.select(FILE_PATH, bucket, bit).groupBy(FILE_PATH, "__bucket").agg(F.bitmap_construct_agg("__bit").alias("__bits"))
    marks = written(marks, "record-marks")

    numbered = lines.join(offsets, [FILE_PATH, "__start"]).select("value", FILE_PATH, line)
    numbered = numbered.select("*", bucket, bit).join(marks, [FILE_PATH, "__bucket"], "left")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(F.col("__bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    marked = F.coalesce(F.getbit(byte, (F.col("__bit") % 8).cast("int")) == 1, F.lit(False))
    whole = numbered.filter(~marked).select("value", FILE_PATH, "line")
    pieces = numbered.filter(marked).select("value", FILE_PATH, "line").join(parts, [FILE_PATH, "line"])
    ordered = F.sort_array(F.collect_list(F.struct("line", "value")))
    joined = pieces.groupBy(FILE_PATH, "first").agg(F.array_join(F.transform(ordered, lambda p: p["value"]), "\n").alias("value"))
    records = written(whole.union(joined.select("value", FILE_PATH, F.col("first").alias("line"))), "landed-records")
    return records, widest(records)


def field_count(line: str = "value"):
    """Fields of a CSV line, or more: commas outside quoted fields, plus one; all commas where quotes are doubled inside a field."""
    text = F.col(line)
    # Escapes first: no group is repeated in the later patterns, so fields may be of any length.
    unescaped = F.regexp_replace(text, r'\\["\\]', "_")
    # Without a quote left over, quoted fields are whole and all others plain: an empty field or an escaped quote at the
    # end of a field is no doubled quote.
    plain = F.regexp_replace(unescaped, r'(^|,)"[^"]*+"(?=,|\z)', "$1")
    quoted_away = F.regexp_replace(unescaped, r'(^|,)\s*"[^"]*+"', "$1")
    counted = F.when(~F.contains(plain, F.lit('"')), plain).when(F.contains(text, F.lit('""')), text).otherwise(quoted_away)
    return F.length(counted) - F.length(F.replace(counted, F.lit(","))) + 1


def widest(lines: DataFrame) -> int:
    """Fields of the widest line, 1 at least."""
    return max(1, lines.agg(F.max(field_count())).first()[0] or 1)


def csv_width(spark: SparkSession, paths: str | Sequence[str]) -> int:
    """Fields of the widest line of all files."""
    return widest(spark.read.text([paths] if isinstance(paths, str) else list(paths)))


def parse_numbered(numbered: DataFrame, width: int) -> DataFrame:
    """Fields of each line as ``Prop_0..``, the line number as the last text column, then the file.

    Files of different widths get as many columns as the widest line of any needs; missing fields are NULL. A line
    with more fields than ``width`` would lose some and must not come here: take `widest` of the lines.
    """
    names = positional_names(width + 1)
    schema = ", ".join(f"`{n}` string" for n in names[:-1])
    fields = F.from_csv("value", F.lit(schema))
    return numbered.select(fields.alias("__f"), F.col("line").cast("string").alias(names[-1]), FILE_PATH).select(
        *(F.col(f"__f.{n}") for n in names[:-1]), names[-1], FILE_PATH
    )


def ledger(staged: DataFrame, load_ts) -> DataFrame:
    """Staged rows per file."""
    return (
        staged.groupBy(F.element_at(F.split(FILE_PATH, "/"), -1).alias("file_name"))
        .agg(F.count("*").alias("staging_row_count"))
        .withColumn("load_ts", moment(load_ts))
    )


def split_evenly(items: Sequence[str], parts: int) -> list[list[str]]:
    """Contiguous groups of nearly equal size; the first ``len % parts`` groups get one more."""
    if parts < 1:
        raise ValueError("parts must be positive")
    size, extra = divmod(len(items), parts)
    groups, start = [], 0
    for i in range(parts):
        end = start + size + (1 if i < extra else 0)
        groups.append(list(items[start:end]))
        start = end
    return groups


@dataclass(frozen=True)
class BatchResult:
    files: tuple[str, ...]
    error: str | None = None

    @property
    def ok(self) -> bool:
        return self.error is None


class BatchLoadError(RuntimeError):
    def __init__(self, results: Sequence[BatchResult]):
        self.results = list(results)
        failed = [r for r in results if not r.ok]
        super().__init__(f"{len(failed)} of {len(results)} groups failed: {failed[0].error}")


LOAD_RESULT = T.StructType(
    [T.StructField("file_name", T.StringType()), T.StructField("ok", T.BooleanType()), T.StructField("error", T.StringType())]
)


def load_in_batches(
    spark: SparkSession, files: Iterable[str], parts: int, load: Callable[[DataFrame], None]
) -> list[BatchResult]:
    """Load groups of files one after the other; a failing group does not stop the others.

    All groups are tried, then `BatchLoadError` is raised if any failed. Its ``results`` tell which.
    """
    results = []
    for group in split_evenly(list(files), parts):
        if not group:
            continue
        try:
            load(read_parquet(spark, group))
            results.append(BatchResult(tuple(group)))
        except Exception as error:  # noqa: BLE001 - isolation of a group is the point
            results.append(BatchResult(tuple(group), f"{type(error).__name__}: {error}".splitlines()[0]))
    if any(not r.ok for r in results):
        raise BatchLoadError(results)
    return results


def results_frame(spark: SparkSession, results: Sequence[BatchResult]) -> DataFrame:
    return spark.createDataFrame([(f, r.ok, r.error) for r in results for f in r.files], LOAD_RESULT)
