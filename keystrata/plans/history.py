"""History tables: direct insert, and the merge of a history table into its daily table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystrata.functions.hashing import quoted
from keystrata.operators.columns import select_target
from keystrata.operators.counts import Fingerprint, count_as
from keystrata.sources.files import append_count_log
from keystrata.sources.tables import Lake

# The table whose insert time arrives as text, and that column's format.
TEXT_DATED_TABLE = "SAT_UIQ_EVENT_LOG"
TEXT_DATED_COLUMN = "ROW_INSERT_DTM"
TEXT_DATE_FORMAT = "yyyy-MM-dd"


def parse_text_date(df: DataFrame, column: str = TEXT_DATED_COLUMN) -> DataFrame:
    return df.withColumn(column, F.try_to_date(quoted(column), TEXT_DATE_FORMAT))


def direct_insert(lake: Lake, table: str, staged: DataFrame, area: str = "hist_data", count_log: str | None = None) -> None:
    """Append staged rows to a history table as they are, then log the table's row count."""
    if table == TEXT_DATED_TABLE:
        staged = parse_text_date(staged)
    lake.append(table, staged, area)
    if count_log:
        append_count_log(count_as(lake.read(table, area), table), count_log)


class CountMismatch(RuntimeError):
    """The merged table has not all rows of both, or has some that neither had."""


class UnfinishedMerge(RuntimeError):
    pass


def merge_history(lake: Lake, daily: str, history: str, area: str = "rawvault", resume: bool = False) -> dict[str, int]:
    """Append a history table to its daily table, check the counts, then leave the history table empty.

    Both tables are copied to ``<table>_bkp`` first. The check is of contents, not of counts alone: a row that is lost while another
    is doubled is found, see `Fingerprint`. A mismatch stops before anything is removed. From the
    first change on until the end, the table ``<daily>_merging`` marks the merge as unfinished: another call refuses, so
    that nothing is added twice and the good copies stay, unless ``resume`` puts both tables back from their copies and
    merges anew. With an empty history table nothing is done.
    """
    marker = f"{daily}_merging"
    if lake.exists(marker, area):
        if not resume:
            raise UnfinishedMerge(f"a merge into {daily} did not finish; its tables are kept as {daily}_bkp and {history}_bkp")
        for table in (daily, history):
            lake.create_like(table, f"{table}_bkp", area)
            lake.append(table, lake.read(f"{table}_bkp", area), area)
    columns = lake.columns(daily, area)
    before, added = Fingerprint.of(lake.read(daily, area)), Fingerprint.of(select_target(lake.read(history, area), columns))
    if added.row_count:
        if not lake.exists(marker, area):
            lake.backup(daily, area)
            lake.backup(history, area)
            lake.create(marker, "history string", area=area)
        lake.append(daily, lake.read(history, area), area)
        total = Fingerprint.of(lake.read(daily, area))
        if total != before + added:
            counts = f"{before.row_count} + {added.row_count} rows expected, {total.row_count} found"
            raise CountMismatch(f"{daily}: {counts}" + ", with other contents" * (total.row_count == before.row_count + added.row_count))
        lake.truncate(history, area)
    lake.drop(marker, area)
    return {"daily_count": before.row_count, "history_count": added.row_count, "total_count": (before + added).row_count}
