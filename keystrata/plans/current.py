"""Tables of current versions, kept up by each batch instead of ranking history.

``<SAT>_CV`` holds the newest row of every key of a satellite. It is cut into buckets by the key, each a partition, so that a
batch reads and replaces the buckets of its own keys only. Batches may come in any order of time: a row takes the place of
another only if ranking the whole history would put it first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystrata.functions.hashing import quoted
from keystrata.operators.latest import latest_by
from keystrata.session import written
from keystrata.sources.partitions import finish_switch, in_listed, replace_partitions, touched_partitions
from keystrata.sources.tables import Lake

BUCKET = "CV_BUCKET"


@dataclass(frozen=True)
class CurrentVersions:
    """The newest row per ``keys`` of a satellite, in ``columns`` (all of them by default).

    Ties are broken by ``ties``, by default the other columns in their order, as a ranking of the history in the same columns
    does. ``name`` is by default ``<SAT>_CV``.
    """

    lake: Lake
    satellite: str
    keys: tuple[str, ...]
    order_by: str = "EXTRACT_DATE_TIME"
    columns: tuple[str, ...] = ()
    ties: tuple[str, ...] | None = None
    name: str = ""
    buckets: int = 64
    area: str = "rawvault"

    @property
    def table(self) -> str:
        return self.name or f"{self.satellite}_CV"

    @property
    def _columns(self) -> list[str]:
        return list(self.columns or self.lake.columns(self.satellite, self.area))

    def exists(self) -> bool:
        return self.lake.exists(self.table, self.area)

    def create(self) -> None:
        """Create the table and fill it from the satellite; the only time that history is ranked."""
        schema = self.lake.read(self.satellite, self.area).select(*map(quoted, self._columns)).schema
        self.lake.create(self.table, T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())]), [BUCKET], self.area)
        self.merge(self.lake.read(self.satellite, self.area))

    def _placed(self, rows: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*map(quoted, self.keys)), F.lit(self.buckets)).cast("int")
        return rows.select(*map(quoted, self._columns)).withColumn(BUCKET, bucket)

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_by(rows, self.keys, self.order_by, self.ties)

    def merge(self, rows: DataFrame) -> None:
        """Take a batch of satellite rows in. Taking it in again changes nothing."""
        finish_switch(self.lake, self.table, self.area)
        batch = written(self._newest(self._placed(rows)), "current-versions")
        touched = touched_partitions(batch, [BUCKET])
        if not touched:
            return
        table = self.lake.read(self.table, self.area)
        state = table.filter(in_listed(table.schema, touched))
        replace_partitions(self.lake, self.table, self._newest(state.unionByName(batch)), touched, self.area)

    def rows(self) -> DataFrame:
        finish_switch(self.lake, self.table, self.area)
        return self.lake.read(self.table, self.area).drop(BUCKET)

    def near(self, batch: DataFrame) -> DataFrame:
        """Rows in the buckets of a batch's keys; no other bucket is read."""
        finish_switch(self.lake, self.table, self.area)
        keys = batch.select(*map(quoted, self.keys)).distinct()
        bucket = F.pmod(F.xxhash64(*map(quoted, self.keys)), F.lit(self.buckets)).cast("int")
        table = self.lake.read(self.table, self.area)
        return table.filter(in_listed(table.schema, touched_partitions(keys.select(bucket.alias(BUCKET)), [BUCKET]))).drop(BUCKET)


def _pending(table: str) -> str:
    return f"{table}_pending"


def append_and_merge(current: CurrentVersions, rows: DataFrame) -> None:
    """Append rows to the satellite and take them into its table of current versions.

    If a run breaks off between the two, the next one makes the table anew from the satellite before it is used.
    """
    lake, rows = current.lake, written(rows, "satellite-batch")
    lake.create(_pending(current.table), "satellite string", area=current.area)
    lake.append(current.satellite, rows, current.area)
    current.merge(rows)
    lake.drop(_pending(current.table), current.area)


def repair(current: CurrentVersions) -> bool:
    """Make the table anew if a run broke off between append and merge; whether it did."""
    if not current.lake.exists(_pending(current.table), current.area):
        return False
    current.create()
    current.lake.drop(_pending(current.table), current.area)
    return True


def for_delta_check(lake: Lake, satellite: str, key: str, diff: str, columns: Sequence[str]) -> CurrentVersions:
    """Current versions by hash key; of equally new rows the one with the smallest change hash counts, as in `current_hashes`."""
    rest = [c for c in columns if c not in (key, diff)]
    return CurrentVersions(lake, satellite, (key,), ties=(diff, *rest))
