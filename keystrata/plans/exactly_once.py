"""Loads that happen once: a ledger of files and batches, kept beside the vault.

A load is noted as begun before it touches a table and as done when all tables have it. A load that was begun and not
done is run again with the same load time; satellites then leave out what they got from it the first time. So direct inserts, too,
append nothing twice, wherever a run breaks off. Files are known by path, size and time of change.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystrata.plans.vault import VaultFeed
from keystrata.session import written
from keystrata.sources.files import BatchLoadError, BatchResult, read_parquet, split_evenly
from keystrata.sources.tables import Lake

LEDGER = "LOAD_LEDGER"
_COLUMNS = "feed string, load_id string, load_ts timestamp_ntz, file string, size bigint, changed timestamp, done boolean"


def listed(lake: Lake, paths: Sequence[str]) -> DataFrame:
    """``(file, size, changed)`` of files or of all files in folders; nothing of their contents is read."""
    files = lake.spark.read.format("binaryFile").load(list(paths))
    return files.select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


@dataclass(frozen=True)
class Begun:
    load_id: str
    load_ts: dt.datetime
    resumed: bool


@dataclass(frozen=True)
class LoadLedger:
    lake: Lake
    feed: str
    area: str = "rawvault"

    def _rows(self) -> DataFrame:
        if not self.lake.exists(LEDGER, self.area):
            self.lake.create(LEDGER, _COLUMNS, ["feed"], self.area)
        return self.lake.read(LEDGER, self.area).filter(F.col("feed") == self.feed)

    def _note(self, load_id: str, load_ts: dt.datetime, done: bool, files: DataFrame | None = None) -> None:
        spark = self.lake.spark
        rows = files if files is not None else spark.createDataFrame([(None, None, None)], "file string, size bigint, changed timestamp")
        rows = rows.select(
            F.lit(self.feed).alias("feed"), F.lit(load_id).alias("load_id"), F.lit(load_ts).cast("timestamp_ntz").alias("load_ts"), "file", "size", "changed", F.lit(done).alias("done")
        )
        self.lake.append(LEDGER, rows.coalesce(1), self.area)

    def unfinished(self) -> list[Begun]:
        """Loads that were begun and not done, oldest first."""
        loads = self._rows().groupBy("load_id").agg(F.min("load_ts").alias("load_ts"), F.bool_or("done").alias("done"))
        return [Begun(r.load_id, r.load_ts, True) for r in loads.filter("not done").orderBy("load_ts").collect()]

    def files_of(self, load_id: str) -> list[str]:
        return [r.file for r in self._rows().filter((F.col("load_id") == load_id) & F.col("file").isNotNull()).select("file").distinct().orderBy("file").collect()]

    def new_files(self, files: DataFrame) -> DataFrame:
        """Files that no load was begun with; one that changed since is new."""
        return files.join(self._rows().select("file", "size", "changed"), ["file", "size", "changed"], "left_anti")

    def begin(self, load_id: str, files: DataFrame | None = None, now: dt.datetime | None = None) -> Begun | None:
        """Note that a load begins; None if it is done. One that was begun before keeps its load time.

        Load times are a second apart at least, so that what a load appended can be told by it.
        """
        rows = self._rows()
        state = rows.filter(F.col("load_id") == load_id).agg(F.min("load_ts").alias("ts"), F.bool_or("done").alias("done")).first()
        if state.done:
            return None
        if state.ts is not None:
            return Begun(load_id, state.ts, True)
        last = rows.agg(F.max("load_ts")).first()[0]
        load_ts = (now or dt.datetime.now()).replace(microsecond=0)
        if last is not None:
            load_ts = max(load_ts, last + dt.timedelta(seconds=1))
        self._note(load_id, load_ts, False, files)
        return Begun(load_id, load_ts, False)

    def finish(self, begun: Begun) -> None:
        self._note(begun.load_id, begun.load_ts, True)


def _run(feed: VaultFeed, ledger: LoadLedger, begun: Begun, raw: DataFrame, count_log: str | None) -> None:
    dataclasses.replace(feed, load_ts=begun.load_ts, resumed=begun.resumed).run(raw, count_log)
    ledger.finish(begun)


def run_new_files(feed: VaultFeed, paths: Sequence[str], count_log: str | None = None, now: dt.datetime | None = None) -> list[BatchResult]:
    """Load the files among ``paths`` that were not loaded before, in the groups the feed asks for.

    Loads that broke off earlier are completed first. A failing group does not stop the others; it stays begun and is tried again
    by the next call.
    """
    lake, ledger = feed.lake, LoadLedger(feed.lake, feed.config.record_source)
    results = []

    def attempt(files: Sequence[str], begun: Begun) -> None:
        try:
            _run(feed, ledger, begun, read_parquet(lake.spark, list(files)), count_log)
            results.append(BatchResult(tuple(files)))
        except Exception as error:  # noqa: BLE001 - isolation of a group is the point
            results.append(BatchResult(tuple(files), f"{type(error).__name__}: {error}".splitlines()[0]))

    for begun in ledger.unfinished():
        files = ledger.files_of(begun.load_id)
        if files:  # else a batch of a stream, which the stream repeats itself
            attempt(files, begun)
    fresh = written(ledger.new_files(listed(lake, paths)), "new-files")
    names = [r.file for r in fresh.select("file").orderBy("file").collect()]  # names of files, not rows
    for group in split_evenly(names, feed.config.batches):
        if group:
            begun = ledger.begin(f"files-{uuid.uuid4().hex}", fresh.filter(F.col("file").isin(group)), now)
            attempt(group, begun)
    if any(not r.ok for r in results):
        raise BatchLoadError(results)
    return results


def follow_folder(feed: VaultFeed, folder: str, schema: T.StructType | str, checkpoint: str, files_per_batch: int = 1000, name: str = "stream", now: dt.datetime | None = None) -> int:
    """Load what has come into a folder since the last call, as a stream that ends when it has caught up; returns batches loaded.

    Spark keeps in ``checkpoint`` which files each batch has, and gives a batch that broke off the same files and number
    again; the ledger knows from the number whether the vault has it.
    """
    ledger, done = LoadLedger(feed.lake, feed.config.record_source), []

    def load(batch: DataFrame, number: int) -> None:
        begun = ledger.begin(f"{name}-{number}", now=now) if not batch.isEmpty() else None
        if begun is not None:
            _run(feed, ledger, begun, batch, None)
            done.append(number)

    stream = feed.lake.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    query = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(done)
