"""Loads that happen once, wherever a run breaks off."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from keystrata.plans import vault as V
from keystrata.plans.config import FeedConfig
from keystrata.plans.exactly_once import LoadLedger, follow_folder, listed, run_new_files
from keystrata.sources.files import BatchLoadError
from tests.test_vault import BASE, make_tables

FLAT = {k: v for k, v in BASE.items() if not k.startswith("Prop")} | {"load_type": "Hist_Data", "BUSINESSPARTITIONDATE": "BUS"}
SCHEMA = "EQUNR string, NMI string, BUS timestamp_ntz, OWNER string, SIZE double, _srcFileName string"
NOW = dt.datetime(2024, 2, 1)


def drop(spark, folder, *names):
    """A file for each name, with three rows."""
    for name in names:
        rows = [(f"{name}{i}", "N1", NOW, "o", 1.0, name) for i in range(3)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def feed(lake, **more):
    return V.VaultFeed(lake, FeedConfig.from_parameters(FLAT | more))


def keys(lake):
    return sorted(r.RECORD_SOURCE for r in lake.read("SAT_EQUIP").collect())


def test_files_are_loaded_once(spark, lake, tmp_path):
    make_tables(lake)
    drop(spark, tmp_path / "in", "a", "b")
    assert len(run_new_files(feed(lake, NUMBER_OF_ITER="2"), [str(tmp_path / "in")], str(tmp_path / "log"), NOW)) == 2
    assert keys(lake) == ["a"] * 3 + ["b"] * 3
    assert run_new_files(feed(lake), [str(tmp_path / "in")], str(tmp_path / "log"), NOW) == []
    drop(spark, tmp_path / "in", "c")
    assert len(run_new_files(feed(lake), [str(tmp_path / "in")], str(tmp_path / "log"), NOW)) == 1
    assert keys(lake) == ["a"] * 3 + ["b"] * 3 + ["c"] * 3
    assert len({r.LOAD_DATE_TIME for r in lake.read("SAT_EQUIP").collect()}) == 3


@pytest.mark.parametrize("broken_after", ["HUB_EQUIP", "SAT_EQUIP", "SAT_EQUIP_COUNTS", "LOAD_LEDGER"])
def test_a_run_that_broke_off_is_completed(spark, lake, tmp_path, monkeypatch, broken_after):
    make_tables(lake)
    drop(spark, tmp_path / "in", "a", "b")
    append, appended = type(lake).append, []

    def breaks(self, table, *rest, **named):
        append(self, table, *rest, **named)
        appended.append(table)
        if table == broken_after:
            raise InterruptedError("the driver was lost")

    with monkeypatch.context() as broken:
        broken.setattr(type(lake), "append", breaks)
        with pytest.raises((InterruptedError, BatchLoadError)):
            run_new_files(feed(lake), [str(tmp_path / "in")], str(tmp_path / "log"), NOW)
    assert broken_after in appended
    run_new_files(feed(lake), [str(tmp_path / "in")], str(tmp_path / "log"), NOW)
    assert keys(lake) == ["a"] * 3 + ["b"] * 3
    assert LoadLedger(lake, "ERP.METERS").unfinished() == []
    assert {r.LOAD_DATE_TIME for r in lake.read("SAT_EQUIP").collect()} == {NOW}


def test_changed_files_are_new(spark, lake, tmp_path):
    make_tables(lake)
    drop(spark, tmp_path / "in", "a")
    ledger = LoadLedger(lake, "f")
    files = listed(lake, [str(tmp_path / "in")])
    begun = ledger.begin("1", files, NOW)
    assert ledger.new_files(files).count() == 0 and ledger.begin("1").resumed
    ledger.finish(begun)
    assert ledger.begin("1") is None and ledger.begin("2", None, NOW).load_ts == NOW + dt.timedelta(seconds=1)
    assert ledger.new_files(files.withColumn("size", F.col("size") + 1)).count() == 1
    assert LoadLedger(lake, "other").new_files(files).count() == 1


def test_three_drops_of_files_equal_one_load(spark, lake, tmp_path):
    make_tables(lake)
    config, folder, mark = feed(lake), str(tmp_path / "in"), str(tmp_path / "mark")
    os.makedirs(folder)
    for names in (["a"], ["b", "c"], ["d"]):
        drop(spark, folder, *names)
        assert follow_folder(config, folder, SCHEMA, mark, files_per_batch=1) == len(names)
    assert follow_folder(config, folder, SCHEMA, mark) == 0
    assert keys(lake) == sorted("abcd" * 3)
    assert lake.read("HUB_EQUIP").count() == 12


def test_a_batch_of_the_stream_that_broke_off_is_completed(spark, lake, tmp_path, monkeypatch):
    make_tables(lake)
    drop(spark, tmp_path / "in", "a")
    append = type(lake).append

    def breaks(self, table, *rest, **named):
        append(self, table, *rest, **named)
        if table == "SAT_EQUIP":
            raise InterruptedError("the driver was lost")

    with monkeypatch.context() as broken:
        broken.setattr(type(lake), "append", breaks)
        with pytest.raises(Exception, match="the driver was lost"):
            follow_folder(feed(lake), str(tmp_path / "in"), SCHEMA, str(tmp_path / "mark"))
    assert keys(lake) == ["a"] * 3
    assert follow_folder(feed(lake), str(tmp_path / "in"), SCHEMA, str(tmp_path / "mark")) == 1
    assert keys(lake) == ["a"] * 3
