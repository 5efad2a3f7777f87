"""Bitmaps of key hashes beside hubs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keystrata.operators.merge import insert_only
from keystrata.plans import key_prefixes as module
from keystrata.plans.config import FeedConfig
from keystrata.plans.key_prefixes import KeyPrefixes
from keystrata.plans.vault import VaultFeed
from tests.test_vault import BASE, T1, T2, make_tables, raw

DDL = "k string, n bigint"


def keys(spark, *ranges):
    rows = spark.range(0).select(F.lit("").alias("k"), F.col("id").alias("n"))
    for a, b in ranges:
        rows = rows.union(spark.range(a, b).select(F.sha1(F.col("id").cast("string")).alias("k"), F.col("id").alias("n")))
    return rows


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def hub(spark, lake):
    lake.create("HUB", DDL)
    lake.append("HUB", keys(spark, (0, 5000)))
    prefixes = KeyPrefixes(lake, "HUB", "k")
    prefixes.rebuild()
    return prefixes


def test_no_known_key_is_ruled_out_and_few_others_are_not(spark, hub):
    assert hub.possible(keys(spark, (0, 5000))).count() == 5000
    assert hub.possible(keys(spark, (5000, 25000))).count() < 400  # (3 / 32) ** 3 of 20,000, and some more for full blocks
    assert hub.lake.read("HUB_KP").filter("block is not null").agg(F.max(F.length("bits"))).first()[0] == module.BITS // 8


def test_loads_equal_the_plain_ones(spark, lake, hub):
    lake.create("PLAIN", DDL)
    lake.append("PLAIN", keys(spark, (0, 5000)))
    for batch in (keys(spark, (4000, 6000), (4500, 5500)), keys(spark, (4000, 6000)), keys(spark, (9000, 9500), (0, 10))):
        lake.append("PLAIN", insert_only(lake.read("PLAIN"), batch, ["k"]))
        hub.append_new(batch)
        assert rows_of(lake.read("HUB")) == rows_of(lake.read("PLAIN"))


def test_new_keys_alone_do_not_read_the_target(spark, lake, hub, plan_of):
    batch = keys(spark, (100_000, 100_003))
    assert hub.possible(batch).isEmpty()
    fresh = hub.new_rows(batch, hub.possible(batch))
    assert "FileScan" not in plan_of(fresh) and "Scan parquet" not in plan_of(fresh)
    assert rows_of(fresh) == rows_of(batch)


def test_a_load_that_breaks_off_is_repeated(spark, lake, hub):
    batch = keys(spark, (6000, 6100))
    hub.add(batch)  # bits without rows
    hub.append_new(batch)
    hub.append_new(batch)
    assert lake.read("HUB").count() == 5100


def test_empty_and_null(spark, lake):
    lake.create("HUB", DDL)
    prefixes = KeyPrefixes(lake, "HUB", "k")
    prefixes.rebuild()
    prefixes.append_new(keys(spark))
    assert lake.read("HUB").count() == 0
    nulls = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], DDL)
    prefixes.append_new(nulls)
    prefixes.append_new(nulls)  # as by the plain load, one row with a NULL key each time
    assert [r.k for r in lake.read("HUB").collect()].count(None) == 2
    assert lake.read("HUB").filter("k = 'a'").count() == 1


def test_rebuilt_for_more_keys(spark, lake, hub):
    lake.append("HUB", keys(spark, (5000, 9000)))
    hub.rebuild(expected=100_000)
    assert hub._blocks() == 98
    assert hub.possible(keys(spark, (0, 9000))).count() == 9000
    assert hub.possible(keys(spark, (20_000, 40_000))).count() < 10


def test_feed_keeps_the_bitmaps_of_its_hubs_and_links(spark, lake):
    make_tables(lake)
    config = FeedConfig.from_parameters(BASE)
    keys_of = {"HUB_EQUIP": "HUB_EQUIP_HSH_KEY", "HUB_NMI": "HUB_NMI_HSH_KEY", "LINK_EQUIP_NMI": "LINK_EQUIP_NMI_HSH_KEY"}
    for table, key in keys_of.items():
        KeyPrefixes(lake, table, key).rebuild(expected=1000)
    first = raw(spark, ("12", "N1", "I", T1, "1.50", "1"), ("13", "N2", "I", T1, "1.00", "2"))
    second = raw(spark, ("12", "N1", "U", T2, "2.00", "1"), ("14", "N2", "I", T2, "1.00", "2"))
    for batch in (first, first, second):
        VaultFeed(lake, config, dt.datetime(2024, 2, 1)).run(batch)
    counts = {t: lake.read(t).count() for t in keys_of}
    assert counts == {"HUB_EQUIP": 3, "HUB_NMI": 2, "LINK_EQUIP_NMI": 3}
    for table, key in keys_of.items():
        assert KeyPrefixes(lake, table, key).possible(lake.read(table)).count() == counts[table]
