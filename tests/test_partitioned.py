"""Replacing partitions and upserts into partitioned tables, against row-at-a-time statements of the same rules."""

import random

import pytest
from pyspark.sql import functions as F

from keystrata.operators.sequence import in_order, with_neighbour, without_order
from keystrata.plans.partitioned import partitions_of_upsert, upsert_partitions
from keystrata.sources import partitions as P

DDL = "k string, v string, day date, zone string"


def rows_of(df):
    return sorted((tuple(str(v) if v is not None else None for v in r) for r in df.collect()), key=repr)


def make(spark, lake, rows, parts=("day", "zone")):
    lake.create("T", DDL, list(parts))
    lake.append("T", frame(spark, rows))


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, day string, zone string").withColumn("day", F.to_date("day"))


ROWS = [("a", "1", "2024-01-01", "x"), ("b", "2", "2024-01-01", "y"), ("c", "3", "2024-01-02", "it's"), ("d", "4", None, "x"), ("e", "5", "2024-01-03", None)]


def test_replaced_and_emptied_partitions(spark, lake):
    make(spark, lake, ROWS)
    touched = P.touched_partitions(lake.read("T").filter("k in ('a', 'b', 'd')"), ["day", "zone"])
    assert len(touched) == 3
    new = frame(spark, [("a", "9", "2024-01-01", "x"), ("f", "6", "2024-01-04", "it's")])
    replaced = P.replace_partitions(lake, "T", new, touched)
    assert len(replaced) == 4
    assert rows_of(lake.read("T").select("k", "v", "day", "zone")) == sorted(
        [("a", "9", "2024-01-01", "x"), ("c", "3", "2024-01-02", "it's"), ("e", "5", "2024-01-03", None), ("f", "6", "2024-01-04", "it's")], key=repr
    )
    # Later appends go where the partition is now, also where it was emptied.
    lake.append("T", frame(spark, [("g", "7", "2024-01-01", "x"), ("h", "8", "2024-01-01", "y"), ("i", "9", None, "x")]))
    assert {r[0] for r in rows_of(lake.read("T").select("k"))} == set("acefghi")
    assert {r[0] for r in rows_of(lake.read("T").filter("zone = 'y'").select("k"))} == {"h"}


def test_a_switch_that_broke_off_is_completed(spark, lake, monkeypatch):
    make(spark, lake, ROWS)
    calls = []
    plain = spark.sql

    class Broken:
        def __getattr__(self, name):
            return getattr(spark, name)

        def sql(self, text):
            calls.append(text)
            if sum("SET LOCATION" in c for c in calls) > 1:
                raise InterruptedError("the driver was lost")
            return plain(text)

    source = frame(spark, [("a", "9", "2024-01-02", "it's"), ("c", "8", "2024-01-01", "x"), ("n", "7", "2024-01-09", "z")])
    columns = {c: c for c in ("k", "v", "day", "zone")}
    update = {c: c for c in ("v", "day", "zone")}
    with pytest.raises(InterruptedError):
        upsert_partitions(type(lake)(Broken(), lake.env, lake.root), "T", source, ["k"], update, columns)
    upsert_partitions(lake, "T", source, ["k"], update, columns)
    expected = {r[0]: r for r in ROWS} | {r[0]: r for r in [("a", "9", "2024-01-02", "it's"), ("c", "8", "2024-01-01", "x"), ("n", "7", "2024-01-09", "z")]}
    assert rows_of(lake.read("T").select("k", "v", "day", "zone")) == sorted(expected.values(), key=repr)
    assert not lake.exists("T_switching") and not P.finish_switch(lake, "T")


@pytest.mark.parametrize("seed", range(2))
def test_upserts_against_a_dictionary(spark, lake, seed):
    rng = random.Random(seed)
    row = lambda k: (k, str(rng.randrange(99)), rng.choice(["2024-01-01", "2024-01-02", None]), rng.choice(["x", "y", None]))
    state = {k: row(k) for k in map(str, range(12))}
    make(spark, lake, list(state.values()))
    for _ in range(2):
        batch = [row(str(rng.randrange(20))) for _ in range(6)]
        batch = list({r[0]: r for r in batch}.values())
        upsert_partitions(lake, "T", frame(spark, batch), ["k"], {"v": "v", "day": "day"}, {c: c for c in ("k", "v", "day", "zone")})
        for k, v, day, zone in batch:
            state[k] = (k, v, day, state[k][3] if k in state else zone)
    assert rows_of(lake.read("T").select("k", "v", "day", "zone")) == sorted(state.values(), key=repr)


def test_only_touched_partitions_are_read_and_replaced(spark, lake, plan_of):
    make(spark, lake, [(str(i), "v", f"2024-01-{i % 9 + 1:02}", "x") for i in range(50)], ["day"])
    source = frame(spark, [("0", "new", "2024-01-01", "x"), ("100", "new", "2024-01-03", "x")])
    columns = {c: c for c in ("k", "v", "day", "zone")}
    touched = partitions_of_upsert(lake.read("T"), source, ["k"], {"v": "v"}, columns, ["day"])
    assert sorted(r.day for r in touched) == ["2024-01-01", "2024-01-03"]
    target = lake.read("T")
    assert "day" in plan_of(target.filter(P.in_listed(target.schema, touched))).split("PartitionFilters: [")[1].split("]")[0]
    before = set(lake.read("T").inputFiles())
    assert len(upsert_partitions(lake, "T", source, ["k"], {"v": "v"}, columns)) == 2
    kept = before & set(lake.read("T").inputFiles())
    assert len({f.split("day=")[1][:10] for f in kept}) == 7
    with_promise = upsert_partitions(lake, "T", source, ["k"], {"v": "v"}, columns, moves=False)
    assert sorted(r.day for r in with_promise) == ["2024-01-01", "2024-01-03"] and lake.read("T").count() == 51
    assert upsert_partitions(lake, "T", source.limit(0), ["k"], {"v": "v"}, columns) == []
    lake.create("PLAIN", DDL)
    with pytest.raises(ValueError):
        upsert_partitions(lake, "PLAIN", source, ["k"], {"v": "v"}, columns)


def test_timestamp_and_number_partitions(spark, lake):
    lake.create("N", "k int, at timestamp_ntz, n int", ["at", "n"])
    rows = spark.sql("select id as k, timestamp_ntz'2024-03-31 01:30:00.5' + make_interval(0,0,0,0,id) as at, int(id % 2) as n from (select int(id) id from range(6))")
    lake.append("N", rows)
    upsert_partitions(lake, "N", rows.filter("k < 2").withColumn("n", F.lit(7)), ["k"], {"n": "n"}, {c: c for c in ("k", "at", "n")})
    assert [(r.k, r.n) for r in lake.read("N").orderBy("k").collect()] == [(0, 7), (1, 7), (2, 0), (3, 1), (4, 0), (5, 1)]


def test_neighbours_cross_tasks(spark):
    rows = [("hot", i) for i in range(200)] + [(f"k{i}", 1) for i in range(30)] + [(None, 5), (None, 6)]
    df = spark.createDataFrame(rows, "k string, t int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # few rows, but several tasks
    try:
        placed = in_order(df, ["k", "t"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert placed.select("__seq_part").distinct().count() > 3
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    both = without_order(with_neighbour(with_neighbour(placed, "b", ["k", "t"]), "a", ["t"], after=True)).collect()
    got = sorted(((r.k, r.t, tuple(r.b) if r.b else None, r.a.t if r.a else None) for r in both), key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert got == [(k, t, order[i - 1] if i else None, order[i + 1][1] if i + 1 < len(order) else None) for i, (k, t) in enumerate(order)]
    odd = with_neighbour(placed.filter("t % 2 = 1"), "b", ["t"]).filter("k = 'hot' and t = 101").first()
    assert odd.b.t == 99
