"""Current versions, counts of writes and fingerprints."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from keystrata.operators.counts import Fingerprint, reconcile_contents
from keystrata.operators.latest import latest_by
from keystrata.plans import current as current_module
from keystrata.plans.counted import append_counted, counts_by_source
from keystrata.plans.current import CurrentVersions, append_and_merge, for_delta_check, repair
from keystrata.plans.history import CountMismatch, merge_history

D = dt.datetime
DDL = "k string, sub string, EXTRACT_DATE_TIME timestamp_ntz, v string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def batch(spark, rng, n=25):
    day = lambda: D(2024, 1, rng.randrange(1, 6))
    rows = [(rng.choice("abcdefg"), rng.choice(["x", None]), day() if rng.random() < 0.95 else None, rng.choice(["1", "2", None])) for _ in range(n)]
    return spark.createDataFrame(rows, DDL)


def test_batches_in_any_order_equal_a_ranking_of_history(spark, lake):
    rng = random.Random(4)
    lake.create("SAT", DDL)
    current = CurrentVersions(lake, "SAT", ("k", "sub"), buckets=4)
    lake.append("SAT", batch(spark, rng))
    current.create()
    for _ in range(2):
        rows = batch(spark, rng)
        append_and_merge(current, rows)
        assert rows_of(current.rows()) == rows_of(latest_by(lake.read("SAT"), ["k", "sub"]))
    before = rows_of(current.rows())
    current.merge(rows)
    assert rows_of(current.rows()) == before


def test_only_buckets_of_the_batch_are_replaced_and_read(spark, lake, plan_of):
    lake.create("SAT", DDL)
    current = CurrentVersions(lake, "SAT", ("k",), buckets=16)
    rows = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(None).cast("string").alias("sub"), F.expr("timestamp_ntz'2024-01-01'").alias("EXTRACT_DATE_TIME"), F.lit("1").alias("v"))
    current.create()
    append_and_merge(current, rows)
    before = set(lake.read("SAT_CV").inputFiles())
    one = rows.filter("k = '7'").withColumn("EXTRACT_DATE_TIME", F.expr("timestamp_ntz'2024-01-02'"))
    append_and_merge(current, one)
    assert len(before - set(lake.read("SAT_CV").inputFiles())) == 1
    near = current.near(one)
    assert "CV_BUCKET" in plan_of(near).split("PartitionFilters: [")[1].split("]")[0]
    assert 0 < near.count() < 100 and near.filter("k = '7'").first().EXTRACT_DATE_TIME == D(2024, 1, 2)
    assert current.near(rows.limit(0)).count() == 0


def test_a_run_that_broke_off_is_repaired(spark, lake, monkeypatch):
    rng = random.Random(5)
    lake.create("SAT", DDL)
    current = for_delta_check(lake, "SAT", "k", "v", ["k", "sub", "EXTRACT_DATE_TIME", "v"])
    current.create()
    append_and_merge(current, batch(spark, rng))
    with monkeypatch.context() as broken:
        broken.setattr(current_module.CurrentVersions, "merge", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            append_and_merge(current, batch(spark, rng))
    assert repair(current) and not repair(current)
    ranked = latest_by(lake.read("SAT"), ["k"], ties=["v", "sub", "EXTRACT_DATE_TIME"])
    assert rows_of(current.rows()) == rows_of(ranked)


def test_counts_come_from_the_write(spark, lake):
    lake.create("SAT", "id bigint, RECORD_SOURCE string")
    lake.append("SAT", spark.sql("select id, 'old' as RECORD_SOURCE from range(3)"))
    rows = spark.sql("select id, if(id < 2, 'a', 'b') as RECORD_SOURCE from range(5)")
    assert append_counted(lake, "SAT", rows, ["a", "b"]) == 5
    assert append_counted(lake, "SAT", rows.withColumn("RECORD_SOURCE", F.when(F.col("id") > 0, "c")), ["a"]) == 5  # c and NULL were not announced
    assert append_counted(lake, "SAT", rows, []) == 5 and append_counted(lake, "SAT", rows.limit(0), ["a"]) == 0
    recount = lake.read("SAT").groupBy(F.col("RECORD_SOURCE").alias("source")).count()
    assert rows_of(counts_by_source(lake, "SAT")) == rows_of(recount)


def test_counts_after_an_append_that_broke_off(spark, lake, monkeypatch):
    lake.create("SAT", "id bigint, RECORD_SOURCE string")
    rows = spark.sql("select id, 'a' as RECORD_SOURCE from range(5)")
    append_counted(lake, "SAT", rows, ["a"])
    append = type(lake).append

    def breaks(self, table, *rest):
        append(self, table, *rest)
        if table == "SAT":
            raise InterruptedError("the driver was lost")

    with monkeypatch.context() as broken:
        broken.setattr(type(lake), "append", breaks)
        with pytest.raises(InterruptedError):
            append_counted(lake, "SAT", rows, ["a"])
    assert rows_of(counts_by_source(lake, "SAT")) == [("a", 10)]


ODD = [(1, "a", [1, 2], None, b"\x00"), (1, "a", [1, 2], None, b"\x00"), (2, None, None, 1.5, None), (3, "", [], float("nan"), b"")]
ODD_DDL = "id int, t string, l array<int>, d double, b binary"


def test_fingerprints_see_what_counts_do_not(spark):
    whole = spark.createDataFrame(ODD, ODD_DDL)
    a, b = spark.createDataFrame(ODD[:1], ODD_DDL), spark.createDataFrame(ODD[1:], ODD_DDL)
    assert Fingerprint.of(whole.repartition(3)) == Fingerprint.of(a) + Fingerprint.of(b)
    doubled = spark.createDataFrame([ODD[2], ODD[2], ODD[0], ODD[3]], ODD_DDL)
    assert doubled.count() == whole.count() and Fingerprint.of(doubled) != Fingerprint.of(whole)
    assert Fingerprint.of(whole.limit(0)) == Fingerprint()
    assert {r.ok for r in reconcile_contents(a, b, whole).collect()} == {True}
    assert {r.ok for r in reconcile_contents(a, b, doubled).collect()} == {False}
    shifted = [spark.createDataFrame([r], "x string, y string") for r in (("a", "b"), ("ab", None), ("", "ab"), (None, "ab"))]
    assert len({Fingerprint.of(s) for s in shifted}) == 4


def test_a_merge_that_swaps_a_row_for_another_is_refused(spark, lake, monkeypatch):
    for name in ("SAT", "SAT_HIST"):
        lake.create(name, "id bigint")
        lake.append(name, spark.range(3) if name == "SAT" else spark.range(10, 13))
    append = type(lake).append

    def wrong(self, table, rows, *rest):
        append(self, table, rows.withColumn("id", F.greatest("id", F.lit(11))) if table == "SAT" else rows, *rest)

    monkeypatch.setattr(type(lake), "append", wrong)
    with pytest.raises(CountMismatch, match="other contents"):
        merge_history(lake, "SAT", "SAT_HIST")
    assert lake.read("SAT_HIST").count() == 3
