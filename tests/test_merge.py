"""Merges against row-at-a-time statements of the same rules."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from keystrata.operators.merge import current_hashes, in_partitions, insert_only, new_versions, upsert
from keystrata.plans import calendar as K

D = dt.datetime


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_insert_only_is_idempotent(spark):
    schema = "k string, v int"
    target = spark.createDataFrame([("a", 1)], schema)
    source = spark.createDataFrame([("a", 2), ("b", 5), ("b", 4), (None, 9), (None, 8)], schema)
    added = insert_only(target, source, ["k"])
    assert rows_of(added) == [("b", 4), (None, 8)]
    assert rows_of(insert_only(target.union(added.filter("k is not null")), source, ["k"])) == [(None, 8)]


def test_new_versions_and_returning_values(spark):
    schema = "k string, d string, EXTRACT_DATE_TIME timestamp_ntz"
    loaded = spark.createDataFrame([("x", "A", D(2024, 1, 1)), ("x", "B", D(2024, 1, 2))], schema)
    again = spark.createDataFrame([("x", "A", D(2024, 1, 3)), ("x", "B", D(2024, 1, 3)), ("x", "A", D(2024, 1, 4))], schema)
    against_current = new_versions(again, current_hashes(loaded, "k", "d"), "k", "d")
    assert rows_of(against_current) == [("x", "A", D(2024, 1, 3))]
    assert new_versions(again, loaded, "k", "d").count() == 0


def test_in_partitions(spark, plan_of):
    target = spark.createDataFrame([("a", "p", 1), ("b", "q", 2), ("c", None, 3), ("d", "r", 4)], "k string, p string, q int")
    source = spark.createDataFrame([("x", "p", 4), ("y", "zz", None), ("z", None, None)], "k string, p string, q int")
    assert [r.k for r in in_partitions(target, source, "p").collect()] == ["a"]
    assert sorted(r.k for r in in_partitions(target, source, {"p": None, "q": None}).collect()) == ["a", "d"]
    assert in_partitions(target, source.filter("k = 'z'"), "p").count() == 0
    assert in_partitions(target, source, "p").columns == target.columns


def test_in_partitions_compares_instants_in_every_session_zone(spark):
    """Two instants an hour apart in the autumn clock change have the same text."""
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Australia/Melbourne"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            hours = spark.range(3).selectExpr("id", "timestamp_seconds(1712415600 + 3600 * id) as p")
            assert sorted(r.id for r in in_partitions(hours, hours.filter("id < 2"), "p").collect()) == [0, 1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_in_partitions_prunes_and_reads_formats(spark, lake, plan_of):
    lake.create("SAT", "k string, day date", ["day"])
    lake.append("SAT", spark.sql("select 'k' || d as k, date'2024-01-01' + int(d) as day from (select id as d from range(20))"))
    source = spark.createDataFrame([("02/01/2024",), ("03/01/2024",), ("no date",)], "day string")
    found = in_partitions(lake.read("SAT"), source, {"day": "dd/MM/yyyy"})
    assert sorted(r.k for r in found.collect()) == ["k1", "k2"]
    plan = plan_of(found)
    assert "PartitionFilters: [isnotnull(day" in plan and "2024-01-02" in plan and "2024-01-03" in plan


def test_partition_list_prunes_the_scan(spark, lake, plan_of):
    lake.create("SAT", "k string, p timestamp_ntz", ["p"])
    batch = spark.createDataFrame([("a", D(2024, 1, 1)), ("b", D(2024, 1, 2))], "k string, p timestamp_ntz")
    lake.append("SAT", batch)
    found = in_partitions(lake.read("SAT"), batch.filter("k = 'a'"), "p")
    assert "PartitionFilters: [isnotnull(p" in plan_of(found) and found.count() == 1


def python_upsert(target, source):
    result = [list(t) for t in target]
    for key, value in source:
        hits = [r for r in result[: len(target)] if key is not None and r[0] == key]
        for r in hits:
            r[1] = value
        if not hits:
            result.append([key, value, "new"])
    return sorted(map(tuple, result), key=repr)


def test_upsert_against_python(spark):
    rng = random.Random(5)
    target = [(rng.choice([None, *range(40)]), i, "old") for i in range(30)]
    source = [(k, 100 + k) for k in rng.sample(range(60), 30)] + [(None, 7), (None, 8)]
    got = upsert(
        spark.createDataFrame(target, "k int, v int, s string"),
        spark.createDataFrame(source, "k int, w int"),
        ["k"],
        {"v": "w"},
        {"k": "k", "v": "w", "s": F.lit("new")},
    )
    assert rows_of(got) == python_upsert(target, source)


def test_upsert_can_set_null(spark):
    target = spark.createDataFrame([(1, "x")], "k int, v string")
    source = spark.createDataFrame([(1, None), (2, None)], "k int, w string")
    assert rows_of(upsert(target, source, ["k"], {"v": "w"}, {"k": "k"})) == [(1, None), (2, None)]


def test_upsert_duplicates(spark):
    target = spark.createDataFrame([(1, "x")], "k int, v string")
    twice = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "n", 1), (None, "m", 1)], "k int, w string, n int")
    with pytest.raises(ValueError, match="several"):
        upsert(target, twice, ["k"], {"v": "w"}, {"k": "k", "v": "w"})
    last = upsert(target, twice, ["k"], {"v": "w"}, {"k": "k", "v": "w"}, "last", [F.col("n").desc()])
    assert rows_of(last) == [(1, "b"), (None, "m"), (None, "n")]
    # Unmatched duplicates are all inserted.
    fresh = spark.createDataFrame([(5, "a"), (5, "b")], "k int, w string")
    assert rows_of(upsert(target, fresh, ["k"], {"v": "w"}, {"k": "k", "v": "w"})) == [(1, "x"), (5, "a"), (5, "b")]
    with pytest.raises(ValueError):
        upsert(target, fresh, ["k"], {}, {}, "first")


BRANCHES = [*K.DELIVERY_BRANCHES, K.HOLIDAY]


def python_deliveries(target, wide):
    """Five merges one after the other; None when a merge matches a row several times."""
    state = [dict(t) for t in target]
    for name in BRANCHES:
        source = []
        for w in wide:
            r = {"TYP": w[f"{name} Code"], "REQ_BY": w[f"{name} When"], "DLVRY_DESC": w[f"{name} Description"], "SRC_YR": w["Year"]}
            if name == K.HOLIDAY:
                if None in (r["TYP"], r["REQ_BY"]) or "n/a" in (r["TYP"], r["REQ_BY"]):
                    continue
                r |= {"FRM_DT": None, "TO_DT": None}
            else:
                r |= {"FRM_DT": w[f"{name} Start"], "TO_DT": w[f"{name} End"]}
            source.append(r)
        known = list(state)
        for t in known:
            hits = [s for s in source if None not in (s["TYP"], s["REQ_BY"]) and (s["TYP"], s["REQ_BY"]) == (t["TYP"], t["REQ_BY"])]
            if len(hits) > 1:
                return None
            for s in hits:
                t.update({c: s[c] for c in ("DLVRY_DESC", "FRM_DT", "TO_DT")}, ROW="new")
        keys = {(t["TYP"], t["REQ_BY"]) for t in known}
        state += [{**s, "ROW": "new"} for s in source if None in (s["TYP"], s["REQ_BY"]) or (s["TYP"], s["REQ_BY"]) not in keys]
    return state


def wide_columns():
    columns = ["Year"]
    for name in BRANCHES:
        parts = ("When", "Code", "Description") if name == K.HOLIDAY else ("When", "Code", "Description", "Start", "End")
        columns += [f"{name} {p}" for p in parts]
    return columns


TARGET = "REQ_BY string, TYP string, DLVRY_DESC string, FRM_DT string, TO_DT string, SRC_YR string, ROW_INSERT_DTM timestamp_ntz"


def test_delivery_merges_against_python(spark):
    rng = random.Random(11)
    outcomes = set()
    for _ in range(14):
        domain = rng.choice([3, 40])

        def key():
            return rng.choice([None, "n/a", *[f"k{i}" for i in range(domain)]])

        wide = [{c: key() if c.endswith(("When", "Code")) else f"{c}{rng.randrange(9)}" for c in wide_columns()} for _ in range(4)]
        target = [
            {"REQ_BY": f"k{i}", "TYP": f"k{rng.randrange(3)}", "DLVRY_DESC": "d", "FRM_DT": "f", "TO_DT": "t", "SRC_YR": "0", "ROW": "old"}
            for i in range(3)
        ]
        want = python_deliveries(target, wide)
        wide_df = spark.createDataFrame([tuple(w[c] for c in wide_columns()) for w in wide], ", ".join(f"`{c}` string" for c in wide_columns()))
        names = ["REQ_BY", "TYP", "DLVRY_DESC", "FRM_DT", "TO_DT", "SRC_YR"]
        old, new = D(2024, 1, 1), D(2024, 1, 2)
        target_df = spark.createDataFrame([(*(t[n] for n in names), old) for t in target], TARGET)
        if want is None:
            outcomes.add("error")
            with pytest.raises(ValueError):
                K.merge_deliveries(target_df, wide_df, new)
            continue
        outcomes.add("state")
        expected = sorted([(*(t[n] for n in names), old if t["ROW"] == "old" else new) for t in want], key=repr)
        assert rows_of(K.merge_deliveries(target_df, wide_df, new)) == expected
    assert outcomes == {"error", "state"}


def test_week_merge_and_reload(spark):
    wide = spark.createDataFrame([("2024", "1", "a", "b"), ("2024", "2", "c", "d"), (None, "3", "e", "f")], "Year string, `Week Id` string, Start string, End string")
    target = spark.createDataFrame([("2024", "1", "x", "y", D(2023, 1, 1)), ("2023", "52", "x", "y", D(2023, 1, 1))], "YR string, WK string, BILL_PD_START_DT string, BILL_PD_END_DT string, ROW_INSERT_DTM timestamp_ntz")
    once = K.merge_weeks(target, wide, D(2024, 1, 1))
    assert rows_of(once.select("YR", "WK", "BILL_PD_START_DT")) == [("2023", "52", "x"), ("2024", "1", "a"), ("2024", "2", "c"), (None, "3", "e")]
    # A NULL key never matches: the same file adds that row again.
    assert K.merge_weeks(once, wide, D(2024, 1, 1)).count() == once.count() + 1


def test_business_days_against_python(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(400) if i % 7 != 3]
    calendar = [(d, int(d.weekday() < 5 and d.day != 26)) for d in days]
    calendar += [(days[0], 0), (days[4], 1)]
    cal = spark.createDataFrame(calendar, "DT_CAL_DATE date, VIC_BD_IND int")
    rng = random.Random(3)
    pairs = [(dt.date(2023, 12, 1) + dt.timedelta(rng.randrange(500)), dt.date(2023, 12, 1) + dt.timedelta(rng.randrange(500))) for _ in range(300)]
    pairs += [(None, days[9]), (days[9], None), (None, None), (dt.date(1900, 1, 1), dt.date(2300, 1, 1)), (dt.date(1900, 1, 1), dt.date(1901, 1, 1))]
    open_days = {d for d, flag in calendar if flag}
    df = spark.createDataFrame(pairs, "a date, b date")
    got = K.with_business_days(df, "a", "b", cal).collect()
    for r in got:
        want = sum(r.a <= d <= r.b for d in open_days) if r.a and r.b else 0
        assert r.businessdays == want, r
    assert len(got) == len(pairs)


def test_business_days_plan_has_no_shuffle_of_the_facts(spark, plan_of):
    cal = spark.range(100).selectExpr("date_add(date'2024-01-01', int(id)) AS DT_CAL_DATE", "1 AS VIC_BD_IND")
    facts = spark.range(1000).selectExpr("date_add(date'2024-01-01', int(id % 50)) AS a", "date'2024-03-01' AS b")
    plan = plan_of(K.with_business_days(facts, "a", "b", cal))
    top = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in top and "NestedLoop" not in plan and "Cartesian" not in plan
