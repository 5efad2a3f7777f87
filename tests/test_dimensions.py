"""Type 2 dimensions against a row-at-a-time statement of the same rules."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from keystrata.plans.contracts import CONTRACTS
from keystrata.plans.dimensions import NO_END, Applied, as_of, batch_versions, create_dimension, dimension_rows, scd2_apply, stored_versions

CONTRACT = CONTRACTS["DIM_CUSTOMER"]
DAY = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def frame(spark, rows):
    """Rows (key, day or None, contents)."""
    rows = [(k, DAY(t) if t is not None else None, v, v) for k, t, v in rows]
    return spark.createDataFrame(rows, "HSH_KEY string, ROW_EFFECTIVE_DTM timestamp_ntz, FIRST_NAME string, HSH_DIFF string")


def simulated(state, batch, load):
    """state: {(key, start): [contents, number, inserted, updated]}; one load as the rules say."""
    last = max((r[1] for r in state.values()), default=0)
    batch = {(k, DAY(t) if t is not None else load): v for k, t, v in batch}
    new = {}
    for key in {k for k, _ in batch}:
        chain = {s: r[0] for (k, s), r in state.items() if k == key}
        for (k, s), v in batch.items():
            if k == key and s in chain and chain[s] != v:
                state[k, s][0], state[k, s][3] = v, load
        merged = chain | {s: v for (k, s), v in batch.items() if k == key}
        before = None
        for s in sorted(merged):
            if s not in chain and merged[s] != before:
                new[key, s] = merged[s]
            before = merged[s]
    for n, place in enumerate(sorted(new), start=1):
        state[place] = [new[place], last + n, load, load]
    return state


def ends(state):
    out = {}
    for k, s in state:
        out[k, s] = min((t for j, t in state if j == k and t > s), default=NO_END)
    return out


def stored(lake):
    rows = dimension_rows(lake, CONTRACT).collect()
    assert all((r.CURRENT_RECORD_FLAG == "Y") == (r.ROW_EXPIRATION_DTM == NO_END) for r in rows)
    assert len({r.CUSTOMER_SK for r in rows}) == len(rows)
    return {(r.HSH_KEY, r.ROW_EFFECTIVE_DTM): (r.FIRST_NAME, r.CUSTOMER_SK, r.RECORD_INSERT_DTM, r.HSH_DIFF, r.ROW_EXPIRATION_DTM) for r in rows}


@pytest.mark.parametrize("seed", range(2))
def test_loads_against_the_rules(spark, lake, seed):
    rng = random.Random(seed)
    create_dimension(lake, CONTRACT)
    state = {}
    for n in range(3):
        batch = list({(k, t): (k, t, v) for k, t, v in ((rng.choice("abcd") if rng.random() < 0.7 else "hot", rng.randrange(12), rng.choice("xyz")) for _ in range(14))}.values())
        load = DAY(100 + n)
        scd2_apply(lake, CONTRACT, frame(spark, batch), load)
        simulated(state, batch, load)
        end = ends(state)
        assert stored(lake) == {p: (r[0], r[1], r[2], r[0], end[p]) for p, r in state.items()}
        assert scd2_apply(lake, CONTRACT, frame(spark, batch), load) == Applied()


def test_several_versions_in_one_batch_and_late_ones(spark, lake):
    create_dimension(lake, CONTRACT)
    assert scd2_apply(lake, CONTRACT, frame(spark, [("a", 1, "x"), ("a", 3, "x"), ("a", 5, "y"), ("b", 2, "x")]), DAY(50)) == Applied(3, 0)
    assert {(k, s.day): (r[0], r[4]) for (k, s), r in stored(lake).items()} == {("a", 2): ("x", DAY(5)), ("a", 6): ("y", NO_END), ("b", 3): ("x", NO_END)}
    # A late version splits a closed one; one before the first and one that repeats its predecessor.
    assert scd2_apply(lake, CONTRACT, frame(spark, [("a", 3, "z"), ("a", 0, "w"), ("b", 7, "x")]), DAY(51)) == Applied(2, 1)
    assert {s.day: (r[0], r[4]) for (k, s), r in stored(lake).items() if k == "a"} == {1: ("w", DAY(1)), 2: ("x", DAY(3)), 4: ("z", DAY(5)), 6: ("y", NO_END)}
    at = {r.HSH_KEY: r.FIRST_NAME for r in as_of(dimension_rows(lake, CONTRACT), DAY(4)).collect()}
    assert at == {"a": "z", "b": "x"}


def test_corrections_and_missing_starts(spark, lake):
    create_dimension(lake, CONTRACT)
    scd2_apply(lake, CONTRACT, frame(spark, [("a", 1, "x"), ("a", 5, "y"), ("c", None, "n")]), DAY(50))
    assert scd2_apply(lake, CONTRACT, frame(spark, [("a", 1, "v"), ("a", 5, "u")]), DAY(51)) == Applied(0, 2)
    found = stored(lake)
    assert found["a", DAY(1)][:3] == ("v", 1, DAY(50)) and found["a", DAY(5)][0] == "u" and found["c", DAY(50)][0] == "n"


def test_closed_partitions_stay_and_are_not_read(spark, lake, plan_of):
    create_dimension(lake, CONTRACT)
    for n, batch in enumerate([[("a", 1, "x"), ("b", 1, "x")], [("a", 2, "y")], [("b", 3, "y")]]):
        scd2_apply(lake, CONTRACT, frame(spark, batch), DAY(50 + n))
    place = lambda: {r[0]: r[1] for r in lake.read(CONTRACT.table, "dimlayer").select("CLOSED_BY", F.input_file_name()).distinct().collect()}
    before = place()
    assert set(before) == {"open", "2024-02-21 00:00:00", "2024-02-22 00:00:00"}
    scd2_apply(lake, CONTRACT, frame(spark, [("a", 4, "z")]), DAY(53))
    after = place()
    assert all(after[k] == f for k, f in before.items() if k != "open") and after["open"] != before["open"]
    scd2_apply(lake, CONTRACT, frame(spark, [("b", 2, "w")]), DAY(54))  # late: within what the third load closed
    last = place()
    assert last["2024-02-21 00:00:00"] == after["2024-02-21 00:00:00"] and last["2024-02-22 00:00:00"] != after["2024-02-22 00:00:00"]
    assert last["open"] == after["open"]


def test_versions_without_key_are_refused(spark, lake):
    create_dimension(lake, CONTRACT)
    with pytest.raises(ValueError):
        scd2_apply(lake, CONTRACT, frame(spark, [(None, 1, "x")]), DAY(1))
    assert scd2_apply(lake, CONTRACT, frame(spark, []), DAY(1)) == Applied()


@pytest.mark.parametrize("name", ["DIM_CONNECTION_POINT_DEVICE", "DIM_MESH_NETWORK_DEVICE"])
def test_dimensions_that_allow_no_null(spark, lake, name):
    contract = CONTRACTS[name]
    create_dimension(lake, contract)
    batch = frame(spark, [("a", 1, "x"), ("a", 2, "y")])
    assert scd2_apply(lake, contract, batch, DAY(9)) == Applied(2, 0)
    rows = dimension_rows(lake, contract)
    assert rows.columns == [f.name for f in contract.fields] and rows.count() == 2
    required = [f.name for f in contract.fields if f.required and f.name.startswith(("ROW_", "RECORD_", "CURRENT", "HSH", contract.identity or "-"))]
    assert rows.na.drop(subset=required).count() == 2


def test_keys_of_a_large_batch_are_not_broadcast(spark, lake, plan_of):
    create_dimension(lake, CONTRACT)
    days = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    batch = spark.range(20_000).select(F.sha1(F.col("id").cast("string")).alias("HSH_KEY"), days.alias("ROW_EFFECTIVE_DTM"), F.sha1(F.lit("x")).alias("HSH_DIFF"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200KB")  # the keys alone take 800
    try:
        versions = batch_versions(batch, CONTRACT, DAY(1))
        plan = plan_of(stored_versions(lake.read(CONTRACT.table, "dimlayer"), versions))
        assert scd2_apply(lake, CONTRACT, batch, DAY(1)) == Applied(added=20_000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" not in plan
