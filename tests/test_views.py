"""Current views against a plain Python statement of the same rules."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from keystrata.catalogue import QUERIES
from keystrata.operators.latest import Hub, ViewShape, current_view, latest_by, latest_transaction, one_per_key
from keystrata.plans.views import VIEWS, register_views

D = dt.datetime
TIMES = {"EXTRACT_DATE_TIME", "LOAD_DATE_TIME"}


def satellite_schema(view):
    hub_columns = {c for columns in view.hubs.values() for c in columns}
    names = [c for c in view.shape.output if c not in hub_columns]
    names += [k for k in view.shape.version_keys if k not in names and k not in hub_columns and k not in hub_keys(view)]
    kinds = {c: "timestamp_ntz" for c in (*TIMES, *view.shape.local_columns)}
    return {n: kinds.get(n, "string") for n in names}


def hub_keys(view):
    return [f"{t}_HSH_KEY" for t in view.hubs]


def sample(view, seed):
    """Random hubs, link and satellite rows: few keys, many versions, gaps in the hubs, unique extract times."""
    rng = random.Random(seed)
    hubs = {t: [{f"{t}_HSH_KEY": f"{t}{i}", **{c: f"{c}{i}" for c in cols}} for i in range(4) if i or rng.random() < 0.5] for t, cols in view.hubs.items()}
    links = []
    if view.link:
        links = [{view.link_key: f"L{i}", **{k: f"{k[:-8]}{rng.randrange(4)}" for k in hub_keys(view)}} for i in range(8)]
    schema, rows = satellite_schema(view), []
    for i in range(120):
        row = {n: None if rng.random() < 0.1 else f"v{rng.randrange(2)}" for n in schema}
        row["EXTRACT_DATE_TIME"] = D(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(10**6) * 200 + i)
        row["LOAD_DATE_TIME"] = D(2024, 2, 1)
        for c in view.shape.local_columns:
            row[c] = None if rng.random() < 0.1 else D(2024, 1, 1, rng.randrange(24))
        row[view.shape.change_column] = rng.choice(["I", "U", "D", None])
        if view.link:
            row[view.link_key] = f"L{rng.randrange(9)}"
        else:
            row[hub_keys(view)[0]] = f"{next(iter(view.hubs))}{rng.randrange(4)}"
        rows.append(row)
    return hubs, links, rows


def expected(view, hubs, links, rows):
    shape = view.shape

    def join(row):
        if view.link:
            link = next((x for x in links if x[view.link_key] == row[view.link_key]), None)
            if link is None:
                return None
            row = {**row, **link}
        for table, members in hubs.items():
            key = f"{table}_HSH_KEY"
            member = next((m for m in members if m[key] == row[key]), None)
            if member is None:
                return None
            row = {**row, **member}
        return row

    def newest(candidates):
        best = {}
        for row in candidates:
            key = tuple(row[k] for k in shape.version_keys)
            if key not in best or row["EXTRACT_DATE_TIME"] > best[key]["EXTRACT_DATE_TIME"]:
                best[key] = row
        return best.values()

    if shape.ranked == "before join":
        result = [join(r) for r in newest(rows)]
    else:
        result = newest([j for j in map(join, rows) if j])
    result = [r for r in result if r and r[shape.change_column] not in (None, "D")]
    for row in result:
        for c in shape.local_columns:
            row[c] = row[c] and row[c] + dt.timedelta(hours=11)
    return sorted(repr([r[c] for c in shape.output]) for r in result)


@pytest.mark.parametrize("name", VIEWS)
def test_named_view(spark, lake, name):
    view = VIEWS[name]
    hubs, links, rows = sample(view, name)
    for table, members in hubs.items():
        names = [f"{table}_HSH_KEY", *view.hubs[table]]
        lake.create(table, ", ".join(f"{n} string" for n in names) + ", LOAD_DATE_TIME timestamp_ntz")
        frame = spark.createDataFrame([tuple(m[n] for n in names) for m in members], ", ".join(f"{n} string" for n in names))
        lake.append(table, frame.withColumn("LOAD_DATE_TIME", F.lit("2024-01-01").cast("timestamp_ntz")))
    if view.link:
        names = [view.link_key, *hub_keys(view)]
        ddl = ", ".join(f"{n} string" for n in names)
        lake.create(view.link, ddl)
        lake.append(view.link, spark.createDataFrame([tuple(x[n] for n in names) for x in links], ddl))
    schema = satellite_schema(view)
    ddl = ", ".join(f"{n} {t}" for n, t in schema.items())
    lake.create(view.satellite, ddl)
    lake.append(view.satellite, spark.createDataFrame([tuple(r[n] for n in schema) for r in rows], ddl))

    assert register_views(lake) == [name]
    got = spark.table(name)
    assert got.columns == list(view.shape.output)
    want = expected(view, hubs, links, rows)
    assert want and sorted(repr([r[c] for c in got.columns]) for r in got.collect()) == want


def test_ranking_place_matters(spark):
    sat = spark.createDataFrame(
        [("h1", "a", D(2024, 1, 1), "I"), ("h9", "a", D(2024, 1, 2), "I")],
        "HUB_X_HSH_KEY string, ALIAS string, EXTRACT_DATE_TIME timestamp_ntz, CHANGE_TYPE string",
    )
    hub = Hub(spark.createDataFrame([("h1", "x1")], "HUB_X_HSH_KEY string, X string"), "HUB_X_HSH_KEY", ("X",))
    output = ("X", "ALIAS", "EXTRACT_DATE_TIME")
    before = current_view(sat, [hub], ViewShape(("ALIAS",), output))
    after = current_view(sat, [hub], ViewShape(("ALIAS",), output, ranked="after join"))
    assert before.count() == 0
    assert after.collect() == [("x1", "a", D(2024, 1, 1))]
    with pytest.raises(ValueError):
        ViewShape(("ALIAS",), output, ranked="later")


def test_ties_do_not_depend_on_row_order(spark):
    rows = [("k", D(2024, 1, 1), f"v{i}") for i in range(50)]
    schema = "k string, EXTRACT_DATE_TIME timestamp_ntz, v string"
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        results.add(latest_by(spark.createDataFrame(rows, schema).repartition(7), ["k"]).head().v)
    assert results == {"v0"}


def test_one_per_key(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 3), (None, 4)], "k string, v int")
    assert sorted(map(tuple, one_per_key(df, ["k"]).collect()), key=str) == [("a", 1), (None, 3)]
    assert one_per_key(df.select("k"), ["k"]).count() == 2


def test_latest_transaction_orders_sequences_as_numbers(spark):
    t = D(2024, 1, 1)
    rows = [("k", t, "f", "2", "old"), ("k", t, "f", "10", "new"), ("k", t, "g", "1", "other"), ("j", t, "f", "x", "odd")]
    df = spark.createDataFrame(rows, "K string, DM_TIMESTAMP timestamp_ntz, _adfFilePath string, REC_SEQ string, v string")
    assert sorted(r.v for r in latest_transaction(df, ["K"]).collect()) == ["new", "odd", "other"]


def test_view_plan(spark, plan_of):
    sat = spark.range(1000).selectExpr("cast(id % 10 as string) AS HUB_X_HSH_KEY", "timestamp_ntz'2024-01-01' AS EXTRACT_DATE_TIME", "'I' AS CHANGE_TYPE", "id AS unused")
    hub = Hub(spark.range(10).selectExpr("cast(id as string) AS HUB_X_HSH_KEY", "id AS X", "id AS spare"), "HUB_X_HSH_KEY", ("X",))
    plan = plan_of(current_view(sat, [hub], ViewShape(("HUB_X_HSH_KEY",), ("X", "EXTRACT_DATE_TIME"))))
    # One limit before the shuffle and one after it: a hot key crosses the network once per task.
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert "EvalPython" not in plan and "CartesianProduct" not in plan and "spare" not in plan


def test_a_key_with_a_third_of_the_rows(spark):
    rows = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id % 500 AS string) END AS HUB_X_HSH_KEY",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) AS EXTRACT_DATE_TIME",
        "'I' AS CHANGE_TYPE",
        "id AS v",
    )
    hub = Hub(rows.selectExpr("HUB_X_HSH_KEY", "HUB_X_HSH_KEY AS X").distinct(), "HUB_X_HSH_KEY", ("X",))
    want = {r.HUB_X_HSH_KEY: r.v for r in rows.groupBy("HUB_X_HSH_KEY").agg(F.max("v").alias("v")).collect()}
    for place in ("before join", "after join"):
        shape = ViewShape(("HUB_X_HSH_KEY",), ("X", "v"), ranked=place)
        got = current_view(rows, [hub], shape).collect()
        assert {r.X: r.v for r in got} == want and len(got) == len(want) == 501


@pytest.mark.parametrize("name, exchanges", [("current_view_link_5hubs_tz", 4), ("current_view_link_6hubs_8keys", 3), ("current_view_link_3hubs", 3)])
def test_views_of_lines_move_no_hash_keys(spark, plan_of, name, exchanges):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        lines = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001")).splitlines()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert not any("sha1" in line for line in lines[next(i for i, line in enumerate(lines) if "Exchange" in line) :])
    # From the lines up: one exchange for each hub they meet, and one to rank where the last hub's key does not do.
    scan = next(i for i, line in enumerate(lines) if "lineitem.parquet" in line)
    depth, met = lines[scan].index("FileScan"), 0
    for line in reversed(lines[:scan]):
        place = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if place < depth:
            depth, met = place, met + ("Exchange" in line)
    assert met == exchanges
