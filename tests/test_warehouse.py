import datetime as dt

import pytest
from pyspark.sql import functions as F

from keystrata.plans.contracts import CONTRACTS, conform, create_table, violations, with_surrogate_keys
from keystrata.plans.template import job_params, render, run_date, run_sql, run_sql_file
from keystrata.plans.views import VIEWS
from keystrata.plans.warehouse import long_texts, to_warehouse, write_staging
from tests.test_hashing import sha

D = dt.datetime
TODAY = dt.date(2024, 2, 28)


def test_render():
    assert render("SELECT '{x}' FROM im${env}_a.T;\n", {"env": "dev"}) == "SELECT '{x}' FROM imdev_a.T"
    with pytest.raises(KeyError, match="other"):
        render("${other}", {})


def test_run_date_and_params():
    assert run_date("1900-01-01", TODAY) == "2024-02-29" and run_date("2024-01-01", TODAY) == "2024-01-01"
    settings = {"LogicalEnv": "dev", "filter_hour": "5", "SqlParams": '{"run_date": "x", "k": 1}'}
    assert job_params(settings, "1900-01-01", TODAY) == {"logicalenv": "dev", "run_date": "x", "filter_hour": "5", "k": 1}
    assert job_params({"LogicalEnv": "dev"}, "1900-01-01", TODAY, migration=False)["run_date"] == "1900-01-01"


def test_templates_run_over_the_vault(spark, lake, tmp_path):
    lake.create("HUB_X", "HUB_X_HSH_KEY string, X string")
    lake.append("HUB_X", spark.createDataFrame([("h", "1"), ("g", "2")], "HUB_X_HSH_KEY string, X string"))
    path = tmp_path / "q.sql"
    path.write_text("/* top */\n-- note\nSELECT X, '${run_date}' AS d\nFROM IM${logicalenv}_RAWVAULT.HUB_X\nWHERE X = :x;")
    params = job_params({"LogicalEnv": lake.env}, "2024-01-01", TODAY)
    assert run_sql_file(spark, str(path), params, x="1").collect() == [("1", "2024-01-01")]
    assert run_sql(spark, "SELECT 1 AS a;").head().a == 1


def test_staging(spark, lake, tmp_path):
    path = tmp_path / "q.sql"
    path.write_text("SELECT id AS K, cast(id AS string) AS V, current_date() AS RUN_DTM FROM range(10);")
    settings = {"LogicalEnv": lake.env, "SqlFilePath": str(path), "StagingTable": "STG", "BusinessKeys": "K"}
    for _ in range(2):
        to_warehouse(lake, settings, "1900-01-01", TODAY, buckets=4)
    rows = lake.read("STG", "dimlayer")
    assert rows.count() == 10 and rows.filter("K = 3").head().HSH_DIFF == sha("3:3:")
    extended = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {lake.name('STG', 'dimlayer')}").collect()}
    assert extended["Num Buckets"] == "4" and extended["Bucket Columns"] == "[`HSH_KEY`]"
    write_staging(lake, "PLAIN", spark.range(3))
    assert lake.read("PLAIN", "dimlayer").columns == ["id"]


def test_bucketed_staging_joins_without_shuffle(spark, lake, plan_of):
    for name in ("A", "B"):
        write_staging(lake, name, spark.range(50).select(F.col("id").alias("K")), "K", buckets=4)
    a, b = lake.read("A", "dimlayer"), lake.read("B", "dimlayer")
    plan = plan_of(a.hint("merge").join(b, "HSH_KEY"))
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_long_texts_are_refused(spark, lake):
    df = spark.createDataFrame([("a", "x" * 2001), ("b", "y" * 2000), ("c", None)], "K string, V string")
    assert [(r.K, r.long_columns) for r in long_texts(df).collect()] == [("a", ["V"])]
    with pytest.raises(Exception, match="V: text of more than 2000"):
        write_staging(lake, "STG", df, "K")
    assert not lake.exists("STG", "dimlayer")
    write_staging(lake, "STG", df.filter("K <> 'a'"), "K")
    assert lake.read("STG", "dimlayer").count() == 2


def test_contracts():
    sizes = {n: len(c.fields) for n, c in CONTRACTS.items()}
    assert sizes == {
        "DIM_CONNECTION_POINT_DEVICE": 14, "DIM_METER": 35, "DIM_CONNECTION_POINT": 59, "FACT_SERVICE_ORDER": 125,
        "DIM_CUSTOMER": 40, "DIM_MESH_NETWORK_DEVICE": 40, "DIM_METER_CONFIG": 33,
    }
    for contract in CONTRACTS.values():
        assert contract.distribution in contract.schema.names and len(set(contract.schema.names)) == len(contract.fields)
    fields = {f.name: f for f in CONTRACTS["DIM_MESH_NETWORK_DEVICE"].fields}
    assert fields["SUSPECT_REASON"].length == 4000 and fields["NET_DEVICE_ID"].required and fields["SEGMENT_ID"].declared == "bigint"


@pytest.mark.parametrize("name", CONTRACTS)
def test_contract_tables(spark, lake, name):
    contract = CONTRACTS[name]
    create_table(lake, contract, buckets=2)
    create_table(lake, contract)
    lake.append(name, conform(spark.range(2), contract), "dimlayer")
    table = lake.read(name, "dimlayer")
    assert table.count() == 2 and table.schema.names == contract.schema.names


def test_conform_and_violations(spark):
    contract = CONTRACTS["DIM_CONNECTION_POINT_DEVICE"]
    df = spark.createDataFrame(
        [("N1", "2024-01-02", "Y", "2024-01-02 03:04:05.9", "k"), (None, "bad", "long", "bad", "k" * 600)],
        "NMI string, INSTALLED_ON_DT string, CURRENT_RECORD_FLAG string, ROW_EFFECTIVE_DTM string, HSH_KEY string",
    )
    good, bad = conform(df, contract).collect()
    assert (good.INSTALLED_ON_DT, good.ROW_EFFECTIVE_DTM) == (dt.date(2024, 1, 2), D(2024, 1, 2, 3, 4, 6))
    assert (bad.INSTALLED_ON_DT, bad.ROW_EFFECTIVE_DTM) == (None, None)
    found = {(r.column_name, r.rule): r.row_count for r in violations(conform(df, contract), contract).collect()}
    assert found == {
        ("NMI", "not null"): 1, ("CURRENT_RECORD_FLAG", "varchar(1)"): 1, ("ROW_EFFECTIVE_DTM", "not null"): 1,
        ("ROW_EXPIRATION_DTM", "not null"): 2, ("HSH_KEY", "varchar(512)"): 1, ("HSH_DIFF", "not null"): 2,
        ("RECORD_INSERT_DTM", "not null"): 2, ("RECORD_UPDATE_DTM", "not null"): 2,
    }


def test_surrogate_keys(spark):
    rows = spark.range(2000).select(F.sha1(F.col("id").cast("string").cast("binary")).alias("HSH_KEY"))
    numbered = with_surrogate_keys(rows, "SK", last=10).orderBy("SK").collect()
    assert [r.SK for r in numbered] == list(range(11, 2011))
    assert [r.HSH_KEY for r in numbered] == sorted(r.HSH_KEY for r in numbered)


def test_surrogate_keys_with_null_and_equal_keys(spark):
    rows = spark.range(1000).selectExpr("id", "case when id % 3 = 0 then null when id % 3 = 1 then '' else sha1(string(id)) end as HSH_KEY")
    numbered = with_surrogate_keys(rows.repartition(5), "SK").orderBy("SK").collect()
    assert [r.SK for r in numbered] == list(range(1, 1001))
    assert [r.HSH_KEY for r in numbered] == sorted((r.HSH_KEY for r in numbered), key=lambda k: (k is not None, k or ""))
    assert with_surrogate_keys(rows.limit(0), "SK").collect() == []


def test_what_cannot_be_converted_is_reported(spark):
    df = spark.createDataFrame([("2024-01-02",), ("not a date",), (None,)], "INSTALLED_ON_DT string")
    found = {(r.column_name, r.rule): r.row_count for r in violations(df, CONTRACTS["DIM_CONNECTION_POINT_DEVICE"]).collect()}
    assert found[("INSTALLED_ON_DT", "not convertible")] == 1


def test_view_names_are_complete():
    assert len(VIEWS) == 9
