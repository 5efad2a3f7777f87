import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from keystrata.plans import vault as V
from keystrata.plans.config import FeedConfig, HubSpec, literal, parameters
from keystrata.sources.files import read_count_log
from keystrata.sources.tables import Lake
from tests.test_hashing import sha

D = dt.datetime
META = "RECORD_SOURCE string, LOAD_DATE_TIME timestamp_ntz"

BASE = {
    "Source": "ERP",
    "TableName": "METERS",
    "RecordSource": "ERP.METERS",
    "Prop_0": "EQUNR",
    "Prop_1": "NMI",
    "Prop_2": "CHANGE_TYPE",
    "Prop_3": "DM_TIMESTAMP",
    "Prop_4": "OWNER",
    "Prop_5": "SIZE",
    "Prop_6": "REC_SEQ",
    "Prop_7": "_adfFilePath",
    "HubCount": "2",
    "Hub_1_Name": "HUB_EQUIP",
    "HUB_1_INFO": '{"HUB_EQUIP": ["EQUIPMENT_ID"], "key_mapping": {"EQUNR": "EQUIPMENT_ID"}}',
    "Hub_2_Name": "HUB_NMI",
    "HUB_2_INFO": '{"HUB_NMI": ["NMI"], "key_mapping": {}}',
    "LinkCount": "1",
    "Link_1_Name": "LINK_EQUIP_NMI",
    "LINK_INFO": '{"LINK_EQUIP_NMI": ["EQUIPMENT_ID",',
    "LINK_INFO_1": ' "NMI"]}',
    "SatCount": "1",
    "Sat_1_Name": "SAT_EQUIP",
    "TRANSFORM_TRIM_LEADING_ZERO": "['EQUNR']",
    "TRANSFORM_PII": '{"OWNER": "***"}',
    "TRANSFORM_PARTITION_COL": '["EXTRACT_DATE_PARTITION"]',
}
SAT = (
    "HUB_EQUIP_HSH_KEY string, SAT_EQUIP_HSH_DIFF string, EXTRACT_DATE_TIME timestamp_ntz, CHANGE_TYPE string, OWNER string,"
    f" SIZE decimal(10,2), EXTRACT_DATE_PARTITION timestamp_ntz, {META}"
)
RAW = "Prop_0 string, Prop_1 string, Prop_2 string, Prop_3 timestamp_ntz, Prop_4 string, Prop_5 decimal(10,2), Prop_6 string, Prop_7 string"


def make_tables(lake):
    lake.create("HUB_EQUIP", f"HUB_EQUIP_HSH_KEY string, EQUIPMENT_ID string, {META}")
    lake.create("HUB_NMI", f"HUB_NMI_HSH_KEY string, NMI string, {META}")
    lake.create("LINK_EQUIP_NMI", f"LINK_EQUIP_NMI_HSH_KEY string, HUB_EQUIP_HSH_KEY string, HUB_NMI_HSH_KEY string, {META}")
    lake.create("SAT_EQUIP", SAT, ["EXTRACT_DATE_PARTITION"])


def raw(spark, *rows):
    from decimal import Decimal

    full = [(e, n, c, t, "Ann", Decimal(s), q, "file1") for e, n, c, t, s, q in rows]
    return spark.createDataFrame(full, RAW)


T1, T2, T3 = D(2024, 1, 1, 5), D(2024, 1, 2, 5), D(2024, 1, 3, 5)


def test_feed_end_to_end(spark, lake):
    make_tables(lake)
    feed = V.VaultFeed(lake, FeedConfig.from_parameters(BASE), D(2024, 2, 1))
    batch = raw(
        spark,
        ("0012", "N1", "I", T1, "1.50", "1"),
        ("12 ", "N1", "U", T2, "2.00", "2"),
        ("12", "N1", "B", T3, "9.00", "3"),
        ("13", "N2", "I", T1, "1.00", "4"),
        (None, "N3", "I", T1, "1.00", "5"),
    )
    feed.run(batch)
    hubs = {r.EQUIPMENT_ID: r.HUB_EQUIP_HSH_KEY for r in lake.read("HUB_EQUIP").collect()}
    assert hubs == {"12": sha("12:"), "13": sha("13:"), "": sha(":")}
    links = {(r.LINK_EQUIP_NMI_HSH_KEY, r.HUB_EQUIP_HSH_KEY, r.HUB_NMI_HSH_KEY) for r in lake.read("LINK_EQUIP_NMI").collect()}
    assert links == {(sha(f"{e}:{n}:"), sha(f"{e}:"), sha(f"{n}:")) for e, n in (("12", "N1"), ("13", "N2"), ("", "N3"))}
    sat = lake.read("SAT_EQUIP")
    assert {r.OWNER for r in sat.collect()} == {"***"} and sat.count() == 4
    row = sat.filter("SIZE = 1.5").head()
    assert row.SAT_EQUIP_HSH_DIFF == sha("2024-01-01 05:00:00:I:***:1.5:")
    assert row.EXTRACT_DATE_PARTITION == D(2024, 1, 1) and row.RECORD_SOURCE == "ERP.METERS"

    before = {t: lake.read(t).count() for t in ("HUB_EQUIP", "HUB_NMI", "LINK_EQUIP_NMI")}
    V.VaultFeed(lake, FeedConfig.from_parameters(BASE), D(2024, 2, 2)).run(batch)
    assert before == {t: lake.read(t).count() for t in before}
    # Only the current version is compared: the older one of equipment 12 comes in again.
    assert lake.read("SAT_EQUIP").count() == 5


def test_feed_compared_within_partitions(spark, lake):
    make_tables(lake)
    extra = {"filter_on_partition_column": json.dumps({"partition_config": [{"partition_column_name": "extract_date_partition", "partition_column_data_type": "timestamp", "partition_column_date_format": "yyyy-MM-dd HH:mm:ss"}]})}
    config = FeedConfig.from_parameters(BASE | extra)
    batch = raw(spark, ("1", "N", "I", T1, "1.00", "1"), ("1", "N", "U", T2, "2.00", "2"))
    for _ in range(2):
        V.VaultFeed(lake, config, D(2024, 2, 1)).run(batch)
    assert lake.read("SAT_EQUIP").count() == 2


def test_cdc_keeps_the_last_record(spark, lake):
    make_tables(lake)
    config = FeedConfig.from_parameters(BASE | {"GENERATE_CDC_SEQNO": "Y", "BUSINESS_KEY": "['EQUNR']"})
    batch = raw(spark, ("1", "N", "I", T1, "1.00", "2"), ("1", "N", "U", T1, "7.00", "10"))
    V.VaultFeed(lake, config, D(2024, 2, 1)).run(batch)
    assert [r.CHANGE_TYPE for r in lake.read("SAT_EQUIP").collect()] == ["U"]


def test_split_by_discriminator(spark, lake):
    make_tables(lake)
    splits = {"SPLIT_HUB": '{"NMI": {"HUB_EQUIP": "N1"}}', "SPLIT_SAT": '{"NMI": {"SAT_EQUIP": "N2"}}'}
    batch = raw(spark, ("1", "N1", "I", T1, "1.00", "1"), ("2", "N2", "I", T1, "1.00", "2"))
    V.VaultFeed(lake, FeedConfig.from_parameters(BASE | splits), D(2024, 2, 1)).run(batch)
    assert [r.EQUIPMENT_ID for r in lake.read("HUB_EQUIP").collect()] == ["1"]
    assert lake.read("HUB_NMI").count() == 2
    assert [r.HUB_EQUIP_HSH_KEY for r in lake.read("SAT_EQUIP").collect()] == [sha("2:")]


def test_history_load_logs_counts(spark, lake, tmp_path):
    make_tables(lake)
    flat = {k: v for k, v in BASE.items() if not k.startswith("Prop")} | {"load_type": "Hist_Data", "BUSINESSPARTITIONDATE": "BUS"}
    staged = spark.createDataFrame(
        [("1", "N1", T1, "o", 1.0, "f1"), ("1", "N1", T1, "o", 1.0, "f1"), ("2", "N1", T2, "o", 1.0, "f2")],
        "EQUNR string, NMI string, BUS timestamp_ntz, OWNER string, SIZE double, _srcFileName string",
    )
    log = str(tmp_path / "log")
    for _ in range(2):
        V.VaultFeed(lake, FeedConfig.from_parameters(flat), D(2024, 2, 1)).run(staged, log)
    # A history load is inserted without comparing, apart from repeats within the batch.
    assert lake.read("SAT_EQUIP").count() == 4
    assert {r.RECORD_SOURCE for r in lake.read("HUB_EQUIP").collect()} == {"f1", "f2"}
    assert sorted(map(tuple, read_count_log(spark, log).collect())) == [("f1", "1"), ("f1", "2"), ("f2", "1"), ("f2", "2")]


def test_file_feed_takes_time_from_the_file_name(spark, lake):
    make_tables(lake)
    flat = {k: v for k, v in BASE.items() if not k.startswith("Prop")}
    flat["TRANSFORM_PARSE_FILEDATE"] = '{"_srcFileName": {"targetcolumn": "tempdate", "pattern": "(\\\\d+)", "matchGroup": 1, "matchAll": "Y", "joinAll": "Y"}}'
    staged = spark.createDataFrame(
        [("1", "N1", "o", 1.0, "x_20240102_030405.parquet")], "EQUNR string, NMI string, OWNER string, SIZE double, _srcFileName string"
    )
    V.VaultFeed(lake, FeedConfig.from_parameters(flat), D(2024, 2, 1)).run(staged)
    row = lake.read("SAT_EQUIP").head()
    assert (row.EXTRACT_DATE_TIME, row.CHANGE_TYPE, row.EXTRACT_DATE_PARTITION) == (D(2024, 1, 2, 3, 4, 5), "I", D(2024, 1, 2))


SAME_AS = {
    "Source": "CRM",
    "TableName": "NAMES",
    "RecordSource": "CRM",
    "HubCount": "1",
    "Hub_1_Name": "HUB_NAME",
    "HUB_1_INFO": '{"HUB_NAME": ["NAME"], "key_mapping": {"OLD": "NAME", "NEW": "NAME"}}',
    "SALINK_HUB_NAME": "HUB_NAME",
    "SAME_AS_LINK": "Y",
    "SA_LINK_NAME": "SALINK_NAME",
    "SALINK_INFO": '{"salink_key_mapping": {"HUB_NAME_HSH_KEY_1": ["OLD"], "HUB_NAME_HSH_KEY_2": ["NEW"]}, "SALINK_NAME": ["HUB_NAME_HSH_KEY_1", "HUB_NAME_HSH_KEY_2"]}',
    "SALINK_KEY_DEF_INFO": '{"salink_key_def_mapping": {"NAME_1_DEF": "OLD", "NAME_2_DEF": "NEW"}}',
    "TRANSFORM_PARSE_FILEDATE": '{"_srcFileName": {"targetcolumn": "tempdate", "pattern": "(.*)", "matchGroup": 1}}',
}


def test_same_as_link(spark, lake):
    lake.create("HUB_NAME", f"HUB_NAME_HSH_KEY string, NAME string, {META}")
    lake.create(
        "SALINK_NAME",
        f"SALINK_NAME_HSH_KEY string, HUB_NAME_HSH_KEY_1 string, HUB_NAME_HSH_KEY_2 string, NAME_1_DEF string, NAME_2_DEF string, {META}",
    )
    staged = spark.createDataFrame([("a", " b", "20240101000000"), ("a", None, "20240101000000")], "OLD string, NEW string, _srcFileName string")
    V.VaultFeed(lake, FeedConfig.from_parameters(SAME_AS), D(2024, 2, 1)).run(staged)
    hub = {(r.HUB_NAME_HSH_KEY, r.RECORD_SOURCE) for r in lake.read("HUB_NAME").collect()}
    # Two rows hash to the same key 'b'; the trimmed spelling counts.
    assert hub == {(sha("a:"), "CRM.OLD"), (sha("b:"), "CRM.NEW"), (sha(":"), "CRM.NEW")}
    links = {tuple(r)[:5] for r in lake.read("SALINK_NAME").collect()}
    raw_b, raw_null = sha(" b:"), sha(":")
    assert links == {
        (sha(f"{sha('a:')}:{raw_b}:"), sha("a:"), raw_b, "OLD", "NEW"),
        (sha(f"{sha('a:')}:{raw_null}:"), sha("a:"), raw_null, "OLD", "NEW"),
    }


@pytest.mark.parametrize("everywhere, expected", [(False, {"a"}), (True, {"a", "b"})])
def test_spellings_reach_links_only_on_request(spark, lake, everywhere, expected):
    lake.create("HUB_NAME", f"HUB_NAME_HSH_KEY string, NAME string, {META}")
    lake.create("LINK_NAME", f"LINK_NAME_HSH_KEY string, NAME string, {META}")
    flat = {k: v for k, v in SAME_AS.items() if not k.startswith("SA_") and k != "SAME_AS_LINK"}
    flat |= {"LinkCount": "1", "Link_1_Name": "LINK_NAME", "LINK_INFO": '{"LINK_NAME": ["NAME"]}'}
    config = FeedConfig.from_parameters(flat)
    if everywhere:
        import dataclasses

        config = dataclasses.replace(config, spellings_everywhere=True)
    staged = spark.createDataFrame([("a", "b", "20240101000000")], "OLD string, NEW string, _srcFileName string")
    V.VaultFeed(lake, config, D(2024, 2, 1)).run(staged)
    assert lake.read("HUB_NAME").count() == 2
    assert {r.NAME for r in lake.read("LINK_NAME").collect()} == expected


def test_hubs_sharing_a_key_column_keep_their_own_hash(spark, lake):
    lake.create("HUB_A", f"HUB_A_HSH_KEY string, KEY string, {META}")
    lake.create("HUB_B", f"HUB_B_HSH_KEY string, KEY string, {META}")
    lake.create("LINK_AB", f"LINK_AB_HSH_KEY string, HUB_A_HSH_KEY string, HUB_B_HSH_KEY string, {META}")
    flat = {
        "Source": "S", "TableName": "T", "RecordSource": "S.T", "HubCount": "2", "Hub_1_Name": "HUB_A", "Hub_2_Name": "HUB_B",
        "HUB_1_INFO": '{"HUB_A": ["KEY"], "key_mapping": {"x": "KEY"}}', "HUB_2_INFO": '{"HUB_B": ["KEY"], "key_mapping": {"y": "KEY"}}',
        "LinkCount": "1", "Link_1_Name": "LINK_AB", "LINK_INFO": '{"LINK_AB": ["x", "y"]}',
    }
    staged = spark.createDataFrame([("1", "2", "20240101000000")], "x string, y string, tempdate string")
    V.VaultFeed(lake, FeedConfig.from_parameters(flat), D(2024, 2, 1)).run(staged)
    link = lake.read("LINK_AB").head()
    assert (link.HUB_A_HSH_KEY, link.HUB_B_HSH_KEY) == (sha("1:"), sha("2:"))


def test_reference_reload(spark, lake, tmp_path):
    lake.create("REF_CODE", f"CODE string, TEXT string, {META}, EXTRACT_DATE_TIME timestamp_ntz")
    flat = {"Source": "S", "TableName": "T", "RecordSource": "S.T", "REFERENCE_TABLE": "Y", "Ref_Name": "REF_CODE", "RefreshExtractTable": "Y", "extract_folder": str(tmp_path / "ext")}
    config = FeedConfig.from_parameters(flat)
    for codes in (["a", "a", "b"], ["c"]):
        staged = spark.createDataFrame([(c, "t", "20240101000000") for c in codes], "CODE string, TEXT string, tempdate string")
        V.VaultFeed(lake, config, D(2024, 2, 1), D(2024, 1, 31)).run(staged)
        assert sorted(r.CODE for r in lake.read("REF_CODE").collect()) == codes
    assert lake.read("REF_CODE").head().EXTRACT_DATE_TIME == D(2024, 1, 31)
    assert spark.read.parquet(str(tmp_path / "ext" / "REF_CODE")).count() == 1


def test_unmapped_columns_stay_null(spark, lake):
    lake.create("SAT_X", f"HUB_X_HSH_KEY string, SAT_X_HSH_DIFF string, SRC_DEVICE_ID string, V string, {META}")
    df = spark.createDataFrame([("h", "v", "r", T1)], f"HUB_X_HSH_KEY string, V string, {META}")
    row = V.satellite_rows(df, lake.read("SAT_X"), ignore=V.UNMAPPED_COLUMNS, direct=True).head()
    assert row.SRC_DEVICE_ID is None and row.SAT_X_HSH_DIFF == sha("v:")


def test_hub_location_override(spark, tmp_path):
    lake = Lake(spark, "dbmnt", str(tmp_path / "a"), {"HUB_X": f"{tmp_path}/b/im"})
    assert lake.folder("HUB_X") == f"{tmp_path}/b/imdbmnt/rawvault/HUB_X"
    lake.create("HUB_X", "k string")
    assert f"{tmp_path}/b/imdbmnt" in spark.sql(f"DESCRIBE EXTENDED {lake.name('HUB_X')}").filter("col_name = 'Location'").head()[1]


def test_repeated_keys_are_dropped_before_hashing(spark, lake, plan_of):
    lake.create("HUB_X", "HUB_X_HSH_KEY string, K string")
    hub = HubSpec("HUB_X", ("K",))
    rows = spark.range(1000).select((F.col("id") % 3).cast("string").alias("K"), "id")
    plan = plan_of(V.key_rows(rows, lake.read("HUB_X"), hub.hash_key, V.hub_hash(hub)))
    # Below the shuffle there is only the map-side aggregation of the plain key.
    below = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "HashAggregate" in below and "sha1" not in below and "EvalPython" not in plan


def test_feed_in_file_batches(spark, lake, tmp_path):
    make_tables(lake)
    files = []
    for i in range(3):
        files.append(str(tmp_path / f"f{i}"))
        raw(spark, (str(i), "N", "I", T1, "1.00", "1"), ("9", "N", "I", T1, "1.00", "1")).write.parquet(files[-1])
    config = FeedConfig.from_parameters(BASE | {"NUMBER_OF_ITER": "2"})
    results = V.VaultFeed(lake, config, D(2024, 2, 1)).run_files(files)
    assert [len(r.files) for r in results] == [2, 1]
    assert sorted(r.EQUIPMENT_ID for r in lake.read("HUB_EQUIP").collect()) == ["", "1", "2", "9"]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("way", [{"direct": True}, {}, {"partition": "DAY"}])
def test_satellite_with_doubles(spark, lake, way, ansi):
    """Spark takes the texts of doubles for not deterministic; loads compare and rank versions by their hash all the same."""
    lake.create("SAT_D", f"D_HSH_KEY string, D_HSH_DIFF string, X double, EXTRACT_DATE_TIME date, DAY date, {META}", ["DAY"])
    batch = lambda *rows: spark.createDataFrame(rows, "D_HSH_KEY string, X double").selectExpr(
        "*", "date'2024-01-01' as EXTRACT_DATE_TIME", "date'2024-01-01' as DAY", "'s' as RECORD_SOURCE", "timestamp_ntz'2024-01-02 00:00:00' as LOAD_DATE_TIME"
    )
    text = lambda x: "None" if x is None else f"{x!r}".removesuffix(".0")
    hashed = lambda *rows: {(k, sha(f"{text(x)}:2024-01-01:2024-01-01:")) for k, x in rows}
    first, second = [("a", 2.0**-44), ("b", 7.0), ("c", None), ("d", 1 / 3)], [("a", 2.0**-44), ("b", 0.1 + 0.2), ("b", 0.1 + 0.2), ("c", 2e-3), ("e", None)]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        lake.append("SAT_D", V.satellite_rows(batch(*first), lake.read("SAT_D"), direct=True))
        assert {(r.D_HSH_KEY, r.D_HSH_DIFF) for r in lake.read("SAT_D").collect()} == hashed(*first)
        found = [(r.D_HSH_KEY, r.D_HSH_DIFF) for r in V.satellite_rows(batch(*second), lake.read("SAT_D"), **way).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert sorted(found) == sorted(hashed(*(second if way.get("direct") else second[1:])))


def test_configuration():
    rows = [{"ParameterCode": k, "ParameterValue": v, "Source": "ERP", "TableName": "T"} for k, v in BASE.items() if k not in ("Source", "TableName")]
    assert parameters(rows)["TableName"] == "T"
    config = FeedConfig.from_rows(rows)
    assert config.names[0] == "EQUNR" and len(config.names) == 8 and config.replicated
    assert config.links[0].columns == ("EQUIPMENT_ID", "NMI")
    assert config.transforms["TRANSFORM_TRIM_LEADING_ZERO"] == ["EQUNR"]
    assert literal("{'a': 1}") == {"a": 1} and literal('["x"]') == ["x"]
    with pytest.raises((ValueError, SyntaxError)):
        literal("__import__('os').getcwd()")
    with pytest.raises(ValueError):
        parameters([])
