import datetime as dt

import pytest
from pyspark.sql import functions as F

from keystrata.operators import columns as C
from keystrata.operators.transforms import NAMES, apply_satellite, apply_staging, clean_strings, transform

D = dt.datetime


def one(df, column):
    return [r[column] for r in df.collect()]


def test_raw_type(spark):
    df = spark.createDataFrame([("AAECgP8=",), (None,), ("",)], "c string")
    assert one(transform(df, "TRANSFORM_RAWTYPE", ["c"]), "c") == ["00010280FF", None, ""]


def test_trim_leading_zero(spark):
    df = spark.createDataFrame([("0000",), (" 00120 ",), (None,), ("0a0",), ("",)], "c string")
    assert one(transform(df, "TRANSFORM_TRIM_LEADING_ZERO", ["c"]), "c") == ["", "120", "", "a0", ""]


def test_trim_decimal(spark):
    df = spark.createDataFrame([("12.50.3",), ("12",), (None,), (".5",)], "c string")
    assert one(transform(df, "TRANSFORM_TRIM_DECIMAL", ["c"]), "c") == ["12", "12", None, ""]


def test_checksum_uses_the_original_value_twice(spark):
    df = spark.createDataFrame([("ABCDEFGHIJ",)], "c string")
    row = transform(df, "TRANSFORM_CHECKSUM", {"c": {"targetcolumn": "t", "checksuminit": 10, "init": 1, "length": 9}}).head()
    assert (row.t, row.c) == ("J", "ABCDEFGHI")


def test_substring_positions(spark):
    df = spark.createDataFrame([("abcdef",)], "c string")
    for init, expected in ((1, "abc"), (0, "abc"), (-2, "ef")):
        spec = {"c": {"targetcolumn": "t", "init": init, "length": 3}}
        assert transform(df, "TRANSFORM_SUBSTRING", spec).head().t == expected


def test_regexp(spark):
    df = spark.createDataFrame([("a12b345",), ("none",), (None,)], "c string")
    assert one(transform(df, "TRANSFORM_REGEXP", {"c": {"targetcolumn": "t", "pattern": r"(\d+)", "matchGroup": 1}}), "t") == ["12", "", None]
    spec = {"c": {"targetcolumn": "t", "pattern": r"(\d+)", "matchGroup": 1}}
    assert one(transform(df, "TRANSFORM_REGEXP_EXTRACT_ALL", spec), "t") == [["12", "345"], [], None]
    spec["c"]["pattern"] = r"(\\d+)"  # as in a SQL text
    assert one(transform(df, "TRANSFORM_REGEXP_EXTRACT_ALL", spec), "t") == [["12", "345"], [], None]
    spec["c"]["joinAll"] = "Y"
    assert one(transform(df, "TRANSFORM_REGEXP_EXTRACT_ALL", spec), "t") == ["12345", "", None]
    spec["c"]["matchAll"] = "Y"
    assert one(transform(df, "TRANSFORM_PARSE_FILEDATE", spec), "t") == ["12345", "", None]


def test_prefix(spark):
    df = spark.createDataFrame([("NEM12345",)], "c string")
    row = transform(df, "TRANSFORM_PREFIX", {"c": {"targetcolumn": "t", "init": 1, "length": 3, "prefix_init": 4, "pos": 3}}).head()
    assert (row.t, row.c) == ("NEM", "12345")


def test_partitions(spark):
    df = spark.createDataFrame([(D(2024, 1, 2, 3, 4, 5),)], "EXTRACT_DATE_TIME timestamp_ntz")
    row = transform(df, "TRANSFORM_HOURLY_PARTITION", []).head()
    assert (row.Extract_hour, row.EXTRACT_DATE_PARTITION) == (3, D(2024, 1, 2, 3))
    row = transform(df, "TRANSFORM_PARTITION_COL", ["P"]).head()
    assert (row.P, row.temp_extract_date_partition) == (D(2024, 1, 2), dt.date(2024, 1, 2))
    assert transform(df, "TRANSFORM_DEFAULT_PARTITION", ["P"]).head().P is None


def test_default_partition_wins_over_partition(spark):
    df = spark.createDataFrame([(D(2024, 1, 2), "n")], "EXTRACT_DATE_TIME timestamp_ntz, NAME string")
    settings = {"TRANSFORM_PARTITION_COL": ["P"], "TRANSFORM_DEFAULT_PARTITION": ["P"], "TRANSFORM_PII": {"NAME": "***"}}
    row = apply_satellite(df, settings).head()
    assert row.P is None and row.NAME == "***"


def test_clean_strings_skips_named_columns(spark):
    escaped = "a\\,b"
    df = spark.createDataFrame([(escaped,) * 5 + (1,)], "t string, CHANGETYPE string, MANDT string, CLIENT string, CLIENT_X string, n int")
    assert tuple(clean_strings(df).head()) == ("a,b", escaped, escaped, escaped, "a,b", 1)


def test_no_python_in_transforms(spark, plan_of):
    df = spark.createDataFrame([("x",)], "c string").withColumn("n", F.lit(1))
    assert "EvalPython" not in plan_of(apply_staging(df, {"TRANSFORM_RAWTYPE": ["c"]}))


def test_unknown_transform(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="unknown"):
        transform(df, "TRANSFORM_HUB_KEY", ["c"])
    with pytest.raises(ValueError, match="TRANSFORM_OTHER"):
        apply_staging(df, {"TRANSFORM_OTHER": ["c"]})
    assert len(NAMES) == 13


def test_rename_by_position(spark):
    df = spark.createDataFrame([(1, 2)], "Prop_0 int, Prop_1 int")
    assert C.rename_by_position(df, ["A", "B", "C"]).columns == ["A", "B"]
    with pytest.raises(ValueError):
        C.rename_by_position(df, ["A"])


def test_change_type_filters(spark):
    df = spark.createDataFrame([("I",), ("U",), ("B",), ("D",), (None,)], "CHANGE_TYPE string")
    assert sorted(one(C.drop_before_images(df), "CHANGE_TYPE")) == ["D", "I", "U"]
    assert sorted(one(C.drop_deleted(df), "CHANGE_TYPE")) == ["B", "I", "U"]


def test_require(spark):
    df = spark.createDataFrame([("a", "b"), ("n/a", "b"), ("a", "n/a"), (None, "b"), ("a", None)], "x string, y string")
    assert C.require(df, ["x", "y"], "n/a").collect() == [("a", "b")]


def test_subset_uses_the_first_split_column(spark):
    df = spark.createDataFrame([("IS2", 1), ("003", 2), (None, 3)], "KLART string, n int")
    split = {"KLART": {"HUB_EQUIPMENT": "IS2", "HUB_MATERIAL": "003"}, "n": {"HUB_EQUIPMENT": 9}}
    assert one(C.subset_for(df, split, "HUB_EQUIPMENT"), "n") == [1]
    assert C.subset_for(df, split, "HUB_OTHER").count() == 3


def test_metadata(spark):
    df = spark.createDataFrame([("f1", D(2024, 1, 1))], "_srcFileName string, DM_TIMESTAMP timestamp_ntz")
    row = C.delta_metadata(df, "SRC", D(2024, 5, 5)).head()
    assert (row.RECORD_SOURCE, row.LOAD_DATE_TIME, row.EXTRACT_DATE_TIME) == ("SRC", D(2024, 5, 5), D(2024, 1, 1))
    row = C.replicated_history_metadata(df, "2024-05-05 00:00:00", None).head()
    assert (row.RECORD_SOURCE, row.CHANGE_TYPE, row.EXTRACT_DATE_TIME) == ("f1", "I", D(2024, 1, 1))
    assert C.fill_missing(df, "A, B").head().B == 0
    assert "CLIENT_ID" not in C.with_client_id(df, {"Hub_1_Name": "HUB_NMI"}).columns
    assert C.with_client_id(df, {"Hub_1_Name": "HUB_EQUIPMENT"}).head().CLIENT_ID == 100


def test_same_as_mapping(spark):
    df = spark.createDataFrame([("x", "y", "z")], "a string, b string, c string")
    got = C.map_same_as_keys(df, {"a": "K", "b": "K", "c": "L"}, "S").select("K", "L", "RECORD_SOURCE").collect()
    assert sorted(map(tuple, got)) == [("x", "z", "S.c"), ("y", "z", "S.c")]
    got = C.map_same_as_keys(df, {"c": "L", "a": "K", "b": "K"}, "S").select("K", "L", "RECORD_SOURCE").collect()
    assert sorted(map(tuple, got)) == [("x", "z", "S.a"), ("y", "z", "S.b")]
    got = C.map_keys(df, {"a": "K"}, "S").select("K", "RECORD_SOURCE").collect()
    assert got == [("x", "S")]
