import datetime as dt

import pytest
from pyspark.sql import functions as F

from keystrata.functions import times as TM
from keystrata.functions.geo import st_x, st_y
from keystrata.functions.registry import register_business_days, register_functions
from keystrata.functions.text import count_substring, unescape

D = dt.datetime


def test_business_date_forms(spark):
    rows = [("20200101",), ("20200101101112",), ("20200101101112.1234567",), ("2020-01-01",), ("",), (None,)]
    df = spark.createDataFrame(rows, "s string").withColumn("DM_TIMESTAMP", F.lit("1999-09-09 00:00:00"))
    got = [r.m for r in df.select(TM.business_date(df, "s").alias("m")).collect()]
    fallback = D(1999, 9, 9)
    assert got == [D(2020, 1, 1), D(2020, 1, 1, 10, 11, 12), D(2020, 1, 1, 10, 11, 12, 123456), fallback, fallback, fallback]


def test_business_date_by_type(spark):
    df = spark.createDataFrame([(D(2020, 1, 1), 5, D(2021, 1, 1))], "t timestamp_ntz, n int, DM_TIMESTAMP timestamp_ntz")
    assert df.select(TM.business_date(df, "t").alias("m")).head().m == D(2020, 1, 1)
    assert df.select(TM.business_date(df, None).alias("m")).head().m == D(2021, 1, 1)
    with pytest.raises(TypeError):
        TM.business_date(df, "n")


def test_file_dates(spark):
    df = spark.createDataFrame([("ADR2.D2021137.T025235883",), ("ADR2",), ("A.Dxx.T",)], "f string")
    got = df.select(TM.julian_file_date(F.col("f")).alias("d"), TM.archive_folder(F.col("f")).alias("p")).collect()
    assert [(r.d, r.p) for r in got] == [(dt.date(2021, 5, 17), "2021/05/17"), (None, None), (None, None)]
    assert spark.range(1).select(TM.file_time(F.lit("20200229101112")).alias("m")).head().m == D(2020, 2, 29, 10, 11, 12)
    assert spark.range(1).select(TM.file_time(F.lit("20200230101112")).alias("m")).head().m is None


@pytest.mark.parametrize("zone", ["UTC", "Australia/Melbourne", "America/New_York"])
def test_local_time_needs_no_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.sql(
            "SELECT * FROM VALUES (timestamp_ntz'2024-01-01 00:00:00'), (timestamp_ntz'2024-10-05 16:30:00'),"
            " (timestamp_ntz'2024-04-06 18:00:00') AS v(t)"
        )
        got = rows.select(TM.local_time(F.col("t")).alias("a"), TM.local_time_compat(F.col("t")).alias("b")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.a for r in got] == [D(2024, 1, 1, 11), D(2024, 10, 6, 3, 30), D(2024, 4, 7, 4)]
    assert [r.b for r in got] == [D(2024, 1, 1, 11), D(2024, 10, 6, 2, 30), D(2024, 4, 7, 5)]


def test_extract_day_and_hour(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-02 03:04:05.123456",), ("2024-01-02",), ("x",)], "s string")
    kind = df.schema["s"].dataType
    got = df.select(TM.extract_day(F.col("s"), kind).alias("d"), TM.extract_hour_start(F.col("s"), kind).alias("h")).collect()
    assert [r.d for r in got] == [D(2024, 1, 2)] * 3 + [None]
    assert [r.h for r in got] == [D(2024, 1, 2, 3), D(2024, 1, 2, 3), D(2024, 1, 2), None]


def test_count_substring(spark):
    rows = [("abcabcab", "ab", 3), ("aaa", "aa", 1), ("aaa", "", None), (None, "a", None), ("éé", "é", 2), ("abc", "x", 0)]
    df = spark.createDataFrame([r[:2] for r in rows], "t string, s string")
    assert [r.n for r in df.select(count_substring(F.col("t"), F.col("s")).alias("n")).collect()] == [r[2] for r in rows]


def test_unescape(spark):
    df = spark.createDataFrame([("a\\,b\\¿\\¡",), ('q\\"',), (None,), ("\\\\,",)], "t string")
    assert [r.t for r in df.select(unescape(F.col("t")).alias("t")).collect()] == ["a,b¿¡", 'q\\"', None, "\\,"]


def test_projection_points(spark):
    df = spark.createDataFrame([(1e9, 1e9), (996750963.1654, 909712430.0553), (None, 1.0)], "x double, y double")
    got = df.select(st_x("x", "y").alias("x"), st_y("x", "y").alias("y")).collect()
    assert got[0].x == pytest.approx(145, abs=1e-9) and got[0].y == pytest.approx(-37, abs=1e-9)
    assert got[1].x == pytest.approx(144.9631, abs=1e-9) and got[1].y == pytest.approx(-37.8136, abs=1e-9)
    assert got[2].x is None and got[2].y is None


def test_sql_functions(spark, plan_of):
    register_functions(spark)
    df = spark.sql(
        "SELECT st_x(996750963.1654D, 909712430.0553D) AS x, st_y(996750963.1654D, 909712430.0553D) AS y,"
        " fn_get_count_of_substring('abcabcab', 'ab') AS n, fn_get_count_of_substring('a', '') AS z,"
        " convertolocaltime(timestamp_ntz'2024-10-05 16:30:00') AS t"
    )
    row = df.head()
    assert row.x == pytest.approx(144.9631, abs=1e-9) and row.y == pytest.approx(-37.8136, abs=1e-9)
    assert (row.n, row.z, row.t) == (3, None, D(2024, 10, 6, 2, 30))
    assert "EvalPython" not in plan_of(df)


def test_business_day_table_function(spark):
    spark.sql(
        "SELECT d AS DT_CAL_DATE, year(d) * 10000 + month(d) * 100 + day(d) AS DT_DATE_KEY, int(weekday(d) < 5) AS VIC_BD_IND"
        " FROM (SELECT explode(sequence(date'2024-01-01', date'2024-01-31')) AS d)"
    ).createOrReplaceTempView("cal_fn")
    register_business_days(spark, "cal_fn")
    count = lambda a, b: spark.sql(f"SELECT businessdays FROM fn_get_business_days({a}, {b})").head()[0]
    assert count("date'2024-01-01'", "date'2024-01-07'") == 5
    assert count("date'2024-01-07'", "date'2024-01-01'") == 0
    assert count("NULL", "date'2024-01-07'") == 0
    lateral = spark.sql(
        "SELECT k, f.businessdays FROM VALUES (1, date'2024-01-06'), (2, date'2024-01-08') AS v(k, e),"
        " LATERAL fn_get_business_days(date'2024-01-01', e) AS f ORDER BY k"
    )
    assert [r.businessdays for r in lateral.collect()] == [5, 6]
