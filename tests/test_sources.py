import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from keystrata.operators.counts import count_as, count_by, extend_log, reconcile
from keystrata.plans.calendar import DELIVERY_TABLE, WEEK_TABLE, load_calendar
from keystrata.plans.history import CountMismatch, UnfinishedMerge, direct_insert, merge_history
from keystrata.plans.landing import land, staged_lines
from keystrata.session import shared_folder
from keystrata.sources import files as S
from keystrata.sources import jdbc
from tests.test_merge import TARGET, wide_columns

D = dt.datetime


def test_line_numbers_across_splits_and_packed_files(spark, tmp_path):
    for name, count in (("a", 6000), ("b", 3), ("c", 2500), ("empty", 0)):
        (tmp_path / name).write_text("".join(f"{name},{i + 1},\"q,{i}\"\n" for i in range(count)))
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for size in ("20000", "1000000"):
            spark.conf.set(keys[0], size)
            spark.conf.set(keys[1], "0")
            staged = staged_lines(spark, str(tmp_path))
            assert staged.columns == ["Prop_0", "Prop_1", "Prop_2", "Prop_3", "_adfFilePath"]
            assert staged.count() == 8503
            assert staged.filter("Prop_1 <> Prop_3").count() == 0
            assert staged.filter("Prop_2 <> concat('q,', int(Prop_1) - 1)").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_numbering_does_not_shuffle_lines(spark, tmp_path, plan_of):
    (tmp_path / "a").write_text("x\ny\n")
    plan = plan_of(S.numbered_lines(spark, str(tmp_path)))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_numbers_hold_when_splits_change_after_building(spark, tmp_path):
    (tmp_path / "a").write_text("".join(f"{i + 1}\n" for i in range(60_000)))
    (tmp_path / "b").write_text("".join(f"{i + 1}\n" for i in range(9)))
    key = "spark.sql.leafNodeDefaultParallelism"
    try:
        for first, then in (("4", "8"), ("8", "4"), ("4", "6")):
            spark.conf.set(key, first)
            numbered = S.numbered_lines(spark, str(tmp_path))
            spark.conf.set(key, then)
            assert numbered.count() == 60_009
            assert numbered.filter("int(value) <> line").count() == 0
    finally:
        spark.conf.unset(key)


def test_files_of_different_widths_keep_all_fields(spark, tmp_path):
    (tmp_path / "a").write_text("1,a\n2,b\n")
    (tmp_path / "b").write_text('3,"c, d",KEEP\n4\n5,"e, f",g,h\n')
    staged = staged_lines(spark, str(tmp_path))
    assert staged.columns == ["Prop_0", "Prop_1", "Prop_2", "Prop_3", "Prop_4", "_adfFilePath"]
    got = {r.Prop_0: (r.Prop_2, r.Prop_3, r.Prop_4) for r in staged.collect()}
    assert got == {"1": (None, None, "1"), "2": (None, None, "2"), "3": ("KEEP", None, "1"), "4": (None, None, "2"), "5": ("g", "h", "3")}
    assert {r.Prop_0: r.Prop_2 for r in S.read_csv_positional(spark, str(tmp_path)).collect()}["3"] == "KEEP"


def test_landing_writes_and_counts(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "ADR2.D2021137.T1").write_text("a,b\nc,d\n")
    (landing / "ADR2.D2021138.T1").write_text("e,f\n")
    ledger = land(spark, str(landing), str(tmp_path / "out"), D(2024, 1, 1), by_file_day=True)
    got = sorted((r.file_name, r.staging_row_count) for r in ledger.collect())
    assert got == [("ADR2.D2021137.T1", 2), ("ADR2.D2021138.T1", 1)]
    assert {r.file_day for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"2021/05/17", "2021/05/18"}


def test_split_evenly():
    assert S.split_evenly(list("abcdefg"), 3) == [list("abc"), list("de"), list("fg")]
    assert S.split_evenly(list("ab"), 3) == [["a"], ["b"], []]
    with pytest.raises(ValueError):
        S.split_evenly([], 0)


def test_batches_are_isolated(spark, tmp_path):
    for name in "abc":
        spark.range(3).write.parquet(str(tmp_path / name))
    files = [str(tmp_path / n) for n in ("a", "b", "missing", "c")]
    loaded = []
    with pytest.raises(S.BatchLoadError, match="1 of 4") as caught:
        S.load_in_batches(spark, files, 4, lambda df: loaded.append(df.count()))
    assert loaded == [3, 3, 3]
    flags = {r.file_name[-1]: r.ok for r in S.results_frame(spark, caught.value.results).collect()}
    assert flags == {"a": True, "b": True, "g": False, "c": True}
    assert all(r.ok for r in S.load_in_batches(spark, files[:2], 1, lambda df: None))


def test_tables(spark, lake, tmp_path):
    lake.create("SAT", "k string, p timestamp_ntz", ["p"])
    rows = spark.createDataFrame([("x", D(2024, 1, 1), 5), ("y", D(2024, 1, 2), 6)], "k string, p timestamp_ntz, spare int")
    lake.append("SAT", rows.select("p", "spare", "k"))
    assert lake.read("SAT").count() == 2 and lake.partition_columns("SAT") == ["p"]
    with pytest.raises(ValueError):
        lake.swap("SAT", lake.read("SAT"))
    assert lake.backup("SAT") == "SAT_bkp" and lake.partition_columns("SAT_bkp") == ["p"]
    lake.truncate("SAT")
    assert lake.read("SAT").count() == 0 and lake.read("SAT_bkp").count() == 2
    lake.export("SAT_bkp", str(tmp_path / "ext"))
    assert spark.read.parquet(str(tmp_path / "ext")).count() == 2


def test_bucketed_hub_is_not_shuffled(spark, lake, plan_of):
    from keystrata.operators.merge import insert_only

    lake.create("HUB", "HUB_HSH_KEY string, K bigint", bucket_by=(16, ["HUB_HSH_KEY"]))
    batch = spark.range(500).select(F.sha1(F.col("id").cast("string").cast("binary")).alias("HUB_HSH_KEY"), F.col("id").alias("K"))
    for rows in (batch.filter("K < 300"), batch, batch):
        lake.append("HUB", insert_only(lake.read("HUB"), rows, ["HUB_HSH_KEY"]))
    assert lake.read("HUB").count() == 500 and lake.bucketing("HUB") == (16, ["HUB_HSH_KEY"])
    assert len(lake.read("HUB").inputFiles()) <= 2 * 16
    # The scan of the target feeds the join directly; only the batch is shuffled.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(insert_only(lake.read("HUB"), batch, ["HUB_HSH_KEY"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    target_side = plan.split("LeftAnti")[1].split("FileScan parquet")[0].split("Range")[1]
    assert "Exchange" not in target_side and "Bucketed: true" in plan
    with pytest.raises(ValueError):
        lake.swap("HUB", batch)
    assert lake.backup("HUB") == "HUB_bkp" and lake.bucketing("HUB_bkp") == (16, ["HUB_HSH_KEY"])
    lake.truncate("HUB")
    assert lake.read("HUB").count() == 0 and lake.read("HUB_bkp").count() == 500


def test_swap_may_read_the_table(spark, lake):
    lake.create("REF", "k string, n int")
    for n in range(3):
        lake.swap("REF", lake.read("REF").unionByName(spark.createDataFrame([("k", n)], "k string, n long")))
    assert sorted(r.n for r in lake.read("REF").collect()) == [0, 1, 2]


def test_replace_keeps_the_old_table_on_failure(spark, lake):
    lake.replace("T", spark.range(3))
    bad = spark.range(1).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        lake.replace("T", bad)
    assert lake.read("T", "transform").count() == 3
    lake.replace("T", lake.read("T", "transform").limit(1))
    assert lake.read("T", "transform").count() == 1


def test_history_merge(spark, lake):
    for name, n in (("SAT", 3), ("SAT_HIST", 4)):
        lake.create(name, "id bigint")
        lake.append(name, spark.range(n))
    assert merge_history(lake, "SAT", "SAT_HIST") == {"daily_count": 3, "history_count": 4, "total_count": 7}
    assert lake.read("SAT").count() == 7 and lake.read("SAT_HIST").count() == 0 and lake.read("SAT_HIST_bkp").count() == 4


def test_a_broken_history_merge_is_refused_and_resumed(spark, lake, monkeypatch):
    for name, n in (("SAT", 3), ("SAT_HIST", 4)):
        lake.create(name, "id bigint")
        lake.append(name, spark.range(n))
    truncate = type(lake).truncate
    monkeypatch.setattr(type(lake), "truncate", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        merge_history(lake, "SAT", "SAT_HIST")
    monkeypatch.setattr(type(lake), "truncate", truncate)
    with pytest.raises(UnfinishedMerge):
        merge_history(lake, "SAT", "SAT_HIST")
    assert lake.read("SAT_bkp").count() == 3
    assert merge_history(lake, "SAT", "SAT_HIST", resume=True)["total_count"] == 7
    assert merge_history(lake, "SAT", "SAT_HIST") == {"daily_count": 7, "history_count": 0, "total_count": 7}
    assert lake.read("SAT").count() == 7 and lake.read("SAT_bkp").count() == 3 and lake.read("SAT_HIST").count() == 0


def test_history_merge_stops_on_a_count_mismatch(spark, lake, monkeypatch):
    for name in ("SAT", "SAT_HIST"):
        lake.create(name, "id bigint")
        lake.append(name, spark.range(2))
    append = type(lake).append
    monkeypatch.setattr(type(lake), "append", lambda self, t, rows, area="rawvault": append(self, t, rows.limit(1) if t == "SAT" else rows, area))
    with pytest.raises(CountMismatch):
        merge_history(lake, "SAT", "SAT_HIST")
    assert lake.read("SAT_HIST").count() == 2


def test_direct_insert_logs(spark, lake, tmp_path):
    lake.create("SAT_UIQ_EVENT_LOG", "k string, ROW_INSERT_DTM date", area="hist_data")
    staged = spark.createDataFrame([("2024-01-02", "a"), ("x", "b")], "ROW_INSERT_DTM string, k string")
    direct_insert(lake, "SAT_UIQ_EVENT_LOG", staged, count_log=str(tmp_path / "log"))
    assert sorted(map(tuple, lake.read("SAT_UIQ_EVENT_LOG", "hist_data").collect())) == [("a", dt.date(2024, 1, 2)), ("b", None)]
    assert S.read_count_log(spark, str(tmp_path / "log")).collect() == [("SAT_UIQ_EVENT_LOG", "2")]


def test_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "RECORD_SOURCE string")
    log = extend_log(count_by(df), count_as(df, "all"))
    assert sorted(map(tuple, log.collect()), key=str) == [("a", "2"), ("all", "3"), (None, "1")]
    assert reconcile(df, df, df.union(df)).head() == (3, 3, 6, True)
    assert reconcile(df, df, df).head().ok is False


def test_calendar_load(spark, lake, tmp_path):
    columns = wide_columns()
    columns[1:1] = ["Week Id", "Start", "End"]
    names = {c: f"{c} v" for c in columns} | {"Year": "2024", "Holiday When": "n/a"}
    (tmp_path / "cal.csv").write_text(",".join(columns) + "\n" + ",".join(names[c] for c in columns) + "\n")
    lake.create(WEEK_TABLE, "YR string, WK string, BILL_PD_START_DT string, BILL_PD_END_DT string, ROW_INSERT_DTM timestamp_ntz", area="transform")
    lake.create(DELIVERY_TABLE, TARGET, area="transform")
    for _ in range(2):  # loading the same file again changes nothing but the stamp
        load_calendar(lake, str(tmp_path / "cal.csv"), D(2024, 1, 1), str(tmp_path / "ext"))
        assert lake.read(WEEK_TABLE, "transform").collect() == [("2024", "Week Id v", "Start v", "End v", D(2024, 1, 1))]
        rows = lake.read(DELIVERY_TABLE, "transform").collect()
        assert sorted(r.TYP for r in rows) == ["Final Code v", "Prelim Code v", "Revision 1 Code v", "Revision 2 Code v"]
        assert spark.read.parquet(str(tmp_path / "ext" / DELIVERY_TABLE.lower())).count() == 4


def test_jdbc_options():
    # Options only: no database is started for tests.
    split = jdbc.ReadSplit("id", 0, 1000, 8)
    assert jdbc.read_options("jdbc:x", "s.t", "d.D", split) == {
        "url": "jdbc:x", "dbtable": "s.t", "driver": "d.D", "partitionColumn": "id", "lowerBound": "0", "upperBound": "1000", "numPartitions": "8",
    }
    assert jdbc.write_options("jdbc:x", "s.t", tableLock="true") == {
        "url": "jdbc:x", "dbtable": "s.t", "truncate": "true", "batchsize": "400000", "numPartitions": "100", "tableLock": "true",
    }


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(base) and first != second


def _one_task(text):
    """Records and their first lines, as one reader finds them from the start of a file."""
    out, held, first = [], [], 0
    lines = text.split("\n")[:-1]
    for number, line in enumerate(lines, 1):
        odd = len(re.sub(r"\\.", "", line).split('"')) % 2 == 0
        if not held and not (odd and any(len(re.sub(r"\\.", "", x).split('"')) % 2 == 0 for x in lines[number:])):
            out.append((number, line))
        elif not held:
            held, first = [line], number
        else:
            held.append(line)
            if odd:
                out.append((first, "\n".join(held)))
                held = []
    return out


def test_records_with_quoted_breaks_across_splits(spark, tmp_path):
    rng = random.Random(5)
    files = {}
    for name, size in (("a.csv", 400), ("b.csv", 60), ("plain.csv", 0), ("empty.csv", 0), ("open.csv", 20)):
        records = []
        for i in range(size):
            breaks = "\n".join("x" * rng.randrange(60) + rng.choice(["", ",", '\\"', '""', "\u00e9"]) for _ in range(rng.choice([1, 1, 1, 2, 3, 40])))
            records.append(rng.choice([f'{i},"{breaks}",end', f"{i},plain,end", f'"{breaks}","{breaks}"', "", '"one, quoted",2']))
        if name == "plain.csv":
            records = [f"{i},b" for i in range(50)]
        if name == "open.csv":
            records.append('never,"closed')
            records += ["after,this", "and,that"]
        files[name] = "".join(r + "\n" for r in records)
        (tmp_path / name).write_text(files[name])
    settings = {"spark.sql.files.maxPartitionBytes": "200b", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = S.numbered_records(spark, str(tmp_path))[0].collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    for name, text in files.items():
        mine = sorted((r.line, r.value) for r in found if r[S.FILE_PATH].endswith("/" + name))
        assert mine == _one_task(text), name


def test_fields_of_records_with_breaks(spark, tmp_path):
    (tmp_path / "f.csv").write_text('1,"a\nb, ""c",x\r\n2,"d",y,z\n3,"e \\" f\n\n",w\n')
    rows = sorted(tuple(r)[:5] for r in staged_lines(spark, str(tmp_path), multi_line=True).collect())
    assert [(r[0], r[2], r[3], r[4]) for r in rows] == [("1", "x", None, "1"), ("2", "y", "z", "3"), ("3", "w", None, "4")]
    assert rows[2][1] == 'e " f\n\n' and "a\nb, " in rows[0][1]


def test_width_of_lines_with_long_and_escaped_fields(spark):
    lines = ['1,"' + "a, " * 50_000 + '",2', '1,"' + '\\", ' * 20_000 + '",2', 'a\\,b', 'x,\\\\"a,b"', '"a\\\\",b', '1, "p,q" ,3']
    found = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string").select("i", S.field_count().alias("n")).collect()
    assert [r.n for r in sorted(found)] == [3, 3, 2, 3, 2, 3]


def test_width_of_lines_with_escaped_quotes_at_the_end_of_a_field(spark):
    lines = ['1,"a, b, c = \\"d\\"",src', '1,"","a,b"', '"","",""', '"a,"",b"', '1,"a, ""b"" c",2', '"\\"a, b"']
    found = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string").select("i", S.field_count().alias("n")).collect()
    assert [r.n for r in sorted(found)] == [3, 3, 3, 3, 4, 1]


def test_line_number_is_the_column_after_the_last_field(spark, tmp_path):
    (tmp_path / "f.csv").write_text('1,"a, b\nc, \\"d\\"",src\n2,plain,src\n')
    rows = sorted(tuple(r)[:-1] for r in staged_lines(spark, str(tmp_path), multi_line=True).collect())
    assert rows == [("1", 'a, b\nc, "d"', "src", "1"), ("2", "plain", "src", "3")]
