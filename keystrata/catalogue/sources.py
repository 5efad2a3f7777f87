"""Readers and writers over files that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystrata.catalogue.registry import query, table
from keystrata.operators.counts import count_by
from keystrata.plans.landing import land, staged_lines
from keystrata.session import shared_folder
from keystrata.sources import files as S


def _customer_lines(spark: SparkSession, sf: str) -> str:
    """Customers as header-less CSV in several files, each sorted by key."""
    folder = shared_folder(spark, "landing")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    customers.repartitionByRange(4, "c_custkey").sortWithinPartitions("c_custkey").write.csv(folder)
    return folder


@query(
    """select cast(c_custkey as varchar) as "Prop_0", c_name as "Prop_1", c_mktsegment as "Prop_2",
              row_number() over (order by c_custkey) - 1 as position from customer"""
)
def record_seq(spark: SparkSession, sf: str) -> DataFrame:
    staged = staged_lines(spark, _customer_lines(spark, sf))
    # Keys are dense and every file is sorted, so the first key of the file plus the line gives the key back.
    first = staged.groupBy(S.FILE_PATH).agg(F.min(F.col("Prop_0").cast("bigint")).alias("first_key"))
    position = F.col("first_key") + F.col("Prop_3").cast("bigint") - 1
    return staged.join(first, S.FILE_PATH).select("Prop_0", "Prop_1", "Prop_2", position.alias("position"))


@query(
    """select c_mktsegment as segment, count(*) as staging_row_count, timestamp '2024-01-01 00:00:00' as load_ts,
              (count(*) filter (c_custkey % 7 = 0))::bigint as wide_rows, (sum(c_custkey) filter (c_custkey % 7 = 0))::bigint as wide_keys
       from customer group by 1"""
)
def landing_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Files by segment, of lines with three and with four fields; the fourth must not be lost."""
    folder, staging = shared_folder(spark, "landing"), shared_folder(spark, "staging")
    rows = table(spark, sf, "customer")
    fields = F.concat_ws(",", F.col("c_custkey").cast("string"), F.concat(F.lit('"'), "c_name", F.lit(', Ltd"')), "c_mktsegment")
    wide = F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit(","), F.col("c_custkey").cast("string"))).otherwise("")
    lines = rows.select(F.concat(fields, wide).alias("value"), F.col("c_mktsegment").alias("segment"))
    lines.repartition("segment").write.partitionBy("segment").text(folder)
    entries = land(spark, folder, staging, "2024-01-01 00:00:00")
    staged = spark.read.parquet(staging)
    path = F.split(S.FILE_PATH, "/")
    kept = staged.groupBy(F.col("Prop_2").alias("segment"), F.element_at(path, -1).alias("file_name")).agg(
        F.count("Prop_3").alias("wide_rows"), F.sum(F.col("Prop_3").cast("bigint")).alias("wide_keys"), F.count("*").alias("rows")
    )
    # A task may write lines of several segments, each into a file of its own with one name.
    kept = kept.groupBy("segment").agg(F.collect_set("file_name").alias("files"), F.sum("wide_rows").alias("wide_rows"), F.sum("wide_keys").alias("wide_keys"), F.sum("rows").alias("staging_row_count"))
    seen = entries.agg(F.collect_set("file_name").alias("seen"), F.max("load_ts").alias("load_ts"), F.sum("staging_row_count").alias("all"))
    total = kept.agg(F.sum("staging_row_count").alias("mine"))
    checked = kept.join(F.broadcast(seen.join(F.broadcast(total)).filter("all = mine")))
    return checked.filter(F.size(F.array_except("files", "seen")) == 0).select("segment", "staging_row_count", "load_ts", "wide_rows", "wide_keys")


@query(
    r"""select cast(doc_id as varchar) as doc, md5(translate(coalesce(text, ''), '\' || chr(13), '/ ')) as text_md5,
               length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) as breaks, source, true as lines_add_up from documents"""
)
def landing_quoted_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as CSV with their line breaks inside quoted fields; the first lines of records and their breaks fill each file."""
    folder = shared_folder(spark, "landing")
    text = F.translate(F.coalesce("text", F.lit("")), "\\\r", "/ ")
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('\\"')), F.lit('"'))
    docs = table(spark, sf, "documents").select(F.concat_ws(",", F.col("doc_id").cast("string"), quoted, "source").alias("value"))
    docs.write.text(folder)
    staged = staged_lines(spark, folder, multi_line=True)
    text, line = F.coalesce("Prop_1", F.lit("")), F.col("Prop_3").cast("bigint")
    breaks = (F.length(text) - F.length(F.replace(text, F.lit("\n")))).cast("bigint")
    rows = staged.select(S.FILE_PATH, F.col("Prop_0").alias("doc"), F.md5(text).alias("text_md5"), breaks.alias("breaks"), F.col("Prop_2").alias("source"), line.alias("line"))
    files = rows.groupBy(S.FILE_PATH).agg((F.max(F.col("line") + F.col("breaks")) == F.sum(F.col("breaks") + 1)).alias("lines_add_up"))
    return rows.join(files, S.FILE_PATH).select("doc", "text_md5", "breaks", "source", "lines_add_up")


@query(
    """select cast(o_orderkey as varchar) as "Order No", o_orderstatus as "Status", o_orderpriority as "Priority Text" from orders"""
)
def csv_with_header(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark, "csv")
    table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Order No"), F.col("o_orderstatus").alias("Status"), F.col("o_orderpriority").alias("Priority Text")
    ).write.option("header", True).csv(folder)
    return S.read_csv_with_header(spark, folder)


@query(
    """select cast(o_orderkey as varchar) as "Prop_0", o_orderstatus as "Prop_1", o_orderpriority as "Prop_2", true as has_file from orders"""
)
def csv_positional(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark, "csv")
    table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").write.csv(folder)
    rows = S.read_csv_positional(spark, folder)
    return rows.select("Prop_0", "Prop_1", "Prop_2", F.col(S.FILE_PATH).contains("csv-").alias("has_file"))


@query(
    """select o_orderpriority as "FileName", cast(count(*) as varchar) as "Count" from orders group by 1
       union all select o_orderstatus, cast(count(*) as varchar) from orders group by 1"""
)
def count_log_appended(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark, "count-log")
    orders = table(spark, sf, "orders")
    for column in ("o_orderpriority", "o_orderstatus"):
        S.append_count_log(count_by(orders, column), folder)
    return S.read_count_log(spark, folder)


@query("select o_orderpriority, count(*) as row_count, sum(o_orderkey)::bigint as key_sum from orders group by 1")
def batched_load(spark: SparkSession, sf: str) -> DataFrame:
    staged, loaded = shared_folder(spark, "staged"), shared_folder(spark, "loaded")
    table(spark, sf, "orders").repartition(8).write.parquet(staged)
    paths = sorted(spark.read.parquet(staged).inputFiles())
    S.load_in_batches(spark, paths, 3, lambda df: df.write.mode("append").parquet(loaded))
    return spark.read.parquet(loaded).groupBy("o_orderpriority").agg(
        F.count("*").alias("row_count"), F.sum("o_orderkey").alias("key_sum")
    )


@query("select n_name, count(*) as customers from customer join nation on n_nationkey = c_nationkey group by 1")
def parquet_export(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark, "export")
    nations = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    S.write_parquet(table(spark, sf, "customer").join(nations, "c_nationkey"), folder, ["n_regionkey"])
    return S.read_parquet(spark, folder).groupBy("n_name").agg(F.count("*").alias("customers"))
