"""Configured column transforms and metadata columns over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystrata.catalogue.registry import query, table
from keystrata.operators import columns as C
from keystrata.operators.transforms import apply_satellite, apply_staging, clean_strings, transform


@query("select page_id, upper(hex(encode(url))) as url from pages")
def trans_raw_hex(spark: SparkSession, sf: str) -> DataFrame:
    coded = table(spark, sf, "pages").select("page_id", F.base64(F.col("url").cast("binary")).alias("url"))
    return transform(coded, "TRANSFORM_RAWTYPE", ["url"])


@query(
    """select p_partkey, case when p_size = 1 then '' else cast(p_partkey as varchar) end as code
       from (select * from part where p_partkey > 0 union all select * from part where p_partkey = 0 and p_size = 1)
       union all select p_partkey, '' from part where p_partkey = 0 and p_size <> 1"""
)
def trans_trim_zero(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.concat(F.lit(" "), F.lpad(F.col("p_partkey").cast("string"), 12, "0"), F.lit("  "))
    code = F.when(F.col("p_size") == 1, F.lit(None)).otherwise(padded)
    return transform(table(spark, sf, "part").select("p_partkey", code.alias("code")), "TRANSFORM_TRIM_LEADING_ZERO", ["code"])


@query("select p_partkey, split_part(p_partkey || '.50.3', '.', 1) as price, split_part(p_type, '.', 1) as p_type from part")
def trans_trim_decimal(spark: SparkSession, sf: str) -> DataFrame:
    texts = table(spark, sf, "part").select(
        "p_partkey", F.concat(F.col("p_partkey").cast("string"), F.lit(".50.3")).alias("price"), "p_type"
    )
    return transform(texts, "TRANSFORM_TRIM_DECIMAL", ["price", "p_type"])


@query("select c_custkey, 'XXXX' as c_name, c_mktsegment from customer")
def trans_pii(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return transform(names, "TRANSFORM_PII", {"c_name": "XXXX"})


@query("select c_custkey, substr(c_name, 10, 2) as check_digits, substr(c_name, 2, 30) as c_name from customer")
def trans_checksum(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "customer").select("c_custkey", "c_name")
    spec = {"c_name": {"targetcolumn": "check_digits", "checksuminit": 10, "init": 2, "length": 30}}
    return transform(names, "TRANSFORM_CHECKSUM", spec)


@query("select doc_id, substr(text, 5, 40) as passage, substr(text, -7, 5) as ending from documents")
def trans_substring(spark: SparkSession, sf: str) -> DataFrame:
    texts = table(spark, sf, "documents").select("doc_id", "text")
    texts = transform(texts, "TRANSFORM_SUBSTRING", {"text": {"targetcolumn": "passage", "init": 5, "length": 40}})
    texts = transform(texts, "TRANSFORM_SUBSTRING", {"text": {"targetcolumn": "ending", "init": -7, "length": 5}})
    return texts.drop("text")


@query(r"select page_id, url, regexp_extract(url, '^https?://([^/]+)/', 1) as host from pages")
def trans_regexp(spark: SparkSession, sf: str) -> DataFrame:
    spec = {"url": {"targetcolumn": "host", "pattern": "^https?://([^/]+)/", "matchGroup": 1}}
    return transform(table(spark, sf, "pages").select("page_id", "url"), "TRANSFORM_REGEXP", spec)


@query(
    r"""select page_id, array_to_string(regexp_extract_all(html, '<li><a href="/([^"]*)"', 1), '') as links,
               cast(len(regexp_extract_all(html, '<(\w+)', 1)) as int) as tags
        from pages"""
)
def trans_regexp_all(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "html")
    joined = {"html": {"targetcolumn": "links", "pattern": '<li><a href="/([^"]*)"', "matchGroup": 1, "joinAll": "Y"}}
    found = {"html": {"targetcolumn": "found", "pattern": r"<(\w+)", "matchGroup": 1}}
    pages = transform(transform(pages, "TRANSFORM_REGEXP_EXTRACT_ALL", joined), "TRANSFORM_REGEXP_EXTRACT_ALL", found)
    return pages.select("page_id", "links", F.size("found").alias("tags"))


@query("select c_custkey, substr(c_name, 1, 8) as kind, substr(c_name, 10, length(c_name) - 9) as c_name from customer")
def trans_prefix(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "customer").select("c_custkey", "c_name")
    spec = {"c_name": {"targetcolumn": "kind", "init": 1, "length": 8, "prefix_init": 10, "pos": 9}}
    return transform(names, "TRANSFORM_PREFIX", spec)


@query(
    """select event_id, cast(hour(ts) as int) as "Extract_hour", cast(date_trunc('hour', ts) as timestamp) as "EXTRACT_DATE_PARTITION"
       from events"""
)
def trans_hourly(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", F.col("ts").alias("EXTRACT_DATE_TIME"))
    return transform(events, "TRANSFORM_HOURLY_PARTITION", []).drop("EXTRACT_DATE_TIME")


@query(
    """select event_id, cast(date_trunc('day', ts) as timestamp) as day_start, cast(ts as date) as temp_extract_date_partition,
              cast(date_trunc('day', ts) as timestamp) as text_day_start
       from events"""
)
def trans_partition_col(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", F.col("ts").alias("EXTRACT_DATE_TIME"))
    days = transform(events, "TRANSFORM_PARTITION_COL", ["day_start"])
    texts = days.withColumn("EXTRACT_DATE_TIME", F.date_format("EXTRACT_DATE_TIME", "yyyy-MM-dd HH:mm:ss"))
    return transform(texts, "TRANSFORM_PARTITION_COL", ["text_day_start"]).drop("EXTRACT_DATE_TIME")


@query("""select event_id, cast(null as timestamp) as part_ts, '***' as props from events""")
def trans_default_partition(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "props")
    settings = {"TRANSFORM_DEFAULT_PARTITION": ["part_ts"], "TRANSFORM_PARTITION_COL": ["part_ts"], "TRANSFORM_PII": {"props": "***"}}
    return apply_satellite(events, settings)


@query("select doc_id, replace(text, chr(92) || '¿', '¿') as text, replace(text, ',', chr(92) || ',') as CLIENT from documents")
def trans_clean_strings(spark: SparkSession, sf: str) -> DataFrame:
    # Every comma arrives escaped; the column named CLIENT keeps its escapes.
    escaped = F.replace(F.col("text"), F.lit(","), F.lit("\\,"))
    texts = table(spark, sf, "documents").select("doc_id", escaped.alias("text"), escaped.alias("CLIENT"))
    return clean_strings(texts)


@query(
    """select c_custkey, substr(c_name, 1, 8) as kind, ltrim(substr(c_name, 10), '0') as c_name, c_mktsegment,
              substr(c_mktsegment, 1, 3) as seg
       from customer"""
)
def trans_fixed_order(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    settings = {
        "TRANSFORM_SUBSTRING": {"c_mktsegment": {"targetcolumn": "seg", "init": 1, "length": 3}},
        "TRANSFORM_TRIM_LEADING_ZERO": ["c_name"],
        "TRANSFORM_PREFIX": {"c_name": {"targetcolumn": "kind", "init": 1, "length": 8, "prefix_init": 10, "pos": 9}},
    }
    return apply_staging(names, settings)


@query(
    """select o_orderkey as "ORDER_NO", o_orderstatus as "CHANGE_TYPE", o_orderdate as "DM_TIMESTAMP",
              'ERP.ORDERS' as "RECORD_SOURCE", timestamp '2024-01-01 00:00:00' as "LOAD_DATE_TIME",
              o_orderdate as "EXTRACT_DATE_TIME", 0 as "GAP_1", 0 as "GAP_2", 100 as "CLIENT_ID"
       from orders where o_orderstatus <> 'P'"""
)
def metadata_delta(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Prop_0"),
        F.when(F.col("o_orderstatus") == "P", F.lit("B")).otherwise(F.col("o_orderstatus")).alias("Prop_1"),
        F.col("o_orderdate").alias("Prop_2"),
        F.lit("tx").alias("Prop_3"),
        F.lit("me").alias("Prop_4"),
    )
    raw = C.with_client_id(raw, {"Hub_1_Name": "HUB_EQUIPMENT"})
    named = C.rename_by_position(raw, ["ORDER_NO", "CHANGE_TYPE", "DM_TIMESTAMP", "DM_TXID", "DM_USER", "CLIENT_ID", "SPARE"])
    named = C.fill_missing(named, "GAP_1,GAP_2")
    return C.delta_metadata(C.drop_technical(C.drop_before_images(named)), "ERP.ORDERS", "2024-01-01 00:00:00")


@query(
    """select o_orderkey, 'file_' || o_orderpriority as "_srcFileName", 'file_' || o_orderpriority as "RECORD_SOURCE",
              timestamp '2024-01-01 00:00:00' as "LOAD_DATE_TIME", 'I' as "CHANGE_TYPE",
              cast(cast(o_orderdate as date) as timestamp) as "EXTRACT_DATE_TIME"
       from orders"""
)
def metadata_history(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit("file_"), F.col("o_orderpriority")).alias("_srcFileName"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("BUS_DT"),
        F.lit(None).cast("timestamp_ntz").alias("DM_TIMESTAMP"),
    )
    return C.replicated_history_metadata(raw, "2024-01-01 00:00:00", "BUS_DT").drop("BUS_DT", "DM_TIMESTAMP")


@query(
    """select event_id, 'FEED' as "RECORD_SOURCE", timestamp '2024-01-01 00:00:00' as "LOAD_DATE_TIME", 'I' as "CHANGE_TYPE",
              date_trunc('second', ts) as "EXTRACT_DATE_TIME"
       from events"""
)
def metadata_file(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyyMMddHHmmss").alias("tempdate"))
    return C.file_metadata(raw, "FEED", "2024-01-01 00:00:00").drop("tempdate")


@query("""select l_linenumber, l_orderkey, l_partkey from lineitem where l_returnflag <> 'N' and l_linestatus is not null""")
def required_and_projected(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return C.select_target(C.require(lines, ["l_returnflag", "l_linestatus"], "N"), ["l_linenumber", "l_orderkey", "l_partkey"])
