"""Hashes and scalar functions over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystrata.catalogue.registry import query, sql_hash_key, sql_hash_raw, sql_number_text, table
from keystrata.functions.geo import NETWORK_GRID, st_x, st_y
from keystrata.functions.hashing import hash_diff, hash_key, hash_raw, satellite_diff_columns, with_warehouse_hashes
from keystrata.functions.registry import register_business_days, register_functions
from keystrata.functions.text import count_substring
from keystrata.functions.times import (
    BUSINESS_DATE_FORMATS,
    archive_folder,
    business_date,
    date_key,
    file_time,
    julian_file_date,
    local_time,
    local_time_compat,
    parse_moment,
)
from keystrata.operators.transforms import transform
from keystrata.plans.calendar import with_business_days


@query(f"select c_custkey, {sql_hash_key('c_custkey')} as hsh_key, {sql_hash_key('c_name', 'c_mktsegment')} as hsh_key2 from customer")
def hash_hub_key(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", hash_key(["c_custkey"]).alias("hsh_key"), hash_key(["c_name", "c_mktsegment"]).alias("hsh_key2")
    )


@query(
    f"select l_orderkey, l_linenumber, {sql_hash_key('l_orderkey', 'l_partkey', 'l_suppkey', 'l_shipdate')} as hsh_key from lineitem"
)
def hash_link_key(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", hash_key(["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"]).alias("hsh_key")
    )


@query(
    f"""select c_custkey, {sql_hash_raw("nullif(c_mktsegment, 'BUILDING')", 'c_nationkey')} as hsh_skip,
               sha1(concat_ws(':', coalesce(nullif(c_mktsegment, 'BUILDING'), ''), cast(c_nationkey as varchar)) || ':') as hsh_empty
        from customer"""
)
def hash_salink_raw(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "customer").withColumn("seg", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    return df.select(
        "c_custkey",
        hash_raw(["seg", "c_nationkey"]).alias("hsh_skip"),
        hash_raw(["seg", "c_nationkey"], null="empty").alias("hsh_empty"),
    )


_DIFF_SQL = ", ".join(
    [
        *(sql_number_text(f"nullif(cast({c} as decimal(15,2)), 0)") for c in ("l_quantity", "l_extendedprice", "l_discount")),
        *(f"coalesce(trim(cast({c} as varchar)), '')" for c in ("l_linestatus", "l_shipdate")),
    ]
)


@query(f"select l_orderkey, l_linenumber, sha1(concat_ws(':', {_DIFF_SQL}) || ':') as hsh_diff from lineitem")
def hash_sat_diff_decimal(spark: SparkSession, sf: str) -> DataFrame:
    numbers = ["l_quantity", "l_extendedprice", "l_discount"]
    df = table(spark, sf, "lineitem").withColumns(
        {**{c: F.nullif(F.col(c).cast("decimal(15,2)"), F.lit(0)) for c in numbers}, "LOAD_DATE_TIME": F.lit("x")}
    )
    columns = satellite_diff_columns([*numbers, "l_linestatus", "l_shipdate", "LOAD_DATE_TIME"])
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select("l_orderkey", "l_linenumber", hash_diff(columns, types, types).alias("hsh_diff"))


# Products and quotients of prices: doubles with up to 17 digits, small ones among them.
_DOUBLES = {
    "net": "l_extendedprice * (1 - l_discount) * (1 + l_tax)",
    "unit": "l_extendedprice / l_quantity / 7",
    "tiny": "l_discount / l_extendedprice / l_extendedprice / l_extendedprice",
    "large": "l_extendedprice * l_extendedprice * l_extendedprice * l_partkey",
}
_DOUBLE_TEXTS = ", ".join(f"case when contains({t}, '.') then rtrim(rtrim({t}, '0'), '.') else {t} end" for t in (f"cast({e} as varchar)" for e in _DOUBLES.values()))


@query(f"select l_orderkey, l_linenumber, sha1(concat_ws(':', {_DOUBLE_TEXTS}) || ':') as hsh_diff from lineitem")
def hash_sat_diff_double(spark: SparkSession, sf: str) -> DataFrame:
    """Change hash over doubles: each with the fewest digits from which it is read back."""
    df = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", *(f"{e} as {n}" for n, e in _DOUBLES.items()))
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select("l_orderkey", "l_linenumber", hash_diff(list(_DOUBLES), types, types).alias("hsh_diff"))


@query(
    f"""select o_orderkey, {sql_hash_raw('o_orderkey', 'o_custkey')} as "HSH_KEY",
               {sql_hash_raw('o_orderkey', 'o_custkey', "nullif(o_orderstatus, 'F')", 'o_orderpriority', 'o_orderdate')} as "HSH_DIFF"
        from orders"""
)
def hash_warehouse_key_diff(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("o_orderstatus"),
        "o_orderpriority",
        "o_orderdate",
        F.lit("now").alias("RUN_DTM"),
    )
    return with_warehouse_hashes(df, "o_orderkey, o_custkey").select("o_orderkey", "HSH_KEY", "HSH_DIFF")


_COUNT_SQL = "cast((octet_length(encode({0})) - octet_length(encode(replace({0}, '{1}', '')))) // {2} as int)"


@query(
    f"""select doc_id, {_COUNT_SQL.format('text', 'é', 2)} as accents, {_COUNT_SQL.format('text', 'the', 3)} as articles
        from documents"""
)
def count_substring_documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", count_substring(F.col("text"), "é").alias("accents"), count_substring(F.col("text"), "the").alias("articles")
    )


@query(f"""select page_id, {_COUNT_SQL.format('html', '<li>', 4)} as items, {_COUNT_SQL.format('html', '&amp;', 5)} as ands from pages""")
def count_substring_sql(spark: SparkSession, sf: str) -> DataFrame:
    register_functions(spark)
    return table(spark, sf, "pages").select(
        "page_id",
        F.expr("fn_get_count_of_substring(html, '<li>')").alias("items"),
        F.expr("fn_get_count_of_substring(html, '&amp;')").alias("ands"),
    )


@query("select event_id, ts at time zone 'UTC' at time zone 'Australia/Melbourne' as local_ts from events")
def local_time_of_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", local_time(F.col("ts")).alias("local_ts"))


_COMPAT = "o_orderdate + (o_orderdate - (o_orderdate at time zone 'Australia/Sydney' at time zone 'UTC'))"


@query(f"select o_orderkey, {_COMPAT} as local_ts, {_COMPAT} as local_sql from orders")
def local_time_compat_of_orders(spark: SparkSession, sf: str) -> DataFrame:
    register_functions(spark)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        local_time_compat(F.col("o_orderdate")).alias("local_ts"),
        F.expr("convertolocaltime(o_orderdate)").alias("local_sql"),
    )


def _projection_sql() -> str:
    n, scale, rho0 = NETWORK_GRID.constants()
    e = NETWORK_GRID.e
    steps = ["select *, pi() / 2 - 2 * atan(t) as p0 from c"]
    for i in range(6):
        steps.append(
            f"select *, pi() / 2 - 2 * atan(t * pow((1 - {e} * sin(p{i})) / (1 + {e} * sin(p{i})), {e / 2})) as p{i + 1} from ({steps[-1]})"
        )
    return f"""
        with a as (select c_custkey, 1e9 + c_acctbal * 20000 - 1e8 as x, 1e9 - c_nationkey * 1e7 as y from customer),
        b as (select *, x / 1000 - 1e6 as dx, ({rho0!r}) - (y / 1000 - 1e6) as dy from a),
        c as (select *, pow(-sqrt(dx * dx + dy * dy) / ({scale!r}), 1 / ({n!r})) as t, atan2(-dx, -dy) / ({n!r}) as theta from b)
        select c_custkey, round(degrees(theta) + 145, 7) as lon, round(degrees(p6), 7) as lat from ({steps[-1]})
    """


@query(_projection_sql())
def st_xy(spark: SparkSession, sf: str) -> DataFrame:
    points = table(spark, sf, "customer").select(
        "c_custkey",
        (F.lit(1e9) + F.col("c_acctbal") * 20000 - F.lit(1e8)).alias("x"),
        (F.lit(1e9) - F.col("c_nationkey") * 1e7).alias("y"),
    )
    return points.select("c_custkey", F.round(st_x("x", "y"), 7).alias("lon"), F.round(st_y("x", "y"), 7).alias("lat"))


@query(_projection_sql())
def st_xy_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The same projection by the functions' SQL names."""
    register_functions(spark)
    table(spark, sf, "customer").createOrReplaceTempView("st_xy_customers")
    return spark.sql(
        """select c_custkey, round(st_x(x, y), 7) as lon, round(st_y(x, y), 7) as lat from (
             select c_custkey, 1e9 + c_acctbal * 20000 - 1e8 as x, 1e9 - c_nationkey * 1e7 as y from st_xy_customers)"""
    )


_NAME_SQL = "'FEED.D' || strftime(o_orderdate, '%Y%j') || '.T' || o_orderkey"


@query(
    f"""select o_orderkey, cast(o_orderdate as date) as file_date, strftime(o_orderdate, '%Y/%m/%d') as folder
        from (select *, {_NAME_SQL} as file_name from orders)"""
)
def julian_filedate(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lit("FEED.D"), F.date_format("o_orderdate", "yyyyDDD"), F.lit(".T"), F.col("o_orderkey").cast("string"))
    files = table(spark, sf, "orders").select("o_orderkey", name.alias("file_name"))
    return files.select(
        "o_orderkey",
        julian_file_date(F.col("file_name")).alias("file_date"),
        archive_folder(F.col("file_name")).alias("folder"),
    )


@query(
    """select event_id, date_trunc('second', ts) as "EXTRACT_DATE_TIME" from events"""
)
def filedate_extract(spark: SparkSession, sf: str) -> DataFrame:
    files = table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("feed_"), F.date_format("ts", "yyyy-MM-dd_HHmmss"), F.lit(".parquet")).alias("_srcFileName")
    )
    spec = {"_srcFileName": {"targetcolumn": "tempdate", "pattern": r"(\d+)", "matchGroup": 1, "matchAll": "Y", "joinAll": "Y"}}
    dated = transform(files, "TRANSFORM_PARSE_FILEDATE", spec)
    return dated.select("event_id", file_time(F.col("tempdate")).alias("EXTRACT_DATE_TIME"))


@query(
    """select o_orderkey,
              case when o_orderstatus = 'F' then cast(cast(o_orderdate as date) as timestamp)
                   when o_orderstatus = 'O' then o_orderdate + interval 37 minute
                   else timestamp '2000-01-01 00:00:00' end as "EXTRACT_DATE_TIME",
              case when o_orderstatus = 'F' then cast(cast(o_orderdate as date) as timestamp)
                   when o_orderstatus = 'O' then o_orderdate + interval 37 minute end as parsed
       from orders"""
)
def business_date_resolution(spark: SparkSession, sf: str) -> DataFrame:
    later = F.col("o_orderdate") + F.expr("interval 37 minute")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyyMMdd"))
        .when(F.col("o_orderstatus") == "O", F.date_format(later, "yyyyMMddHHmmss"))
        .otherwise(F.lit("unknown"))
    )
    df = table(spark, sf, "orders").select("o_orderkey", text.alias("BUS_DT"), F.lit("2000-01-01 00:00:00").alias("DM_TIMESTAMP"))
    return df.select(
        "o_orderkey",
        business_date(df, "BUS_DT").alias("EXTRACT_DATE_TIME"),
        parse_moment(F.col("BUS_DT"), *BUSINESS_DATE_FORMATS).alias("parsed"),
    )


@query("select o_orderkey, cast(strftime(o_orderdate, '%Y%m%d') as int) as date_key from orders")
def integer_date_key(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", date_key(F.col("o_orderdate")).alias("date_key"))


@query(
    """
    with cal as (select distinct cast(o_orderdate as date) as d from orders where isodow(o_orderdate) < 6),
    pairs as (select distinct cast(o.o_orderdate as date) as a, cast(l.l_shipdate as date) as b
              from lineitem l join orders o on o.o_orderkey = l.l_orderkey),
    counted as (select a, b, count(distinct d) as n from pairs left join cal on cal.d between a and b group by a, b)
    select l.l_orderkey, l.l_linenumber, l.l_partkey, cast(l.l_shipdate as date) as ship_date, n as businessdays
    from lineitem l join orders o on o.o_orderkey = l.l_orderkey
         join counted on a = cast(o.o_orderdate as date) and b = cast(l.l_shipdate as date)
    """
)
def business_days(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    calendar = orders.select(
        F.col("order_date").alias("DT_CAL_DATE"),
        date_key(F.col("order_date")).alias("DT_DATE_KEY"),
        (F.weekday("order_date") < 5).cast("int").alias("VIC_BD_IND"),
    )
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("ship_date")
    )
    dated = lines.join(orders, lines.l_orderkey == orders.o_orderkey).drop("o_orderkey")
    return with_business_days(dated, "order_date", "ship_date", calendar).drop("order_date")


@query(
    """
    with cal as (select distinct cast(o_orderdate as date) as d from orders where isodow(o_orderdate) < 6),
    spans as (select c_mktsegment, min(cast(o_orderdate as date)) as a, max(cast(o_orderdate as date)) - 90 as b
              from orders join customer on c_custkey = o_custkey group by 1)
    select c_mktsegment, a as first_day, b as last_day, (select count(*) from cal where d between a and b) as businessdays from spans
    """
)
def business_days_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The table function by its SQL name, for one span of days per segment."""
    orders = table(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    calendar = orders.select(F.col("day").alias("DT_CAL_DATE"), date_key(F.col("day")).alias("DT_DATE_KEY"), (F.weekday("day") < 5).cast("int").alias("VIC_BD_IND"))
    calendar.createOrReplaceTempView("business_days_calendar")
    register_business_days(spark, "business_days_calendar")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    spans = orders.join(customers, "o_custkey").groupBy("c_mktsegment").agg(F.min("day").alias("first_day"), F.date_sub(F.max("day"), 90).alias("last_day"))
    spans.createOrReplaceTempView("business_days_spans")
    return spark.sql("select s.*, f.businessdays from business_days_spans s, lateral fn_get_business_days(first_day, last_day) f")
