"""Stored state kept up by batches: dimensions of type 2, current versions, partitioned upserts, counts of writes."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystrata.catalogue.loads import _FEED, _FIRST, _L1, _L2, _META, _SAT_COLUMNS, _SAT_DDL, _SECOND, _event_batch, _lake
from keystrata.catalogue.registry import query, sql_hash_key, table
from keystrata.functions.hashing import hash_key
from keystrata.plans import dimensions as D
from keystrata.plans import vault as V
from keystrata.plans.config import FeedConfig
from keystrata.plans.contracts import CONTRACTS
from keystrata.plans.current import CurrentVersions, append_and_merge, for_delta_check
from keystrata.plans.exactly_once import follow_folder
from keystrata.plans.partitioned import upsert_partitions
from keystrata.plans.views import current_versions, view_rows
from keystrata.plans.warehouse import to_warehouse
from keystrata.session import shared_folder, written
from keystrata.sources.files import read_count_log
from keystrata.sources.tables import Lake

_CUSTOMER_VERSIONS = """
    select load, o_custkey as k, o_orderdate as t, arg_max(o_orderpriority, o_orderkey) as d
    from (select *, case when o_orderstatus = 'P' then 3 when o_orderdate >= timestamp '1996-01-01' then 2 else 1 end as load from orders)
    group by load, o_custkey, o_orderdate
"""


@query(
    f"""
    with v as ({_CUSTOMER_VERSIONS}),
    u1 as (select *, lag(d) over (partition by k order by t) as p from v where load = 1),
    s1 as (select k, t, d, 1 as ins, row_number() over (order by {sql_hash_key('k')}, t) as sk from u1 where p is distinct from d),
    e1 as (select *, lead(t) over (partition by k order by t) as e from s1),
    u2 as (select *, lag(d) over (partition by k order by t) as p from (
             select k, t, d, ins, sk from s1 union all select k, t, d, null, null from v where load = 2)),
    k2 as (select * from u2 where ins is not null or p is distinct from d),
    s2 as (select k, t, d, coalesce(ins, 2) as ins,
             coalesce(sk, (select max(sk) from s1) + row_number() over (partition by ins is null order by {sql_hash_key('k')}, t)) as sk from k2),
    e2 as (select *, lead(t) over (partition by k order by t) as e from s2),
    late as (select k, t, d from v where load = 3),
    c3 as (select s.k, s.t, coalesce(l.d, s.d) as d, s.ins, s.sk, coalesce(l.d <> s.d, false) as corrected from s2 s left join late l on l.k = s.k and l.t = s.t),
    u3 as (select *, lag(d) over (partition by k order by t) as p from (
             select * from c3 union all
             select k, t, d, null, null, false from late l where not exists (select 1 from s2 s where s.k = l.k and s.t = l.t))),
    k3 as (select * from u3 where ins is not null or p is distinct from d),
    s3 as (select k, t, d, coalesce(ins, 3) as ins, corrected,
             coalesce(sk, (select max(sk) from s2) + row_number() over (partition by ins is null order by {sql_hash_key('k')}, t)) as sk from k3),
    e3 as (select *, lead(t) over (partition by k order by t) as e from s3),
    told as (
      select e3.*, case when e3.ins = 3 or e3.corrected or e3.e is distinct from e2.e then 3
                        when e3.ins = 2 or e2.e is distinct from e1.e then 2 else 1 end as upd
      from e3 left join e2 on e2.k = e3.k and e2.t = e3.t left join e1 on e1.k = e3.k and e1.t = e3.t)
    select sk as "CUSTOMER_SK", cast(k as varchar) as "NMI", d as "CUSTOMER_NAME1", case when e is null then 'Y' else 'N' end as "CURRENT_RECORD_FLAG",
      t as "ROW_EFFECTIVE_DTM", coalesce(e, timestamp '9999-12-31 00:00:00') as "ROW_EXPIRATION_DTM",
      {sql_hash_key('k')} as "HSH_KEY", {sql_hash_key('d')} as "HSH_DIFF",
      timestamp '2024-01-01 00:00:00' + ins * interval 1 day as "RECORD_INSERT_DTM", timestamp '2024-01-01 00:00:00' + upd * interval 1 day as "RECORD_UPDATE_DTM"
    from told
    """
)
def scd2_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Customers by the priority of their orders: two loads in order of time, and a third of late orders that split versions."""
    late, recent = F.col("o_orderstatus") == "P", F.col("o_orderdate") >= F.expr("timestamp_ntz'1996-01-01'")
    orders = table(spark, sf, "orders").withColumn("load", F.when(late, 3).when(recent, 2).otherwise(1))
    versions = orders.groupBy("load", "o_custkey", F.col("o_orderdate").alias(D.START)).agg(F.max_by("o_orderpriority", "o_orderkey").alias("CUSTOMER_NAME1"))
    versions = versions.withColumns({"NMI": F.col("o_custkey").cast("string"), D.KEY: hash_key(["o_custkey"]), D.DIFF: hash_key(["CUSTOMER_NAME1"])})
    lake, contract = _lake(spark), CONTRACTS["DIM_CUSTOMER"]
    D.create_dimension(lake, contract)
    for load in (1, 2, 3):
        D.scd2_apply(lake, contract, versions.filter(F.col("load") == load), dt.datetime(2024, 1, 1) + dt.timedelta(days=load))
    return D.dimension_rows(lake, contract).select(
        "CUSTOMER_SK", "NMI", "CUSTOMER_NAME1", D.CURRENT, D.START, D.END, D.KEY, D.DIFF, D.INSERTED, D.UPDATED
    )


_VERSION_DDL = "HUB_USER_HSH_KEY string, EXTRACT_DATE_TIME timestamp_ntz, event_id bigint, event_type string"
_PARTS_OF_DAY = ("hour(ts) between 8 and 15", "hour(ts) < 8", "hour(ts) > 15")


@query(
    " union all ".join(
        f"""select {i} as batches, {sql_hash_key('user_id')} as "HUB_USER_HSH_KEY", ts as "EXTRACT_DATE_TIME", event_id, event_type from (
              select *, row_number() over (partition by user_id order by ts desc, event_id, event_type) as rn from events where {" or ".join(_PARTS_OF_DAY[:i])})
            where rn = 1"""
        for i in (1, 2, 3)
    )
)
def current_versions_three_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The table of current versions after each of three batches that come out of the order of time."""
    lake = _lake(spark, SAT_EVENT=_VERSION_DDL)
    current = CurrentVersions(lake, "SAT_EVENT", ("HUB_USER_HSH_KEY",), buckets=8)
    current.create()
    events = table(spark, sf, "events")
    rows = events.select("ts", hash_key(["user_id"]).alias("HUB_USER_HSH_KEY"), F.col("ts").alias("EXTRACT_DATE_TIME"), "event_id", "event_type")
    states = []
    for i, where in enumerate(_PARTS_OF_DAY, start=1):
        append_and_merge(current, rows.filter(where).drop("ts"))
        states.append(written(current.rows(), "state").withColumn("batches", F.lit(i)))
    return reduce(DataFrame.unionByName, states)


@query(
    f"""
    with known as (
        select user_id, ts from (
            select *, row_number() over (partition by user_id order by ts desc) as rn from events where ts < timestamp '2024-01-16')
        where rn = 1)
    select {_SAT_COLUMNS}, timestamp '{_L2}' as "LOAD_DATE_TIME"
    from events e where ts >= timestamp '2024-01-10'
      and not exists (select 1 from known k where k.user_id = e.user_id and k.ts = e.ts)
    """
)
def sat_load_against_current_table(spark: SparkSession, sf: str) -> DataFrame:
    """The delta check of a satellite against its ``_CV`` table instead of its history."""
    lake = _lake(spark, SAT_EVENT=_SAT_DDL)
    target = lake.read("SAT_EVENT")
    shape = V.SatelliteShape.of(target.schema)
    current = for_delta_check(lake, "SAT_EVENT", shape.key, shape.diff, shape.columns)
    current.create()
    append_and_merge(current, V.satellite_rows(_event_batch(spark, sf, _FIRST, _L1), target, direct=True))
    return V.satellite_rows(_event_batch(spark, sf, _SECOND, _L2), lake.read("SAT_EVENT"), current=current)


def _vault_of(spark: SparkSession, tables: dict[str, DataFrame]) -> Lake:
    lake = _lake(spark)
    for name, rows in tables.items():
        lake.create(name, rows.schema)
        lake.append(name, rows)
    return lake


@query(
    f"""
    with s as (
        select *, cast(cast(ts as date) as varchar) as dated, case when event_type = 'error' and value > 5 then 'D' else 'I' end as change,
            row_number() over (partition by event_type, cast(ts as date)
                               order by ts desc, cast(user_id as varchar), event_type, case when event_type = 'error' and value > 5 then 'D' else 'I' end, sha1(cast(event_id as varchar))) as rn
        from events),
    h as (select distinct event_type from events where value > 20)
    select ts as "EXTRACT_DATE_TIME", s.event_type as "FEEDER", dated as "DATED", cast(user_id as varchar) as "FEEDER_CATEGORY", s.event_type as "FEEDER_NAME",
        change as "CHANGE_TYPE", {sql_hash_key('s.event_type')} as "HUB_FEEDER_HSH_KEY", ts as "LOAD_DATE_TIME", 'DOMS' as "RECORD_SOURCE",
        sha1(cast(event_id as varchar)) as "SAT_DOMS_SPA_LOOKUP_FEEDER_CATEGORY_HSH_DIFF"
    from s join h on h.event_type = s.event_type where rn = 1 and change <> 'D'
    """
)
def view_from_current_table(spark: SparkSession, sf: str) -> DataFrame:
    """A named view over the tables of an environment, read from the table of current versions that two batches made."""
    name, satellite = "TMP_DOMS_SPA_LOOKUP_FEEDER_CATEGORY", "SAT_DOMS_SPA_LOOKUP_FEEDER_CATEGORY"
    events = table(spark, sf, "events")
    hub = events.filter("value > 20").select(F.col("event_type").alias("FEEDER")).distinct().withColumn("HUB_FEEDER_HSH_KEY", hash_key(["FEEDER"]))
    rows = events.select(
        hash_key(["event_type"]).alias("HUB_FEEDER_HSH_KEY"),
        F.col("ts").cast("date").cast("string").alias("DATED"),
        F.col("ts").alias("EXTRACT_DATE_TIME"),
        F.col("user_id").cast("string").alias("FEEDER_CATEGORY"),
        F.col("event_type").alias("FEEDER_NAME"),
        F.expr("case when event_type = 'error' and value > 5 then 'D' else 'I' end").alias("CHANGE_TYPE"),
        F.sha1(F.col("event_id").cast("string").cast("binary")).alias(f"{satellite}_HSH_DIFF"),
        F.col("ts").alias("LOAD_DATE_TIME"),
        F.lit("DOMS").alias("RECORD_SOURCE"),
    )
    lake = _vault_of(spark, {"HUB_FEEDER": hub, satellite: rows.limit(0)})
    current = current_versions(lake, name, buckets=8)
    current.create()
    for where in ("hour(EXTRACT_DATE_TIME) >= 12", "hour(EXTRACT_DATE_TIME) < 12"):
        append_and_merge(current, rows.filter(where))
    return view_rows(lake, name)


@query(
    f"""
    with e as (select *, hour(ts) || '/' || user_id as call, case when value > 40 then 'D' else 'I' end as change from events),
    z as (select distinct event_type from events where value > 20), c as (select distinct user_id from events where value > 20),
    s as (
        select *, row_number() over (partition by call order by ts desc, sha1(cast(event_id as varchar))) as rn from e
        where event_type in (select event_type from z) and user_id in (select user_id from c))
    select ts as "EXTRACT_DATE_TIME", call as "CALL_ID", event_type as "OPERATING_ZONE_ID", cast(user_id as varchar) as "CUSTOMER_CONNECTION_POINT",
        sha1(cast(event_id as varchar)) as "COMMENTS", {sql_hash_key('event_type', 'user_id', 'call')} as "LINK_CUSTOMER_CONNECTION_CALL_OPERATING_ZONE_HSH_KEY"
    from s where rn = 1 and change <> 'D'
    """
)
def view_through_link_on_lake(spark: SparkSession, sf: str) -> DataFrame:
    """The view of calls over tables of an environment: a link, three hubs, ranked by a hub's column after the join."""
    link = "LINK_CUSTOMER_CONNECTION_CALL_OPERATING_ZONE"
    events = table(spark, sf, "events").withColumns(
        {"CALL_ID": F.concat_ws("/", F.hour("ts").cast("string"), F.col("user_id").cast("string")), "user": F.col("user_id").cast("string")}
    )
    keys = {
        "HUB_OPERATING_ZONE": ("event_type", "OPERATING_ZONE_ID", "value > 20"),
        "HUB_CUSTOMER_CONNECTION": ("user", "CUSTOMER_CONNECTION_POINT", "value > 20"),
        "HUB_CALL": ("CALL_ID", "CALL_ID", "true"),
    }
    hubs = {h: events.filter(w).select(F.col(c).alias(n)).distinct().withColumn(f"{h}_HSH_KEY", hash_key([n])) for h, (c, n, w) in keys.items()}
    link_key = hash_key(["event_type", "user", "CALL_ID"]).alias(f"{link}_HSH_KEY")
    links = events.select(link_key, *(hash_key([c]).alias(f"{h}_HSH_KEY") for h, (c, _, _) in keys.items())).distinct()
    given = {
        "EXTRACT_DATE_TIME": F.col("ts"),
        "LOAD_DATE_TIME": F.col("ts"),
        "COMMENTS": F.sha1(F.col("event_id").cast("string").cast("binary")),
        "CHANGE_TYPE": F.when(F.col("value") > 40, "D").otherwise("I"),
    }
    texts = (
        "CALL_CATEGORY_DESCRIPTION CALL_CATEGORY_ID CALL_CHARGEABLE CALL_REFERENCE CALL_STATUS CALL_TAKER CALLER_FIRST_NAME CALLER_INITIALS CALLER_NAME"
        " CALLER_TELEPHONE CALLER_TITLE CRITICAL_INFO CUSTOMER_WARNED DANGEROUS_SITUATION LOGGED_TIME POSTCODE PREMISE_NAME PREMISE_NUMBER PRIORITY STREET"
        " TOWN_NAME TPD_CUSTOMER_AGREEMENT_NUMBER TPD_POLICE_FIRE_EVENT_NUMBER TPD_STATEMENT_AT_SITE_NUMBER TPD_VEHICLE_DETAILS LSAT_DOMS_SPA_MV_CALL_HSH_DIFF RECORD_SOURCE"
    ).split()
    rows = events.select(link_key, *(c.alias(n) for n, c in given.items()), *(F.lit("-").alias(c) for c in texts))
    lake = _vault_of(spark, hubs | {link: links, "LSAT_DOMS_SPA_MV_CALL": rows})
    found = view_rows(lake, "TMP_DOMS_SPA_MV_CALL")
    return found.select("EXTRACT_DATE_TIME", "CALL_ID", "OPERATING_ZONE_ID", "CUSTOMER_CONNECTION_POINT", "COMMENTS", f"{link}_HSH_KEY")


@query(
    """
    with t as (select o_orderkey as k, strftime(o_orderdate, '%Y-%m') as m, o_orderpriority as p from orders where o_orderdate < timestamp '1998-01-01'),
    b as (select l_orderkey as k, count(*) as n, max(l_shipdate) as d from lineitem group by l_orderkey having max(l_shipdate) >= timestamp '1997-06-01')
    select coalesce(t.k, b.k) as o_orderkey, t.p as o_orderpriority, b.n as lines, coalesce(strftime(b.d, '%Y-%m'), t.m) as month
    from t full outer join b on t.k = b.k
    """
)
def upsert_partitioned_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by month, moved to the month of their last shipment; only the months concerned are replaced."""
    month = lambda c: F.date_format(c, "yyyy-MM")
    known = table(spark, sf, "orders").filter("o_orderdate < timestamp_ntz'1998-01-01'").select(
        "o_orderkey", "o_orderpriority", F.lit(None).cast("bigint").alias("lines"), month("o_orderdate").alias("month")
    )
    shipped = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"), F.max("l_shipdate").alias("last"))
    shipped = shipped.filter("last >= timestamp_ntz'1997-06-01'").withColumn("month", month("last"))
    lake = _lake(spark)
    lake.create("REF_ORDER", known.schema, ["month"])
    lake.append("REF_ORDER", known)
    changed = {"lines": "lines", "month": "month"}
    for _ in range(2):  # the second run finds everything as it is
        upsert_partitions(lake, "REF_ORDER", shipped, ["o_orderkey"], changed, {"o_orderkey": "o_orderkey", **changed})
    return lake.read("REF_ORDER")


_HISTORY_FEED = {k: v for k, v in _FEED.items() if not k.startswith("Prop")} | {"load_type": "Hist_Data", "BUSINESSPARTITIONDATE": "BUS"}


def _history_lake(spark: SparkSession) -> Lake:
    return _lake(
        spark,
        HUB_ORDER=f"HUB_ORDER_HSH_KEY string, ORDER_NO bigint, {_META}",
        HUB_CUSTOMER=f"HUB_CUSTOMER_HSH_KEY string, CUSTOMER_NO bigint, {_META}",
        LINK_ORDER_CUSTOMER=f"LINK_ORDER_CUSTOMER_HSH_KEY string, HUB_ORDER_HSH_KEY string, HUB_CUSTOMER_HSH_KEY string, {_META}",
        SAT_ORDER=f"HUB_ORDER_HSH_KEY string, SAT_ORDER_HSH_DIFF string, CHANGE_TYPE string, EXTRACT_DATE_TIME timestamp_ntz, PRIORITY_CODE string, AMOUNT decimal(15,2), {_META}",
    )


def _history_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as files of a history feed bring them, a file per order status."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ORDER_NO"),
        F.col("o_custkey").alias("CUSTOMER"),
        F.col("o_orderdate").alias("BUS"),
        F.col("o_orderpriority").alias("PRIORITY"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("AMOUNT"),
        F.concat(F.lit("orders-"), "o_orderstatus").alias("_srcFileName"),
    )


@query(
    """
    with o as (select 'orders-' || o_orderstatus as file, o_orderdate < timestamp '1997-01-01' as first from orders)
    select 'log after 1' as kind, file as source, cast(count(*) as varchar) as n from o where first group by file
    union all select 'log after 2', file, cast(count(*) as varchar) from o group by file
    union all select 'hub', file, cast(count(*) as varchar) from o group by file
    """
)
def history_feed_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Two history loads whose record source is the file: counts logged per satellite from the writes, and the hub's sources."""
    lake, raw = _history_lake(spark), _history_raw(spark, sf)
    logs = []
    for i, where in enumerate(("BUS < timestamp_ntz'1997-01-01'", "BUS >= timestamp_ntz'1997-01-01'"), start=1):
        log = shared_folder(spark, "count-log")
        V.VaultFeed(lake, FeedConfig.from_parameters(_HISTORY_FEED), f"2024-01-0{i} 00:00:00").run(raw.filter(where), log)
        logs.append(read_count_log(spark, log).select(F.lit(f"log after {i}").alias("kind"), F.col("FileName").alias("source"), F.col("Count").alias("n")))
    hub = lake.read("HUB_ORDER").groupBy(F.col("RECORD_SOURCE").alias("source")).agg(F.count("*").cast("string").alias("n"))
    return logs[0].union(logs[1]).unionByName(hub.withColumn("kind", F.lit("hub")))


@query(
    """select 'migration' as job, o_orderkey, o_orderstatus from orders where o_orderdate < timestamp '1998-06-01'
       union all select 'daily', o_orderkey, o_orderstatus from orders where o_orderdate < timestamp '1996-01-01'"""
)
def warehouse_run_dates(spark: SparkSession, sf: str) -> DataFrame:
    """A job whose SQL uses the run date: a migration's date stands for tomorrow, any other for itself."""
    lake, view = _lake(spark), f"orders_{uuid.uuid4().hex[:8]}"
    table(spark, sf, "orders").createOrReplaceTempView(view)
    text = f"SELECT o_orderkey, o_orderstatus FROM {view} WHERE o_orderdate < timestamp_ntz'${{run_date}}'"
    jobs = {"migration": "1900-01-01", "daily": "1996-01-01"}
    for job, given in jobs.items():
        settings = {"LogicalEnv": lake.env, "Sql": text, "StagingTable": f"STG_{job}"}
        to_warehouse(lake, settings, given, today=dt.date(1998, 5, 31))
    found = [lake.read(f"STG_{job}", "dimlayer").withColumn("job", F.lit(job)).select("job", "o_orderkey", "o_orderstatus") for job in jobs]
    return found[0].union(found[1])


@query(
    """select o_orderkey, 'orders-' || o_orderstatus as source,
              timestamp '2024-03-01 00:00:00' + (case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end) * interval 1 second as load_ts
       from orders"""
)
def history_feed_followed(spark: SparkSession, sf: str) -> DataFrame:
    """A folder followed as a stream: three drops of files and a call that finds nothing; every row once, with its batch's time."""
    lake, raw = _history_lake(spark), _history_raw(spark, sf)
    folder, mark = shared_folder(spark, "drops"), shared_folder(spark, "stream")
    feed = V.VaultFeed(lake, FeedConfig.from_parameters(_HISTORY_FEED))
    first = F.col("_srcFileName") == "orders-F"
    for batch in (raw.filter(first), raw.filter(F.col("_srcFileName") == "orders-O"), raw.filter(~F.col("_srcFileName").isin("orders-F", "orders-O")), None):
        if batch is not None:
            batch.write.mode("append").parquet(folder)
        follow_folder(feed, folder, raw.schema, mark, now=dt.datetime(2024, 3, 1))
    hub = lake.read("HUB_ORDER").select("HUB_ORDER_HSH_KEY", "ORDER_NO")
    rows = lake.read("SAT_ORDER").join(hub, "HUB_ORDER_HSH_KEY")
    return rows.select(F.col("ORDER_NO").alias("o_orderkey"), F.col("RECORD_SOURCE").alias("source"), F.col("LOAD_DATE_TIME").alias("load_ts"))
