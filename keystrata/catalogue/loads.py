"""Vault loads, merges and calendars over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystrata.catalogue.registry import query, sql_hash_key, sql_hash_raw, sql_number_text, table
from keystrata.functions.hashing import hash_key
from keystrata.functions.times import moment
from keystrata.operators.columns import delta_metadata, select_target, subset_for
from keystrata.operators.counts import count_as, count_by, extend_log, reconcile, reconcile_contents
from keystrata.operators.merge import in_partitions, upsert
from keystrata.plans import calendar as K
from keystrata.plans import vault as V
from keystrata.plans.config import FeedConfig, HubSpec, LinkSpec, SameAsSpec
from keystrata.plans.history import UnfinishedMerge, direct_insert, merge_history, parse_text_date
from keystrata.plans.key_prefixes import KeyPrefixes
from keystrata.session import shared_folder
from keystrata.sources.tables import Lake


def _lake(spark: SparkSession, **tables: str) -> Lake:
    """A vault of its own for one run, kept in the shared folder, with empty tables."""
    lake = Lake(spark, f"q{uuid.uuid4().hex[:12]}", shared_folder(spark, "lake"))
    for name, ddl in tables.items():
        lake.create(name, ddl)
    return lake


_META = "RECORD_SOURCE string, LOAD_DATE_TIME timestamp_ntz"


def _order_batches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders").withColumns({"DM_TIMESTAMP": F.col("o_orderdate"), "CHANGE_TYPE": F.lit("I")})
    first = delta_metadata(orders.filter("o_orderdate < timestamp_ntz'1998-01-01'"), "b1", "2024-01-01 00:00:00")
    second = delta_metadata(orders.filter("o_orderdate >= timestamp_ntz'1997-01-01'"), "b2", "2024-01-02 00:00:00")
    return first, second


_TWO_BATCHES = """
    with b as (select *, 'b1' as src, timestamp '2024-01-01 00:00:00' as load_ts from orders where o_orderdate < timestamp '1998-01-01'
               union all
               select *, 'b2', timestamp '2024-01-02 00:00:00' from orders where o_orderdate >= timestamp '1997-01-01')
"""


@query(
    f"""{_TWO_BATCHES}
    select {sql_hash_key('o_custkey')} as "HUB_CUSTOMER_HSH_KEY", o_custkey as "CUSTOMER_NO", min(src) as "RECORD_SOURCE",
           min(load_ts) as "LOAD_DATE_TIME"
    from b group by o_custkey
    """
)
def hub_load_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    hub = HubSpec("HUB_CUSTOMER", ("CUSTOMER_NO",), {"o_custkey": "CUSTOMER_NO"})
    lake = _lake(spark, HUB_CUSTOMER=f"HUB_CUSTOMER_HSH_KEY string, CUSTOMER_NO bigint, {_META}")
    for batch, source in zip(_order_batches(spark, sf), ("b1", "b2")):
        rows = V.key_rows(V.map_hub(batch, hub, source), lake.read(hub.name), hub.hash_key, V.hub_hash(hub))
        lake.append(hub.name, rows)
    return lake.read(hub.name)


@query(
    f"""
    select {sql_hash_key('l_orderkey')} as "HUB_ORDER_HSH_KEY", l_orderkey as "ORDER_NO",
           case when min(l_shipdate) < timestamp '1994-06-01' then 'b1' when min(l_shipdate) < timestamp '1996-06-01' then 'b2' else 'b3' end as "RECORD_SOURCE"
    from lineitem group by l_orderkey
    """
)
def hub_load_key_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    """Three overlapping loads of all orders by the ship dates of their lines; each meets the hub with possible hits only."""
    hub = HubSpec("HUB_ORDER", ("ORDER_NO",), {"l_orderkey": "ORDER_NO"})
    lake = _lake(spark, HUB_ORDER="HUB_ORDER_HSH_KEY string, ORDER_NO bigint, RECORD_SOURCE string")
    lines, day = table(spark, sf, "lineitem"), F.col("l_shipdate")
    prefixes = KeyPrefixes(lake, hub.name, hub.hash_key)
    prefixes.rebuild(expected=lines.count())
    loads = {"b1": day < "1994-06-01", "b2": (day >= "1994-01-01") & (day < "1996-06-01"), "b3": day >= "1996-01-01"}
    for source, chosen in loads.items():
        rows = V.map_hub(lines.filter(chosen), hub, source)
        prefixes.append_new(V.hashed_rows(rows, lake.columns(hub.name), V.hub_hash(hub)))
    return lake.read(hub.name)


@query(
    f"""select 'HUB_ECONOMY' as hub, {sql_hash_key('p_name')} as hsh_key, p_name from part where p_type = 'ECONOMY' group by p_name
        union all
        select 'HUB_SMALL', {sql_hash_key('p_name')}, p_name from part where p_type = 'SMALL' group by p_name"""
)
def hub_split_by_discriminator(spark: SparkSession, sf: str) -> DataFrame:
    split = {"p_type": {"HUB_ECONOMY": "ECONOMY", "HUB_SMALL": "SMALL"}}
    parts = table(spark, sf, "part")
    ddl = "hsh_key string, p_name string"
    lake = _lake(spark, HUB_ECONOMY=ddl, HUB_SMALL=ddl)
    for hub in ("HUB_ECONOMY", "HUB_SMALL"):
        hashes = {"hsh_key": V.KeyHash(("p_name",))}
        lake.append(hub, V.key_rows(subset_for(parts, split, hub), lake.read(hub), "hsh_key", hashes))
    economy, small = (lake.read(h).withColumn("hub", F.lit(h)) for h in ("HUB_ECONOMY", "HUB_SMALL"))
    return economy.union(small)


@query(
    f"""{_TWO_BATCHES}
    select {sql_hash_key('o_custkey', 'o_orderpriority')} as "LINK_CUSTOMER_PRIORITY_HSH_KEY",
           {sql_hash_key('o_custkey')} as "HUB_CUSTOMER_HSH_KEY", {sql_hash_key('o_orderpriority')} as "HUB_PRIORITY_HSH_KEY",
           min(src) as "RECORD_SOURCE", min(load_ts) as "LOAD_DATE_TIME"
    from b group by o_custkey, o_orderpriority
    """
)
def link_load_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    link = LinkSpec("LINK_CUSTOMER_PRIORITY", ("o_custkey", "o_orderpriority"))
    hashes = {
        "HUB_CUSTOMER_HSH_KEY": V.KeyHash(("o_custkey",)),
        "HUB_PRIORITY_HSH_KEY": V.KeyHash(("o_orderpriority",)),
    } | V.link_hash(link)
    lake = _lake(spark, **{link.name: ", ".join(f"{h} string" for h in hashes) + f", {_META}"})
    for batch in _order_batches(spark, sf):
        lake.append(link.name, V.key_rows(batch, lake.read(link.name), link.hash_key, hashes))
    return lake.read(link.name)


_SPELLINGS = """
    select c_name as spelling, 'CRM.c_name' as src from customer
    union all select 'K' || c_custkey, 'CRM.alias' from customer
    union all select c_mktsegment, 'CRM.c_mktsegment' from customer
"""


@query(
    f"""select {sql_hash_key('spelling')} as "HUB_NAME_HSH_KEY", spelling as "NAME", src as "RECORD_SOURCE"
        from ({_SPELLINGS}) group by spelling, src"""
)
def salink_hub_spellings(spark: SparkSession, sf: str) -> DataFrame:
    hub = HubSpec("HUB_NAME", ("NAME",), {"c_name": "NAME", "alias": "NAME", "c_mktsegment": "NAME"}, same_as=True)
    customers = table(spark, sf, "customer").withColumn("alias", F.concat(F.lit("K"), F.col("c_custkey").cast("string")))
    lake = _lake(spark, HUB_NAME="HUB_NAME_HSH_KEY string, NAME string, RECORD_SOURCE string")
    lake.append("HUB_NAME", V.key_rows(V.map_hub(customers, hub, "CRM"), lake.read("HUB_NAME"), hub.hash_key, V.hub_hash(hub)))
    return lake.read("HUB_NAME")


@query(
    f"""
    with s as (select distinct nullif(c_mktsegment, 'BUILDING') as a, ' N' || c_nationkey as b from customer)
    select {sql_hash_raw('a')} as "HUB_NAME_HSH_KEY_1", {sql_hash_raw('b')} as "HUB_NAME_HSH_KEY_2",
           'SEGMENT' as "NAME_1_DEF", 'NATION' as "NAME_2_DEF",
           {sql_hash_key("coalesce(a, '')", 'b')} as "SALINK_NAME_HSH_KEY"
    from s
    """
)
def salink_load(spark: SparkSession, sf: str) -> DataFrame:
    spec = SameAsSpec(
        LinkSpec("SALINK_NAME", ("seg", "nat")),
        {"HUB_NAME_HSH_KEY_1": ("seg",), "HUB_NAME_HSH_KEY_2": ("nat",)},
        {"NAME_1_DEF": "SEGMENT", "NAME_2_DEF": "NATION"},
    )
    customers = table(spark, sf, "customer").select(
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("seg"),
        F.concat(F.lit(" N"), F.col("c_nationkey").cast("string")).alias("nat"),
    )
    columns = ["HUB_NAME_HSH_KEY_1", "HUB_NAME_HSH_KEY_2", "NAME_1_DEF", "NAME_2_DEF", "SALINK_NAME_HSH_KEY"]
    lake = _lake(spark, SALINK_NAME=", ".join(f"{c} string" for c in columns))
    rows = V.key_rows(V.define_same_as(customers, spec), lake.read("SALINK_NAME"), spec.link.hash_key, V.same_as_hashes(spec))
    lake.append("SALINK_NAME", rows)
    return lake.read("SALINK_NAME")


_SAT_DDL = (
    "HUB_USER_HSH_KEY string, SAT_EVENT_HSH_DIFF string, EXTRACT_DATE_TIME timestamp_ntz, event_type string,"
    " amount decimal(15,2), EXTRACT_DATE_PARTITION timestamp_ntz, RECORD_SOURCE string, LOAD_DATE_TIME timestamp_ntz"
)
_SAT_COLUMNS = """
    {key} as "HUB_USER_HSH_KEY",
    sha1(concat_ws(':', cast(ts as varchar), event_type, {amount}) || ':') as "SAT_EVENT_HSH_DIFF",
    ts as "EXTRACT_DATE_TIME", event_type, cast(value as decimal(15,2)) as amount,
    cast(date_trunc('day', ts) as timestamp) as "EXTRACT_DATE_PARTITION", 'EVENTS' as "RECORD_SOURCE"
""".format(key=sql_hash_key("user_id"), amount=sql_number_text("cast(value as decimal(15,2))"))


def _event_batch(spark: SparkSession, sf: str, where: str, load_ts: str) -> DataFrame:
    return (
        table(spark, sf, "events")
        .filter(where)
        .select(
            hash_key(["user_id"]).alias("HUB_USER_HSH_KEY"),
            F.col("ts").alias("EXTRACT_DATE_TIME"),
            "event_type",
            F.col("value").cast("decimal(15,2)").alias("amount"),
            F.date_trunc("day", "ts").cast("timestamp_ntz").alias("EXTRACT_DATE_PARTITION"),
            F.lit("EVENTS").alias("RECORD_SOURCE"),
            moment(load_ts).alias("LOAD_DATE_TIME"),
        )
    )


_FIRST, _SECOND = "ts < timestamp_ntz'2024-01-16'", "ts >= timestamp_ntz'2024-01-10'"
_L1, _L2 = "2024-02-01 00:00:00", "2024-02-02 00:00:00"


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
def sat_load_delta_check(spark: SparkSession, sf: str) -> DataFrame:
    lake = _lake(spark, SAT_EVENT=_SAT_DDL)
    lake.append("SAT_EVENT", V.satellite_rows(_event_batch(spark, sf, _FIRST, _L1), lake.read("SAT_EVENT"), direct=True))
    return V.satellite_rows(_event_batch(spark, sf, _SECOND, _L2), lake.read("SAT_EVENT"))


@query(
    f"""
    select {_SAT_COLUMNS}, timestamp '{_L2}' as "LOAD_DATE_TIME" from events where ts >= timestamp '2024-01-16'
    """
)
def sat_load_partition_filtered(spark: SparkSession, sf: str) -> DataFrame:
    lake = _lake(spark)
    lake.create("SAT_EVENT", _SAT_DDL, ["EXTRACT_DATE_PARTITION"])
    lake.append("SAT_EVENT", V.satellite_rows(_event_batch(spark, sf, _FIRST, _L1), lake.read("SAT_EVENT"), direct=True))
    rows = V.satellite_rows(
        _event_batch(spark, sf, _SECOND, _L2), lake.read("SAT_EVENT"), partition="EXTRACT_DATE_PARTITION"
    )
    return select_target(rows, [c.split()[0] for c in _SAT_DDL.replace("(15,2)", "").split(",")])


@query(
    """
    with first as (select user_id, event_type, value, cast(ts as date) as day from events where ts < timestamp '2024-01-12'),
    second as (select * from events where ts >= timestamp '2024-01-10')
    select count(*) as rows_in, count(distinct user_id) as users from first f
    where f.day in (select cast(ts as date) from second) or f.event_type in (select distinct event_type from second where event_type <> 'click')
    """
)
def partitions_of_two_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Known rows in the partitions that a batch touches by either of two columns, one given as text with a format."""
    events = table(spark, sf, "events")
    day = F.col("ts").cast("date")
    known = events.filter("ts < timestamp_ntz'2024-01-12'").select("user_id", "event_type", day.alias("day"))
    lake = _lake(spark)
    lake.create("SAT_KNOWN", known.schema, ["event_type", "day"])
    lake.append("SAT_KNOWN", known)
    batch = events.filter("ts >= timestamp_ntz'2024-01-10'").select(
        F.date_format("ts", "dd/MM/yyyy").alias("day"), F.when(F.col("event_type") != "click", F.col("event_type")).alias("event_type")
    )
    touched = in_partitions(lake.read("SAT_KNOWN"), batch, {"day": "dd/MM/yyyy", "event_type": None})
    return touched.agg(F.count("*").alias("rows_in"), F.countDistinct("user_id").alias("users"))


@query(f"""select {_SAT_COLUMNS}, timestamp '{_L1}' as "LOAD_DATE_TIME" from events""")
def sat_direct_insert(spark: SparkSession, sf: str) -> DataFrame:
    both = _event_batch(spark, sf, _FIRST, _L1).union(_event_batch(spark, sf, _SECOND, _L1))
    lake = _lake(spark, SAT_EVENT=_SAT_DDL)
    lake.append("SAT_EVENT", V.satellite_rows(both, lake.read("SAT_EVENT"), direct=True))
    return lake.read("SAT_EVENT")


@query(
    """select o_orderkey, cast(o_orderdate as date) as "ROW_INSERT_DTM", o_orderpriority from orders
       union all
       select o_orderkey, null, o_orderpriority from orders where o_orderstatus = 'P'"""
)
def history_direct_insert(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    dated = orders.withColumn("ROW_INSERT_DTM", F.date_format("o_orderdate", "yyyy-MM-dd"))
    odd = orders.filter("o_orderstatus = 'P'").withColumn("ROW_INSERT_DTM", F.lit("not a date"))
    lake = _lake(spark)
    lake.create("SAT_ORDER", "o_orderkey bigint, ROW_INSERT_DTM date, o_orderpriority string", area="hist_data")
    direct_insert(lake, "SAT_ORDER", parse_text_date(dated.unionByName(odd)))
    return lake.read("SAT_ORDER", "hist_data")


@query(
    """select p_partkey, p_name, p_brand, 'PARTS' as "RECORD_SOURCE", timestamp '2024-01-02 00:00:00' as "LOAD_DATE_TIME",
              timestamp '2024-01-01 06:00:00' as "EXTRACT_DATE_TIME" from part"""
)
def ref_reload(spark: SparkSession, sf: str) -> DataFrame:
    lake = _lake(spark)
    ddl = (
        "p_name string, p_partkey bigint, p_brand string, RECORD_SOURCE string, LOAD_DATE_TIME timestamp_ntz,"
        " EXTRACT_DATE_TIME timestamp_ntz"
    )
    lake.create("REF_PART", ddl)
    parts = table(spark, sf, "part")
    for load_ts, rows in (("2024-01-01 00:00:00", parts.filter("p_size > 25")), ("2024-01-02 00:00:00", parts)):
        lake.swap("REF_PART", V.reference_rows(rows, lake.columns("REF_PART"), "PARTS", load_ts, "2024-01-01 06:00:00"))
    return lake.read("REF_PART")


@query(
    """select o_orderkey, o_orderdate, o_orderdate < timestamp '1998-01-01' as was_history, true as refused from orders"""
)
def history_merge_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """A merge that breaks off after it appended, is refused when repeated, and then resumed: no row twice, copies kept."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lake = _lake(spark)
    for name, where in (("SAT_ORDER", ">="), ("SAT_ORDER_HIST", "<")):
        lake.create(name, orders.schema)
        lake.append(name, orders.filter(f"o_orderdate {where} timestamp_ntz'1998-01-01'"))
    refused = 0
    for attempt in (_Interrupted(spark, lake.env, lake.root), lake):
        try:
            merge_history(attempt, "SAT_ORDER", "SAT_ORDER_HIST")
        except InterruptedError:
            pass
        except UnfinishedMerge:
            refused += 1
    merge_history(lake, "SAT_ORDER", "SAT_ORDER_HIST", resume=True)
    copied = lake.read("SAT_ORDER_HIST_bkp").select("o_orderkey", F.lit(True).alias("was_history"))
    rows = lake.read("SAT_ORDER").unionByName(lake.read("SAT_ORDER_HIST")).join(copied, "o_orderkey", "left")
    return rows.select("o_orderkey", "o_orderdate", F.coalesce("was_history", F.lit(False)).alias("was_history"), F.lit(refused == 1).alias("refused"))


class _Interrupted(Lake):
    def truncate(self, table: str, area: str = "rawvault") -> None:
        raise InterruptedError("the driver was lost")


_ROW_TEXT = " || ".join(
    f"coalesce(length({t}) || ':' || {t}, '~')"
    for t in ("cast(o_orderkey as varchar)", "cast(o_custkey as varchar)", "o_orderstatus", "cast(o_orderdate as varchar)", "nullif(o_orderpriority, '5-LOW')")
)


@query(
    f"""
    with h as (select o_orderdate < timestamp '1998-01-01' as old, md5({_ROW_TEXT}) as h from orders),
    x as (select part, cast('0x' || substr(h, 1, 16) as ubigint) as a, cast('0x' || substr(h, 17, 16) as ubigint) as b from (
            select 'daily' as part, h from h where not old union all select 'history', h from h where old union all select 'total', h from h))
    select part, count(*) as row_count, cast(sum(a) as varchar) as sum_high, cast(sum(b) as varchar) as sum_low,
        lpad(lower(hex(bit_xor(a))), 16, '0') || lpad(lower(hex(bit_xor(b))), 16, '0') as xor, true as ok
    from x group by part
    """
)
def history_merge_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """A history table merged into its daily table; count and fingerprint of both before and of the whole after."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority")
    )
    lake = _lake(spark)
    lake.create("SAT_ORDER", orders.schema)
    lake.create("SAT_ORDER_HIST", orders.schema)
    lake.append("SAT_ORDER", orders.filter("o_orderdate >= timestamp_ntz'1998-01-01'"))
    lake.append("SAT_ORDER_HIST", orders.filter("o_orderdate < timestamp_ntz'1998-01-01'"))
    merge_history(lake, "SAT_ORDER", "SAT_ORDER_HIST")
    return reconcile_contents(lake.read("SAT_ORDER_bkp"), lake.read("SAT_ORDER_HIST_bkp"), lake.read("SAT_ORDER"))


@query(
    """select count(*) filter (where o_orderdate >= timestamp '1998-01-01') as daily_count,
              count(*) filter (where o_orderdate < timestamp '1998-01-01') as history_count, count(*) as total_count, true as ok
       from orders"""
)
def history_merge_counts(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    recent = F.col("o_orderdate") >= F.expr("timestamp_ntz'1998-01-01'")
    return reconcile(orders.filter(recent), orders.filter(~recent), orders)


@query(
    """select event_type as "FileName", cast(count(*) as varchar) as "Count" from events group by event_type
       union all select 'ALL', cast(count(*) as varchar) from events"""
)
def count_by_source(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumnRenamed("event_type", "RECORD_SOURCE")
    return extend_log(count_by(events), count_as(events, "ALL"))


@query("select count(distinct o_custkey) as customers, count(distinct cast(o_orderdate as date)) as days from orders where o_orderdate between timestamp '1996-01-01' and timestamp '1998-12-31'")
def count_distinct_in_range(spark: SparkSession, sf: str) -> DataFrame:
    span = table(spark, sf, "orders").filter("o_orderdate between timestamp_ntz'1996-01-01' and timestamp_ntz'1998-12-31'")
    return span.agg(
        F.countDistinct("o_custkey").alias("customers"), F.countDistinct(F.col("o_orderdate").cast("date")).alias("days")
    )


@query(
    """
    with prev as (select c_custkey, c_name, c_acctbal, 'old' as status, 1 as src from customer where c_mktsegment <> 'BUILDING'),
    neu as (select o_custkey, max(o_orderdate) as last_order, count(*) as n from orders group by o_custkey)
    select coalesce(c_custkey, o_custkey) as c_custkey, c_name, c_acctbal,
           case when o_custkey is null then status else cast(last_order as varchar) end as status,
           coalesce(src, 2) as src
    from prev full outer join neu on c_custkey = o_custkey
    """
)
def upsert_customers(spark: SparkSession, sf: str) -> DataFrame:
    target = table(spark, sf, "customer").filter("c_mktsegment <> 'BUILDING'").select(
        "c_custkey", "c_name", "c_acctbal", F.lit("old").alias("status"), F.lit(1).alias("src")
    )
    newest = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderdate").cast("string").alias("last_order")
    )
    insert = {"c_custkey": "c_custkey", "status": "last_order", "src": F.lit(2)}
    return upsert(target, newest, ["c_custkey"], {"status": "last_order"}, insert)


_WEEKS = """
    select cast(isoyear(o_orderdate) as varchar) as yr, cast(weekofyear(o_orderdate) as varchar) as wk,
           cast(min(cast(o_orderdate as date)) as varchar) as s, cast(max(cast(o_orderdate as date)) as varchar) as e,
           min(o_orderkey) as k, count(*) as n
    from orders group by 1, 2
"""


def _weeks(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .groupBy(
            F.extract(F.lit("YEAROFWEEK"), "o_orderdate").cast("string").alias("yr"),
            F.weekofyear("o_orderdate").cast("string").alias("wk"),
        )
        .agg(
            F.min(F.col("o_orderdate").cast("date")).cast("string").alias("s"),
            F.max(F.col("o_orderdate").cast("date")).cast("string").alias("e"),
            F.min("o_orderkey").alias("k"),
            F.count("*").alias("n"),
        )
    )


@query(
    f"""
    with w as ({_WEEKS})
    select yr as "YR", wk as "WK", s as "BILL_PD_START_DT", e as "BILL_PD_END_DT", timestamp '2024-01-02 00:00:00' as "ROW_INSERT_DTM"
    from w where yr >= '1997'
    union all
    select yr, wk, 'old', 'old', timestamp '2024-01-01 00:00:00' from w where yr < '1997'
    """
)
def upsert_week_calendar(spark: SparkSession, sf: str) -> DataFrame:
    weeks = _weeks(spark, sf)
    target = weeks.filter("yr < '1999'").select(
        F.col("yr").alias("YR"),
        F.col("wk").alias("WK"),
        F.lit("old").alias("BILL_PD_START_DT"),
        F.lit("old").alias("BILL_PD_END_DT"),
        moment("2024-01-01 00:00:00").alias("ROW_INSERT_DTM"),
    )
    wide = weeks.filter("yr >= '1997'").select(
        F.col("yr").alias("Year"), F.col("wk").alias("Week Id"), F.col("s").alias("Start"), F.col("e").alias("End")
    )
    return K.merge_weeks(target, wide, "2024-01-02 00:00:00")


# The codes repeat over the groups of one week, so that later groups update what earlier ones insert.
_DELIVERY_CODES = {"Prelim": ("'P'", "e"), "Revision 1": ("'R'", "e"), "Final": ("'P'", "s"), "Revision 2": ("'R'", "e")}


def _delivery_branches_sql() -> str:
    parts = [
        f"select {i} as br, {code} as typ, {when} as req, '{name} ' || wk as descr, s as frm, e as til, yr from w"
        for i, (name, (code, when)) in enumerate(_DELIVERY_CODES.items(), start=1)
    ]
    parts.append("select 5, 'H', e, 'Holiday ' || wk, null, null, yr from w where n > 8")
    return " union all ".join(parts)


def _wide_calendar(spark: SparkSession, sf: str) -> DataFrame:
    columns = {"Year": F.col("yr"), "Week Id": F.col("wk"), "Start": F.col("s"), "End": F.col("e")}
    for name, (code, when) in _DELIVERY_CODES.items():
        columns |= {
            f"{name} When": F.col(when),
            f"{name} Code": F.expr(code),
            f"{name} Description": F.concat(F.lit(f"{name} "), F.col("wk")),
            f"{name} Start": F.col("s"),
            f"{name} End": F.col("e"),
        }
    columns |= {
        "Holiday When": F.col("e"),
        "Holiday Code": F.when(F.col("n") > 8, F.lit("H")).otherwise(F.lit("n/a")),
        "Holiday Description": F.concat(F.lit("Holiday "), F.col("wk")),
    }
    return _weeks(spark, sf).select(*(c.alias(n) for n, c in columns.items()))


@query(
    f"""
    with w as ({_WEEKS}),
    rows_ as ({_delivery_branches_sql()}),
    tgt as (select distinct on (typ, req) typ, req, 'before' as descr, 'x' as frm, 'x' as til, '1900' as yr
            from rows_ where yr < '1997' and typ <> 'H'),
    agg as (select typ, req, arg_max(descr, br) as descr, max(br) as br, arg_min(yr, br) as yr from rows_ group by typ, req)
    select a.req as "REQ_BY", a.typ as "TYP", a.descr as "DLVRY_DESC", r.frm as "FRM_DT", r.til as "TO_DT",
           coalesce(t.yr, a.yr) as "SRC_YR", timestamp '2024-01-02 00:00:00' as "ROW_INSERT_DTM"
    from agg a join rows_ r on r.typ = a.typ and r.req = a.req and r.br = a.br
         left join tgt t on t.typ = a.typ and t.req = a.req
    """
)
def upsert_delivery_calendar(spark: SparkSession, sf: str) -> DataFrame:
    wide = _wide_calendar(spark, sf)
    known = K.delivery_rows(wide.filter("Year < '1997'")).filter("TYP <> 'H'").select("TYP", "REQ_BY").distinct()
    target = known.select(
        "REQ_BY",
        "TYP",
        F.lit("before").alias("DLVRY_DESC"),
        F.lit("x").alias("FRM_DT"),
        F.lit("x").alias("TO_DT"),
        F.lit("1900").alias("SRC_YR"),
        moment("2024-01-01 00:00:00").alias("ROW_INSERT_DTM"),
    )
    return K.merge_deliveries(target, wide, "2024-01-02 00:00:00")


@query(
    f"""
    with w as ({_WEEKS}),
    rows_ as ({_delivery_branches_sql()}),
    agg as (select typ, req, arg_max(descr, br) as descr, max(br) as br, arg_min(yr, br) as yr from rows_ group by typ, req)
    select a.req as "REQ_BY", a.typ as "TYP", a.descr as "DLVRY_DESC", r.frm as "FRM_DT", r.til as "TO_DT", a.yr as "SRC_YR",
           timestamp '2024-01-03 00:00:00' as "ROW_INSERT_DTM"
    from agg a join rows_ r on r.typ = a.typ and r.req = a.req and r.br = a.br
    """
)
def calendar_load(spark: SparkSession, sf: str) -> DataFrame:
    folder, exported = shared_folder(spark, "calendar"), shared_folder(spark, "exported")
    _wide_calendar(spark, sf).write.option("header", True).csv(folder)
    lake = Lake(spark, f"q{uuid.uuid4().hex[:12]}", shared_folder(spark, "lake"))
    stamp = "ROW_INSERT_DTM timestamp_ntz"
    lake.create(K.WEEK_TABLE, f"YR string, WK string, BILL_PD_START_DT string, BILL_PD_END_DT string, {stamp}", area="transform")
    lake.create(
        K.DELIVERY_TABLE,
        f"REQ_BY string, TYP string, DLVRY_DESC string, FRM_DT string, TO_DT string, SRC_YR string, {stamp}",
        area="transform",
    )
    for load_ts in ("2024-01-02 00:00:00", "2024-01-03 00:00:00"):  # the second load updates every row
        K.load_calendar(lake, folder, load_ts, exported)
    return spark.read.parquet(f"{exported}/{K.DELIVERY_TABLE.lower()}")


_FEED = {
    "Source": "ERP",
    "TableName": "ORDERS",
    "RecordSource": "ERP.ORDERS",
    "logicalenv": "q",
    "Prop_0": "ORDER_NO",
    "Prop_1": "CUSTOMER",
    "Prop_2": "CHANGE_TYPE",
    "Prop_3": "DM_TIMESTAMP",
    "Prop_4": "PRIORITY",
    "Prop_5": "AMOUNT",
    "HubCount": "2",
    "Hub_1_Name": "HUB_ORDER",
    "HUB_1_INFO": '{"HUB_ORDER": ["ORDER_NO"], "key_mapping": {}}',
    "Hub_2_Name": "HUB_CUSTOMER",
    "HUB_2_INFO": '{"HUB_CUSTOMER": ["CUSTOMER_NO"], "key_mapping": {"CUSTOMER": "CUSTOMER_NO"}}',
    "LinkCount": "1",
    "Link_1_Name": "LINK_ORDER_CUSTOMER",
    "LINK_INFO": '{"LINK_ORDER_CUSTOMER": ["ORDER_NO", "CUSTOMER_NO"]}',
    "SatCount": "1",
    "Sat_1_Name": "SAT_ORDER",
    "TRANSFORM_SUBSTRING": '{"PRIORITY": {"targetcolumn": "PRIORITY_CODE", "init": 1, "length": 1}}',
}


@query(
    f"""
    with o as (select * from orders where o_orderstatus <> 'P')
    select 'HUB_ORDER' as tbl, count(distinct o_orderkey) as row_count, min({sql_hash_key('o_orderkey')}) as low from o
    union all select 'HUB_CUSTOMER', count(distinct o_custkey), min({sql_hash_key('o_custkey')}) from o
    union all select 'LINK_ORDER_CUSTOMER', count(distinct (o_orderkey, o_custkey)), min({sql_hash_key('o_orderkey', 'o_custkey')}) from o
    union all select 'SAT_ORDER', count(*),
        min(sha1(concat_ws(':', o_orderstatus, cast(o_orderdate as varchar), substr(o_orderpriority, 1, 1),
                           {sql_number_text('cast(o_totalprice as decimal(15,2))')}) || ':')) from o
    """
)
def vault_feed_load(spark: SparkSession, sf: str) -> DataFrame:
    lake = _lake(spark)
    meta = _META
    lake.create("HUB_ORDER", f"HUB_ORDER_HSH_KEY string, ORDER_NO bigint, {meta}")
    lake.create("HUB_CUSTOMER", f"HUB_CUSTOMER_HSH_KEY string, CUSTOMER_NO bigint, {meta}")
    lake.create(
        "LINK_ORDER_CUSTOMER",
        f"LINK_ORDER_CUSTOMER_HSH_KEY string, HUB_ORDER_HSH_KEY string, HUB_CUSTOMER_HSH_KEY string, {meta}",
    )
    lake.create(
        "SAT_ORDER",
        "HUB_ORDER_HSH_KEY string, SAT_ORDER_HSH_DIFF string, CHANGE_TYPE string, EXTRACT_DATE_TIME timestamp_ntz,"
        f" PRIORITY_CODE string, AMOUNT decimal(15,2), {meta}",
    )
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Prop_0"),
        F.col("o_custkey").alias("Prop_1"),
        F.when(F.col("o_orderstatus") == "P", F.lit("B")).otherwise(F.col("o_orderstatus")).alias("Prop_2"),
        F.col("o_orderdate").alias("Prop_3"),
        F.col("o_orderpriority").alias("Prop_4"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("Prop_5"),
    )
    config = FeedConfig.from_parameters(_FEED)
    for load_ts in ("2024-01-01 00:00:00", "2024-01-02 00:00:00"):  # the second run adds nothing
        V.VaultFeed(lake, config, load_ts).run(raw)

    def summary(name: str, column: str) -> DataFrame:
        return lake.read(name).agg(F.count("*").alias("row_count"), F.min(column).alias("low")).select(
            F.lit(name).alias("tbl"), "row_count", "low"
        )

    return (
        summary("HUB_ORDER", "HUB_ORDER_HSH_KEY")
        .union(summary("HUB_CUSTOMER", "HUB_CUSTOMER_HSH_KEY"))
        .union(summary("LINK_ORDER_CUSTOMER", "LINK_ORDER_CUSTOMER_HSH_KEY"))
        .union(summary("SAT_ORDER", "SAT_ORDER_HSH_DIFF"))
    )
