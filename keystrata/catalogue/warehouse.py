"""SQL templates, warehouse staging and table contracts over the given tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystrata.catalogue.registry import query, sql_hash_key, sql_hash_raw, table
from keystrata.functions.hashing import hash_key
from keystrata.functions.times import moment
from keystrata.plans.contracts import CONTRACTS, conform, create_table, violations, with_surrogate_keys
from keystrata.plans.template import job_params, run_sql
from keystrata.plans.warehouse import long_texts, to_warehouse
from keystrata.session import shared_folder
from keystrata.sources.tables import Lake


@query(
    """select o_orderpriority, count(*) as orders, sum(cast(o_totalprice as decimal(15,2)))::decimal(25,2) as total
       from orders where o_orderdate < timestamp '1998-06-01' and o_orderstatus <> 'F' group by 1"""
)
def template_sql(spark: SparkSession, sf: str) -> DataFrame:
    view = f"orders_{uuid.uuid4().hex[:8]}"
    table(spark, sf, "orders").createOrReplaceTempView(view)
    settings = {"LogicalEnv": "tst", "SqlParams": f'{{"orders": "{view}"}}'}
    params = job_params(settings, "1998-06-01", dt.date(2024, 1, 1))
    text = """
        SELECT o_orderpriority, count(*) AS orders, cast(sum(cast(o_totalprice AS decimal(15,2))) AS decimal(25,2)) AS total
        FROM ${orders}
        WHERE o_orderdate < timestamp_ntz'${run_date}' AND o_orderstatus <> :deleted
        GROUP BY o_orderpriority;
    """
    return run_sql(spark, text, params, deleted="F")


@query(
    f"""select c_custkey, c_name, c_mktsegment, {sql_hash_raw('c_custkey')} as "HSH_KEY",
               {sql_hash_raw('c_custkey', 'c_name', 'c_mktsegment')} as "HSH_DIFF" from customer"""
)
def warehouse_staging(spark: SparkSession, sf: str) -> DataFrame:
    lake = Lake(spark, f"q{uuid.uuid4().hex[:12]}", shared_folder(spark, "lake"))
    view = f"customer_{uuid.uuid4().hex[:8]}"
    table(spark, sf, "customer").createOrReplaceTempView(view)
    settings = {
        "LogicalEnv": lake.env,
        "Sql": f"SELECT c_custkey, c_name, c_mktsegment FROM {view}",
        "StagingTable": "STG_CUSTOMER",
        "BusinessKeys": "c_custkey",
    }
    to_warehouse(lake, settings, "1900-01-01", buckets=8)
    return lake.read("STG_CUSTOMER", "dimlayer")


@query("select doc_id, 'text' as long_columns from documents where length(text) > 2000")
def warehouse_long_texts(spark: SparkSession, sf: str) -> DataFrame:
    found = long_texts(table(spark, sf, "documents"))
    return found.select("doc_id", F.array_join("long_columns", ",").alias("long_columns"))


def _customer_stage(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("NMI"),
        F.col("c_name").alias("CUSTOMER_NAME1"),
        F.col("c_mktsegment").alias("CURRENT_RECORD_FLAG"),
        F.lit("2024-01-31").alias("CUSTOMER_ADDRESS_FROM_DT"),
        F.col("c_name").alias("CUSTOMER_ADDRESS_TO_DT"),
        moment("2024-01-31 10:11:12.75").alias("ROW_EFFECTIVE_DTM"),
        hash_key(["c_custkey"]).alias("HSH_KEY"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("HSH_DIFF"),
    )


_CUSTOMER_GIVEN = {
    "CUSTOMER_SK": f"row_number() over (order by {sql_hash_key('c_custkey')}) + 100",
    "NMI": "cast(c_custkey as varchar)",
    "CUSTOMER_NAME1": "c_name",
    "CURRENT_RECORD_FLAG": "c_mktsegment",
    "CUSTOMER_ADDRESS_FROM_DT": "date '2024-01-31'",
    "ROW_EFFECTIVE_DTM": "timestamp '2024-01-31 10:11:13'",  # .75 of a second is rounded up
    "HSH_KEY": sql_hash_key("c_custkey"),
    "HSH_DIFF": "nullif(c_mktsegment, 'BUILDING')",
}
_SQL_TYPES = {"string": "varchar", "bigint": "bigint", "int": "int", "date": "date", "timestamp_ntz": "timestamp"}


def _contract_sql(name: str, given: dict[str, str], source: str) -> str:
    columns = [
        f'{given.get(f.name, f"cast(null as {_SQL_TYPES[f.spark_type.simpleString()]})")} as "{f.name}"'
        for f in CONTRACTS[name].fields
    ]
    return f"select {', '.join(columns)} from {source}"


@query(_contract_sql("DIM_CUSTOMER", _CUSTOMER_GIVEN, "customer"))
def conform_dim_customer(spark: SparkSession, sf: str) -> DataFrame:
    contract = CONTRACTS["DIM_CUSTOMER"]
    staged = with_surrogate_keys(_customer_stage(spark, sf), contract.identity, last=100)
    return conform(staged, contract)


@query(
    """select 'CURRENT_RECORD_FLAG' as column_name, 'varchar(1)' as rule, count(*) as row_count from customer having count(*) > 0
       union all
       select 'HSH_DIFF', 'not null', count(*) from customer where c_mktsegment = 'BUILDING' having count(*) > 0
       union all
       select 'CUSTOMER_ADDRESS_TO_DT', 'not convertible', count(*) from customer having count(*) > 0"""
)
def contract_violations(spark: SparkSession, sf: str) -> DataFrame:
    return violations(_customer_stage(spark, sf), CONTRACTS["DIM_CUSTOMER"])


_ORDER_GIVEN = {
    "SERVICE_ORDER_TYPE_SK": "cast(substr(o_orderpriority, 1, 1) as bigint)",
    "ORDER_NUMBER": "cast(o_orderkey as varchar)",
    "NMI": "cast(o_custkey as varchar)",
    "ORDER_STATUS_CODE": "o_orderstatus",
    "ORDER_CREATED_ON_DTM": "o_orderdate",
    "RELEASE_DT": "cast(o_orderdate as date)",
    "RUN_DTM": "timestamp '2024-01-01 00:00:00'",
}


@query(_contract_sql("FACT_SERVICE_ORDER", _ORDER_GIVEN, "orders"))
def conform_fact(spark: SparkSession, sf: str) -> DataFrame:
    lake = Lake(spark, f"q{uuid.uuid4().hex[:12]}", shared_folder(spark, "lake"))
    contract = CONTRACTS["FACT_SERVICE_ORDER"]
    create_table(lake, contract)
    staged = table(spark, sf, "orders").select(
        F.substring("o_orderpriority", 1, 1).alias("SERVICE_ORDER_TYPE_SK"),
        F.col("o_orderkey").alias("ORDER_NUMBER"),
        F.col("o_custkey").alias("NMI"),
        F.col("o_orderstatus").alias("ORDER_STATUS_CODE"),
        F.col("o_orderdate").alias("ORDER_CREATED_ON_DTM"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("RELEASE_DT"),
        F.lit("2024-01-01 00:00:00").alias("RUN_DTM"),
    )
    lake.append(contract.table, conform(staged, contract), "dimlayer")
    return lake.read(contract.table, "dimlayer")


@query(
    f"""select c_custkey, {sql_hash_key('c_custkey')} as "HSH_KEY",
               row_number() over (order by {sql_hash_key('c_custkey')}) + 41 as sk from customer"""
)
def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", hash_key(["c_custkey"]).alias("HSH_KEY"))
    return with_surrogate_keys(customers, "sk", last=41)


@query(
    """select c_mktsegment as "HSH_KEY", count(*) as rows_numbered, min(sk) as first_sk, max(sk) as last_sk from (
         select nullif(nullif(c_mktsegment, 'BUILDING'), 'MACHINERY') as c_mktsegment,
           row_number() over (order by nullif(nullif(c_mktsegment, 'BUILDING'), 'MACHINERY') nulls first) + 7 as sk from customer)
       group by 1"""
)
def surrogate_keys_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """A few keys for all rows, two fifths of them NULL: every row gets a number, in the order of keys."""
    key = F.nullif(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.lit("MACHINERY"))
    numbered = with_surrogate_keys(table(spark, sf, "customer").select("c_custkey", key.alias("HSH_KEY")), "sk", last=7)
    return numbered.groupBy("HSH_KEY").agg(F.count("*").alias("rows_numbered"), F.min("sk").alias("first_sk"), F.max("sk").alias("last_sk"))


@query(
    """select s_suppkey, 'im' || 'x' || '/ext/SAT_SUPPLIER' as place, s_name, cast(s_acctbal as double) as s_acctbal from supplier"""
)
def external_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A table with a base folder of its own, exported for readers outside Spark and read back as plain files."""
    base, folder = shared_folder(spark, "elsewhere"), f"{shared_folder(spark, 'external')}/imx/ext/SAT_SUPPLIER"
    lake = Lake(spark, f"q{uuid.uuid4().hex[:12]}", shared_folder(spark, "lake"), {"SAT_SUPPLIER": f"{base}/"})
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", F.col("s_acctbal").cast("double").alias("s_acctbal"))
    lake.create("SAT_SUPPLIER", rows.schema)
    lake.append("SAT_SUPPLIER", rows)
    assert all(base.split(":")[-1] in f for f in lake.read("SAT_SUPPLIER").inputFiles())
    lake.export("SAT_SUPPLIER", folder)
    place = F.regexp_extract(F.input_file_name(), "(imx/ext/[^/]+)/", 1)
    return spark.read.parquet(folder).select("s_suppkey", place.alias("place"), "s_name", "s_acctbal")


def _dimension_stage(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers under names that several dimensions share."""
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("NMI"),
        F.col("s_name").alias("SERIAL_NUMBER"),
        F.lit("Y").alias("CURRENT_RECORD_FLAG"),
        F.lit("2024-01-31 10:11:12").alias("ROW_EFFECTIVE_DTM"),
        hash_key(["s_suppkey"]).alias("HSH_KEY"),
        hash_key(["s_name"]).alias("HSH_DIFF"),
    )


#: Of each dimension: columns that the stage gives, and how many columns the contract declares (fixed values).
_DIMENSIONS = ("DIM_CONNECTION_POINT_DEVICE", "DIM_METER", "DIM_CONNECTION_POINT", "DIM_MESH_NETWORK_DEVICE", "DIM_METER_CONFIG")
_GIVEN = {
    "NMI": "cast(s_suppkey as varchar)",
    "SERIAL_NUMBER": "s_name",
    "CURRENT_RECORD_FLAG": "'Y'",
    "ROW_EFFECTIVE_DTM": "'2024-01-31 10:11:12'",
    "HSH_KEY": sql_hash_key("s_suppkey"),
    "HSH_DIFF": sql_hash_key("s_name"),
}


def _dimension_rows(name: str):
    given = [c for c in (f.name for f in CONTRACTS[name].fields) if c in _GIVEN]
    values = " union all ".join(f"select s_suppkey, '{c}' as column_name, {_GIVEN[c]} as value from supplier" for c in given)

    def run(spark: SparkSession, sf: str) -> DataFrame:
        """Conformed rows, written to the created table and read back, one row per given value."""
        contract = CONTRACTS[name]
        lake = Lake(spark, f"q{uuid.uuid4().hex[:12]}", shared_folder(spark, "lake"))
        create_table(lake, contract)
        lake.append(name, conform(with_surrogate_keys(_dimension_stage(spark, sf), contract.identity or "SK"), contract), "dimlayer")
        rows = lake.read(name, "dimlayer")
        empty = [c for c in rows.columns if c not in _GIVEN and c != contract.identity]
        assert rows.columns == [f.name for f in contract.fields]
        keys = table(spark, sf, "supplier").select("s_suppkey", hash_key(["s_suppkey"]).alias("HSH_KEY"))
        pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in given))
        kept = rows.filter(F.concat_ws("", *(F.col(c).cast("string") for c in empty)) == "") if empty else rows
        return kept.select("HSH_KEY", F.explode(pairs).alias("p")).join(keys, "HSH_KEY").select("s_suppkey", "p.column_name", "p.value")

    run.__name__ = f"conform_{name.lower()}"
    return query(values)(run)


for _name in _DIMENSIONS:
    _dimension_rows(_name)
