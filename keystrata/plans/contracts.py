"""Declared layouts of the warehouse tables and their checks."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystrata.functions.hashing import quoted
from keystrata.functions.times import NTZ
from keystrata.session import written
from keystrata.sources.tables import Lake

# Distribution column and columns of the dimensions and the fact, in table order.
_LAYOUTS = {
    "DIM_CONNECTION_POINT_DEVICE": ("NMI", """
        CONNECTION_POINT_DEVICE_SK bigint not null identity
        NMI varchar(512) not null
        INSTALLED_ON_DT date
        REMOVED_ON_DT date
        SERIAL_NUMBER varchar(512)
        EQUIPMENT_NUMBER varchar(512)
        DEVICE_CATEGORY varchar(512)
        CURRENT_RECORD_FLAG varchar(1) not null
        ROW_EFFECTIVE_DTM datetime2(0) not null
        ROW_EXPIRATION_DTM datetime2(0) not null
        HSH_KEY varchar(512) not null
        HSH_DIFF varchar(512) not null
        RECORD_INSERT_DTM datetime2(0) not null
        RECORD_UPDATE_DTM datetime2(0) not null
    """),
    "DIM_METER": ("SERIAL_NUMBER", """
        METER_SK bigint not null identity
        SERIAL_NUMBER varchar(512)
        TIMELINE_FROM_DT date
        TIMELINE_TO_DT date
        EQUIPMENT_NUMBER varchar(512)
        MODEL_NUMBER varchar(512)
        CONSTRUCTION_YEAR int
        MATERIAL_NUMBER varchar(512)
        MANUFACTURER_NAME varchar(512)
        STOCK_BATCH_TYPE varchar(512)
        MATERIAL_DESC varchar(512)
        DEVICE_CATEGORY varchar(512)
        DEVICE_CATEGORY_DESC varchar(512)
        METER_PREFIX_CODE varchar(512)
        METER_PREFIX_FROM_DT date
        METER_PREFIX_TO_DT date
        METER_PROGRAM_CODE varchar(512)
        METER_PROGRAM_FROM_DT date
        METER_PROGRAM_TO_DT date
        READ_TYPE_CODE varchar(512)
        READ_TYPE_CODE_FROM_DT date
        READ_TYPE_CODE_TO_DT date
        INSTALL_TYPE_CODE varchar(512)
        INSTALL_TYPE_CODE_FROM_DT date
        INSTALL_TYPE_CODE_TO_DT date
        WARRANTY_FROM_DT date
        WARRANTY_TO_DT date
        WARRANTY_DELETION_FLAG varchar(512)
        CURRENT_RECORD_FLAG varchar(1)
        ROW_EFFECTIVE_DTM datetime2(0)
        ROW_EXPIRATION_DTM datetime2(0)
        HSH_KEY varchar(512) not null
        HSH_DIFF varchar(512) not null
        RECORD_INSERT_DTM datetime2(0)
        RECORD_UPDATE_DTM datetime2(0)
    """),
    "DIM_CONNECTION_POINT": ("NMI", """
        CONNECTION_POINT_SK bigint not null identity
        TIMELINE_FROM_DT date not null
        TIMELINE_TO_DT date not null
        NMI varchar(512) not null
        NMI_FROM_DT date not null
        NMI_TO_DT date not null
        NMI_STATUS varchar(512)
        NMI_STATUS_FROM_DT date
        NMI_STATUS_TO_DT date
        NMI_CLASSIFICATION varchar(512)
        NMI_CLASSIFICATION_FROM_DT date
        NMI_CLASSIFICATION_TO_DT date
        DAILY_LOSS_FACTOR_CODE varchar(512)
        DLF_FROM_DT date
        DLF_TO_DT date
        TNI varchar(512)
        TNI_FROM_DT date
        TNI_TO_DT date
        TARIFF_CODE varchar(512)
        TARIFF_DESC varchar(512)
        TARIFF_FROM_DT date
        TARIFF_TO_DT date
        CUSTOMER_CLASS varchar(512)
        BILLING_CLASS_CODE varchar(512)
        METER_READING_ROUTE_CODE varchar(512)
        DIVISION varchar(512)
        CUSTOMER_CLASSIFICATION varchar(512)
        CUSTOMER_THRESHOLD varchar(512)
        CUSTOMER_THRESHOLD_FROM_DT date
        TNI_CODE_2 varchar(512)
        PARENT_NETWORK varchar(512)
        HAZARD_TYPE_CODE varchar(512)
        SUPPLY_GUARANTEE_CODE varchar(512)
        RELEASE_STATUS_CODE varchar(512)
        EMBEDDED_NETWORK_ID varchar(512)
        EMBEDDED_NETWORK_DESC varchar(512)
        NMA_NETWORK_CRITICAL_CODE varchar(512)
        NMA_NETWORK_CRITICAL_DESC varchar(512)
        REMOTE_SERV_DISABLED_FLAG varchar(512)
        REMOTE_SERV_DISABLED_FROM_DT date
        REMOTE_SERV_DISABLED_TO_DT date
        COMMS_FAULT_ORD_EXCL_FLAG varchar(512)
        MOVE_IN_DT date
        MOVE_IN_REVERSED_FLAG varchar(512)
        INSTALLATION_SERVICE_DETAILS varchar(512)
        SUBSTATION_ID varchar(512)
        SUBSTATION_NAME varchar(512)
        SOLAR_CAPACITY varchar(512)
        NMI11 varchar(512)
        INSTALLATION_ID varchar(512)
        PREMISE_ID varchar(512)
        CONTRACT_ID varchar(512)
        CURRENT_RECORD_FLAG varchar(1)
        ROW_EFFECTIVE_DTM datetime2(0)
        ROW_EXPIRATION_DTM datetime2(0)
        HSH_KEY varchar(512) not null
        HSH_DIFF varchar(512) not null
        RECORD_INSERT_DTM datetime2(0) not null
        RECORD_UPDATE_DTM datetime2(0)
    """),
    "FACT_SERVICE_ORDER": ("ORDER_NUMBER", """
        SERVICE_ORDER_TYPE_SK bigint not null
        SWITCH_DOCUMENT_SK bigint
        ORDER_NUMBER varchar(512)
        NMI varchar(512)
        SWITCH_DOCUMENT_NUMBER varchar(512)
        ORDER_TYPE_CODE varchar(512)
        ORDER_TEXT varchar(512)
        ORDER_CREATION_FLAG varchar(512)
        ORDER_CREATED_ON_DTM datetime2(7)
        ORDER_CREATED_BY varchar(512)
        ORDER_CHANGED_ON_DTM datetime2(7)
        ORDER_CHANGED_BY varchar(512)
        ORDER_STATUS_CODE varchar(256)
        ORDER_STATUS_DESC varchar(512)
        ORDER_STATUS_LIST varchar(512)
        ORDER_SYSTEM_STATUS_LIST varchar(512)
        ORDER_ACTIVITY_TYPE_DESC varchar(512)
        RELEASE_FLAG varchar(256)
        RELEASE_DT date
        TECO_FLAG varchar(256)
        TECO_DT date
        CLOSED_FLAG varchar(256)
        CLOSED_DT date
        COMPLETION_PENDING_FLAG varchar(256)
        COMPLETION_PENDING_RESPONSE_FLAG varchar(256)
        DELETION_FLAG varchar(256)
        OBJECT_NUMBER varchar(512)
        SCHEDULED_DT date
        ACTION_TYPE varchar(512)
        PRIORITY_TYPE_CODE varchar(256)
        SERVICE_PROVIDER_ID varchar(512)
        RETAILER_SERVICE_ORDER_NUMBER varchar(512)
        DEENERGISATION_REASON varchar(512)
        CONFIRMED_DEENERGISATION_FLAG varchar(512)
        SERVICE_TIME varchar(512)
        CUST_PREFERRED_DTM varchar(512)
        SUNSET_DTM datetime2(7)
        BASIC_START_DTM datetime2(7)
        ACTUAL_START_DTM datetime2(7)
        SCHEDULED_RELEASE_DT date
        ACTUAL_RELEASE_DT date
        SCHEDULED_START_DTM datetime2(7)
        SCHEDULED_FINISH_DTM datetime2(7)
        BASIC_FINISH_DTM datetime2(7)
        CONFIRMED_ORDER_FINISH_DTM datetime2(7)
        ERP_ORDER_NUMBER varchar(512)
        SKIP_CODE varchar(512)
        TROUBLE_CODE varchar(512)
        WORK_DONE_BY varchar(512)
        RP varchar(512)
        MDP varchar(512)
        MPB varchar(512)
        MPC varchar(512)
        CUSTOMER_TYPE varchar(512)
        INSTALLATION_TYPE varchar(512)
        CUSTOMER_CONSULTATION_REQUIRED_FLAG varchar(512)
        ATTENDANCE_REQUIRED_FLAG varchar(512)
        REQUIRED_METERING_TYPE varchar(512)
        SWITCHING_SERVICE_REQUIRED_FLAG varchar(512)
        PROPOSED_TARIFF_CODE varchar(512)
        METER_INSTALL_CODE varchar(512)
        SUPPLY_PHASES varchar(512)
        ISD_DETAILS varchar(512)
        EMBEDDED_NETWORK_NAME varchar(512)
        FORM_REFERENCE varchar(512)
        FORM_NUMBER varchar(512)
        SAFETY_CERTIFICATE_ID varchar(512)
        SAFETY_CERTIFICATE_SENT_METHOD varchar(512)
        APPOINTMENT_REFERENCE varchar(512)
        AVERAGE_DAILY_LOAD varchar(512)
        MAXIMUM_DEMAND varchar(512)
        NUMBER_OF_REQUIREMENTS varchar(512)
        TASK_LIST_TYPE_CODE varchar(512)
        APPLICATION_OF_TASK_LIST varchar(512)
        ROUTING_NUMBER varchar(512)
        LAST_SCHEDULING_DT date
        SCHEDULING_TYPE_CODE varchar(512)
        SCHEDULING_REDUCTION_FLAG varchar(256)
        FORECAST_SCHEDULING_TYPE_CODE varchar(512)
        BREAKS_ALLOWED_FLAG varchar(256)
        CONDITION_TABLE_USAGE_CODE varchar(512)
        APPLICATION_CODE varchar(512)
        COSTING_SHEET_CODE varchar(512)
        OPERATION_COUNTER varchar(512)
        ACTUAL_OP_START_DT date
        ACTUAL_OP_FINISH_DT date
        ACTUAL_START_EXECUTION_DTM datetime2(7)
        ACTUAL_FINISH_SETUP_DTM datetime2(7)
        ACTUAL_START_PROCESSING_DTM datetime2(7)
        ACTUAL_FINISH_PROCESSING_DTM datetime2(7)
        ACTUAL_START_TEARDOWN_DTM datetime2(7)
        ACTUAL_FINISH_EXECUTION_DTM datetime2(7)
        SOLD_TO_PARTY varchar(512)
        SHIP_TO_PARTY varchar(512)
        RETAILER_ID varchar(512)
        RESERVATION_ITEM_NUMBERS varchar(512)
        REQUIREMENT_TYPE_CODE varchar(512)
        RESERVATION_MATERIAL_NUMBER varchar(512)
        BATCH_NUMBER varchar(512)
        REQUIREMENT_DT varchar(512)
        REQUIREMENT_QUANTITY varchar(512)
        LATEST_REQUIREMENT_DT varchar(512)
        OBJECT_NUMBERS_LIST varchar(512)
        FUNCTIONAL_LOCATION varchar(512)
        CIM_OBJECT_TYPE_CODE varchar(512)
        WORKCENTER_OBJECT_ID varchar(512)
        CUSTOMER_NUMBER varchar(512)
        OBJECT_LIST_NUMBER varchar(512)
        REFERENCE_DTM datetime2(7)
        PROCESSING_PHASE_CODE varchar(512)
        ACTIVITY_TYPE_CODE varchar(512)
        NOTIFICATION_NUMBER varchar(512)
        MAINTENANCE_ORDER_CATEGORY_CODE varchar(512)
        PLANNING_FLAG varchar(256)
        SERIAL_NUMBER varchar(512)
        MAINTENANCE_MATERIAL_NUMBER varchar(512)
        SCENARIO_CATEGORY_CODE varchar(512)
        WORK_CENTRE_CODE varchar(512)
        WORK_CENTRE_USER_NAME varchar(512)
        WORK_CENTRE_DESC varchar(512)
        RUN_DTM datetime
        RECORD_INSERT_DTM datetime
        RECORD_UPDATE_DTM datetime
        HSH_KEY varchar(512)
        HSH_DIFF varchar(512)
    """),
    "DIM_CUSTOMER": ("NMI", """
        CUSTOMER_SK bigint not null identity
        NMI varchar(512)
        ADDRESS_NUMBER varchar(512)
        PARTNER varchar(512)
        CUSTOMER_ADDRESS_FROM_DT date
        CUSTOMER_ADDRESS_TO_DT date
        FIRST_NAME varchar(512)
        LAST_NAME varchar(512)
        CUSTOMER_NAME1 varchar(512)
        CUSTOMER_NAME2 varchar(512)
        CUSTOMER_NAME3 varchar(512)
        CUSTOMER_NAME4 varchar(512)
        EMAIL_ID varchar(512)
        HOUSE_NUMBER varchar(512)
        LOT_NUMBER varchar(512)
        FLAT_UNIT_NUMBER varchar(512)
        FLOOR varchar(512)
        STREET varchar(512)
        LOCATION varchar(512)
        CITY_SUBURB varchar(512)
        STATE varchar(512)
        REGION varchar(512)
        COUNTRY varchar(512)
        POST_CODE varchar(512)
        ADDRESS varchar(512)
        ADDRESS_LINE1 varchar(512)
        ADDRESS_LINE2 varchar(512)
        ADDRESS_LINE3 varchar(512)
        ADDRESS_KIND varchar(512)
        TEL_NUMBER1 varchar(512)
        TEL_NUMBER2 varchar(512)
        PERSNUMBER varchar(512)
        CONSNUMBER varchar(512)
        CURRENT_RECORD_FLAG varchar(1)
        ROW_EFFECTIVE_DTM datetime2(0)
        ROW_EXPIRATION_DTM datetime2(0)
        HSH_KEY varchar(512) not null
        HSH_DIFF varchar(512) not null
        RECORD_INSERT_DTM datetime2(0)
        RECORD_UPDATE_DTM datetime2(0)
    """),
    "DIM_MESH_NETWORK_DEVICE": ("SERIAL_NUMBER", """
        MESH_NETWORK_DEVICE_SK bigint not null identity
        NET_DEVICE_ID bigint not null
        NIC_MAC_ID varchar(512) not null
        SERIAL_NUMBER varchar(512) not null
        SEGMENT_ID bigint
        DEVICE_SUBTYPE_ID bigint
        DEVICE_SUBTYPE_DESC varchar(512)
        DEVICE_TYPE_ID bigint
        DEVICE_TYPE_DESC varchar(512)
        MASTER_RESOURCE_ID varchar(512)
        DEVICE_STATE_ID bigint
        DEVICE_STATE_DESC varchar(512)
        PREVIOUS_DEVICE_STATE_ID bigint
        PREVIOUS_DEVICE_STATE_DESC varchar(512)
        UTILITY_DEVICE_STATE_ID bigint
        UTILITY_DEVICE_STATE_DESC varchar(512)
        UTILITY_NETWORK_STATE_ID bigint
        UTILITY_NETWORK_STATE_DESC varchar(512)
        NETWORK_DEVICE_NAME varchar(128)
        NETWORK_BACKBONE_FLAG bigint
        SUSPECT_FLAG bigint
        SUSPECT_REASON varchar(4000)
        TIME_ZONE_ID bigint
        TIME_ZONE_DESC varchar(512)
        NETWORK_DEVICE_TYPE_ID bigint
        MANUFACTURE_DTM datetime2(0)
        HARDWARE_CONFIGURATION varchar(4000)
        SOFTWARE_CONFIGURATION varchar(4000)
        LINK_STATE_FLAG bigint
        REPROVISION_DTM datetime2(0)
        INSERT_DTM datetime2(0)
        UPDATE_DTM datetime2(0)
        SOCKET_AP_FLAG bigint
        CURRENT_RECORD_FLAG varchar(1) not null
        ROW_EFFECTIVE_DTM datetime2(0) not null
        ROW_EXPIRATION_DTM datetime2(0) not null
        HSH_KEY varchar(512) not null
        HSH_DIFF varchar(512) not null
        RECORD_INSERT_DTM datetime2(0) not null
        RECORD_UPDATE_DTM datetime2(0) not null
    """),
    "DIM_METER_CONFIG": ("METER_CONFIG_ID", """
        METER_CONFIG_SK bigint not null identity
        METER_CONFIG_ID varchar(200)
        DIVISION_CODE varchar(2)
        TARIFF_CODE varchar(10)
        AMI_TARIFF_CODE varchar(10)
        ADV_MTR_SYS_CODE varchar(4)
        ADV_MTR_CAP_GRP_CODE varchar(4)
        CUSTOMER_CLASSIFICATION varchar(4)
        INSTALL_TYPE_CODE varchar(10)
        AMI_STATUS_CODE varchar(12)
        READ_TYPE_CODE1 varchar(8)
        READ_TYPE_CODE2 varchar(8)
        READ_TYPE_CODE3 varchar(8)
        METERPREFIX_PROG varchar(30)
        CONT_LOAD_FLAG varchar(1)
        PHASE varchar(6)
        DEDICATED_CIRCUIT_FLAG varchar(15)
        SAP_REGISTER_ID varchar(3)
        READ_REGISTER_ID varchar(2)
        REGISTER_CODE varchar(15)
        REGISTER_STATUS_CODE varchar(2)
        CHANNEL_UOM_CODE varchar(3)
        TIME_OF_DAY_CODE varchar(8)
        READ_RELEVANCE_FLAG varchar(1)
        BILL_RELEVANCE_FLAG varchar(1)
        CNTR_REG_FLAG varchar(1)
        CURRENT_RECORD_FLAG varchar(1)
        ROW_EFFECTIVE_DTM datetime2(0)
        ROW_EXPIRATION_DTM datetime2(0)
        HSH_KEY varchar(512) not null
        HSH_DIFF varchar(512) not null
        RECORD_INSERT_DTM datetime2(0)
        RECORD_UPDATE_DTM datetime2(0)
    """),
}


@dataclass(frozen=True)
class Field:
    name: str
    declared: str
    required: bool = False
    identity: bool = False

    @property
    def length(self) -> int | None:
        """Longest text in bytes, as the warehouse counts it."""
        found = re.fullmatch(r"varchar\((\d+)\)", self.declared)
        return int(found.group(1)) if found else None

    @property
    def spark_type(self) -> T.DataType:
        if self.length is not None:
            return T.StringType()
        if self.declared.startswith("datetime"):
            return T.TimestampNTZType()
        return {"bigint": T.LongType(), "int": T.IntegerType(), "date": T.DateType()}[self.declared]

    def convert(self, column: Column) -> Column:
        """Value in the declared type; what cannot be converted becomes NULL, which `violations` reports.

        ``datetime2(0)`` is rounded to the nearest second, half a second up.
        """
        if self.declared.startswith("datetime"):
            value = column.try_cast(NTZ)
            return F.date_trunc("second", value + F.expr("interval '0.5' second")).cast(NTZ) if self.declared == "datetime2(0)" else value
        return column.try_cast(self.spark_type.simpleString())


@dataclass(frozen=True)
class Contract:
    table: str
    distribution: str
    fields: tuple[Field, ...]

    @classmethod
    def parse(cls, table: str, distribution: str, text: str) -> Contract:
        fields = []
        for line in text.split("\n"):
            words = line.split()
            if words:
                fields.append(Field(words[0], words[1], "not null" in line, words[-1] == "identity"))
        return cls(table, distribution, tuple(fields))

    @property
    def schema(self) -> T.StructType:
        """Columns without NOT NULL marks, which Spark tables do not enforce; see `violations`."""
        return T.StructType([T.StructField(f.name, f.spark_type) for f in self.fields])

    @property
    def identity(self) -> str | None:
        return next((f.name for f in self.fields if f.identity), None)


CONTRACTS = {name: Contract.parse(name, key, text) for name, (key, text) in _LAYOUTS.items()}


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Declared columns in declared order and type; columns the source lacks are NULL."""
    have = set(df.columns)
    return df.select(
        *(
            (f.convert(quoted(f.name)) if f.name in have else F.lit(None).cast(f.spark_type)).alias(f.name)
            for f in contract.fields
        )
    )


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """``(column_name, rule, row_count)`` of broken rules, from one pass over the source rows.

    The rules are NOT NULL, the length of texts, and that a value can be converted to the declared type. Rows that were
    conformed before have lost what cannot be converted. An identity column is only checked for the latter: its values
    are given later.
    """
    rules: list[tuple[str, str, Column]] = []
    for f in contract.fields:
        if f.name not in df.columns:
            continue
        if f.required and not f.identity:
            rules.append((f.name, "not null", quoted(f.name).isNull()))
        if f.length is None:
            rules.append((f.name, "not convertible", quoted(f.name).isNotNull() & f.convert(quoted(f.name)).isNull()))
        else:
            rules.append((f.name, f.declared, F.octet_length(quoted(f.name).cast("string")) > f.length))
    counts = df.agg(*(F.count_if(test).alias(f"r{i}") for i, (_, _, test) in enumerate(rules)))
    found = F.array(
        *(
            F.struct(F.lit(n).alias("column_name"), F.lit(r).alias("rule"), F.col(f"r{i}").alias("row_count"))
            for i, (n, r, _) in enumerate(rules)
        )
    )
    return counts.select(F.explode(found).alias("v")).select("v.*").filter("row_count > 0")


def create_table(lake: Lake, contract: Contract, area: str = "dimlayer", buckets: int | None = None) -> None:
    """Drop the table if it exists and create it; ``buckets`` lays rows out by the distribution column."""
    layout = (buckets, [contract.distribution]) if buckets else None
    lake.create(contract.table, contract.schema, area=area, bucket_by=layout)


def with_surrogate_keys(rows: DataFrame, name: str, last: int | Column = 0, key: str = "HSH_KEY") -> DataFrame:
    """Number rows from ``last + 1`` in the order of a key, NULL first, without one global sort.

    Rows are dealt to tasks by ranges of the key and written with their place in the task; each range starts after
    the rows of earlier ones. Equal and NULL keys are spread by the other columns, and every row gets a number.
    """
    tie = F.xxhash64(*map(quoted, rows.columns))
    placed = rows.withColumn("__tie", tie).repartitionByRange(quoted(key).asc_nulls_first(), "__tie")
    placed = placed.sortWithinPartitions(quoted(key).asc_nulls_first(), "__tie").withColumn("__id", F.monotonically_increasing_id())
    placed = written(placed.drop("__tie"), "surrogate-keys").withColumn("__part", F.shiftright("__id", 33))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("__part").agg(F.count("*").alias("n"), F.min("__id").alias("__first"))
    starts = starts.select("__part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    base = last if isinstance(last, Column) else F.lit(last)
    numbered = placed.join(F.broadcast(starts), "__part")  # a row per shuffle partition
    number = (base + F.col("__id") + F.col("__shift") + 1).cast("bigint")
    return numbered.withColumn(name, number).drop("__part", "__id", "__shift")
