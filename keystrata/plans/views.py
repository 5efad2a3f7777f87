"""The current views of the vault, declared by their tables, keys and columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from keystrata.operators.latest import Hub, ViewShape, current_view, narrowing_keys, own_columns
from keystrata.plans.current import CurrentVersions
from keystrata.sources.tables import Lake


@dataclass(frozen=True)
class NamedView:
    satellite: str
    hubs: dict[str, tuple[str, ...]]
    shape: ViewShape
    link: str | None = None

    @property
    def link_key(self) -> str | None:
        return f"{self.link}_HSH_KEY" if self.link else None


def _words(text: str) -> tuple[str, ...]:
    return tuple(text.split())


# Tables, version keys and output columns of the views.
VIEWS = {
    "TMP_DOMS_COMPONENT_ATTRIBUTES_DETAILS": NamedView(
        satellite="SAT_DOMS_COMPONENT_ATTRIBUTES_DETAILS",
        hubs={"HUB_DOMS_COMPONENT": ("COMPONENT_ID",)},
        shape=ViewShape(
            version_keys=("ATTRIBUTE_ID",),
            change_column="ChangeType",
            output=_words(
                """
                EXTRACT_DATE_TIME COMPONENT_ID ATTRIBUTE_ID ATTRIBUTE_NAME ATTRIBUTE_INDEX ATTRIBUTE_DEFINITION
                ATTRIBUTE_LOCATION ATTRIBUTE_VALUE ATTRIBUTE_TYPE ATTRIBUTE_TABLE_SIZE ATTRIBUTE_VECTOR_SIZE
                ATTRIBUTE_DE_TYPE ATTRIBUTE_ALARM_REF ATTRIBUTE_WRITE_GROUP ATTRIBUTE_READ_GROUP
                ATTRIBUTE_STATUS ATTRIBUTE_CLONE_ID ATTRIBUTE_GRTV_LOGGING ATTRIBUTE_RDBMS_ARCHIVING
                ATTRIBUTE_EVENT_PRIORITY ATTRIBUTE_LOGGING_CLASS PROTECTION_LEVEL CE_EVAL_MODE
                ATTRIBUTE_ALARM_INDEX ATTRIBUTE_ALARM_FILTER SOURCE IDENTITY STATISTICS_PROFILE
                LAST_GOOD_VALUE RT_CALC_PERIODICITY VALIDATION_GROUP ChangeType HUB_DOMS_COMPONENT_HSH_KEY
                LOAD_DATE_TIME RECORD_SOURCE SAT_DOMS_COMPONENT_ATTRIBUTES_DETAILS_HSH_DIFF
                """
            ),
        ),
    ),
    "TMP_DOMS_NETWORK_OUTAGE_DETAIL": NamedView(
        satellite="LSAT_DOMS_NETWORK_OUTAGE_DETAIL",
        link="LINK_NMI_FEEDER_CUSTOMER_OUTAGE_CUSTOMER_CONNECTION_REFERENCE",
        hubs={
            "HUB_CUSTOMER": ("CUSTOMER_NO",),
            "HUB_CUSTOMER_CONNECTION": ("CUSTOMER_CONNECTION_POINT",),
            "HUB_FEEDER": ("FEEDER",),
            "HUB_NMI": ("NMI",),
            "HUB_OUTAGE": ("OUTAGE_KEY",),
            "HUB_REFERENCE": ("REFERENCE_NUMBER",),
        },
        shape=ViewShape(
            version_keys=_words(
                """
                OUTAGE_KEY NMI STAGE_ID INCLUDE_IN_REPORT ADJ_INTERRUPTION_DATE ADJ_RESTORATION_DATE
                REINTERRUPTION REFERENCE_NUMBER
                """
            ),
            ranked="after join",
            output=_words(
                """
                EXTRACT_DATE_TIME CUSTOMER_NO CUSTOMER_CONNECTION_POINT FEEDER NMI OUTAGE_KEY REFERENCE_NUMBER
                ADJ_INTERRUPTION_DATE ADJ_RESTORATION_DATE DURATION FRMP INCLUDE_IN_REPORT INTERRUPTION_DATE
                LIFE_SUPPORT PROCESS_BY REINTERRUPTION RESTORATION_DATE SITE_VACANT SUPPLY_STATE UPDATE_TIME
                STAGE_ID FEEDER_NO CHANGE_TYPE
                LINK_NMI_FEEDER_CUSTOMER_OUTAGE_CUSTOMER_CONNECTION_REFERENCE_HSH_KEY
                LSAT_DOMS_NETWORK_OUTAGE_DETAIL_HSH_DIFF RECORD_SOURCE LOAD_DATE_TIME
                """
            ),
        ),
    ),
    "TMP_DOMS_RPT_DETAILS": NamedView(
        satellite="SAT_DOMS_RPT_DETAILS",
        hubs={"HUB_REPORT": ("REPORT_ID",)},
        shape=ViewShape(
            version_keys=("HUB_REPORT_HSH_KEY",),
            local_columns=_words(
                """
                REPORT_USER_COMPLETED_DATE REPORT_REG_COMPLETED_DATE REPORT_CREATION_DATE REPORT_RECEIVED_DATE
                REPORT_START_DATE REPORT_PLANNED_START_DATE REPORT_PLANNED_END_DATE
                """
            ),
            output=_words(
                """
                EXTRACT_DATE_TIME REPORT_ID REPORT_REF REPORT_OP_COMPLETE REPORT_REG_COMPLETE
                REPORT_USER_COMPLETED_DATE REPORT_REG_COMPLETED_DATE REPORT_CREATION_DATE REPORT_RECEIVED_DATE
                REPORT_TYPE_ID CONTROL_REFERENCE CONTROL_ENGINEER COMPLETION_ENGINEER READING_TYPE SOP_REF
                VOLTAGE_GROUP SI_VOLTAGE REPORT_CML REPORT_CI REPORT_RI REPORT_FILLED STATUS JOB_NUMBER
                REPORT_START_DATE CONFIRMED_OUTAGE_ID SI_FLAG REPORT_PLANNED_START_DATE REPORT_PLANNED_END_DATE
                SYSTEM_REPORT_TYPE CHANGE_TYPE HUB_REPORT_HSH_KEY LOAD_DATE_TIME RECORD_SOURCE
                SAT_DOMS_RPT_DETAILS_HSH_DIFF
                """
            ),
        ),
    ),
    "TMP_DOMS_SPA_LOOKUP_FEEDER_CATEGORY": NamedView(
        satellite="SAT_DOMS_SPA_LOOKUP_FEEDER_CATEGORY",
        hubs={"HUB_FEEDER": ("FEEDER",)},
        shape=ViewShape(
            version_keys=("HUB_FEEDER_HSH_KEY", "DATED"),
            output=_words(
                """
                EXTRACT_DATE_TIME FEEDER DATED FEEDER_CATEGORY FEEDER_NAME CHANGE_TYPE HUB_FEEDER_HSH_KEY
                LOAD_DATE_TIME RECORD_SOURCE SAT_DOMS_SPA_LOOKUP_FEEDER_CATEGORY_HSH_DIFF
                """
            ),
        ),
    ),
    "TMP_DOMS_SPA_MV_CALL": NamedView(
        satellite="LSAT_DOMS_SPA_MV_CALL",
        link="LINK_CUSTOMER_CONNECTION_CALL_OPERATING_ZONE",
        hubs={
            "HUB_OPERATING_ZONE": ("OPERATING_ZONE_ID",),
            "HUB_CUSTOMER_CONNECTION": ("CUSTOMER_CONNECTION_POINT",),
            "HUB_CALL": ("CALL_ID",),
        },
        shape=ViewShape(
            version_keys=("CALL_ID",),
            ranked="after join",
            output=_words(
                """
                EXTRACT_DATE_TIME CALL_ID OPERATING_ZONE_ID CUSTOMER_CONNECTION_POINT CALL_CATEGORY_DESCRIPTION
                CALL_CATEGORY_ID CALL_CHARGEABLE CALL_REFERENCE CALL_STATUS CALL_TAKER CALLER_FIRST_NAME
                CALLER_INITIALS CALLER_NAME CALLER_TELEPHONE CALLER_TITLE COMMENTS CRITICAL_INFO
                CUSTOMER_WARNED DANGEROUS_SITUATION LOGGED_TIME POSTCODE PREMISE_NAME PREMISE_NUMBER PRIORITY
                STREET TOWN_NAME TPD_CUSTOMER_AGREEMENT_NUMBER TPD_POLICE_FIRE_EVENT_NUMBER
                TPD_STATEMENT_AT_SITE_NUMBER TPD_VEHICLE_DETAILS CHANGE_TYPE
                LINK_CUSTOMER_CONNECTION_CALL_OPERATING_ZONE_HSH_KEY LOAD_DATE_TIME
                LSAT_DOMS_SPA_MV_CALL_HSH_DIFF RECORD_SOURCE
                """
            ),
        ),
    ),
    "TMP_DOMS_SPA_MV_DIST_SUBSTATION": NamedView(
        satellite="SAT_DOMS_SPA_MV_DIST_SUBSTATION",
        hubs={"HUB_SUBSTATION": ("SUBSTATION_ID",)},
        shape=ViewShape(
            version_keys=("ALIAS",),
            output=_words(
                """
                EXTRACT_DATE_TIME SUBSTATION_ID ALIAS SUB_NAME CHANGE_TYPE HUB_SUBSTATION_HSH_KEY
                LOAD_DATE_TIME RECORD_SOURCE SAT_DOMS_SPA_MV_DIST_SUBSTATION_HSH_DIFF
                """
            ),
        ),
    ),
    "TMP_DOMS_SPA_MV_PROP_CON_POINT": NamedView(
        satellite="LSAT_DOMS_SPA_MV_PROP_CON_POINT",
        link="LINK_NMI_PROPERTY_CUSTOMER_CONNECTION_EQUIPMENT_FEEDER",
        hubs={
            "HUB_EQUIPMENT": ("EQUIPMENT_ID",),
            "HUB_CUSTOMER_CONNECTION": ("CUSTOMER_CONNECTION_POINT",),
            "HUB_FEEDER": ("FEEDER",),
            "HUB_NMI": ("NMI",),
            "HUB_PROPERTY": ("PROPERTY_NUMBER",),
        },
        shape=ViewShape(
            version_keys=("HUB_EQUIPMENT_HSH_KEY", "HUB_NMI_HSH_KEY", "SUPPLY_STATE"),
            ranked="after join",
            local_columns=("UPDATE_TIME",),
            output=_words(
                """
                EXTRACT_DATE_TIME EQUIPMENT_ID CUSTOMER_CONNECTION_POINT FEEDER NMI PROPERTY_NUMBER
                FEEDER_COMPONENT_ID SUPPLY_STATE UPDATE_TIME CHANGE_TYPE
                LINK_NMI_PROPERTY_CUSTOMER_CONNECTION_EQUIPMENT_FEEDER_HSH_KEY LOAD_DATE_TIME RECORD_SOURCE
                LSAT_DOMS_SPA_MV_PROP_CON_POINT_HSH_DIFF
                """
            ),
        ),
    ),
    "TMP_DOMS_SPA_MV_PROPERTY": NamedView(
        satellite="LSAT_DOMS_SPA_MV_PROPERTY",
        link="LINK_CUSTOMER_PROPERTY",
        hubs={"HUB_PROPERTY": ("PROPERTY_NUMBER",), "HUB_CUSTOMER": ("CUSTOMER_NO",)},
        shape=ViewShape(
            version_keys=("CUSTOMER_NO", "PROPERTY_NUMBER", "LINK_CUSTOMER_PROPERTY_HSH_KEY"),
            ranked="after join",
            output=_words(
                """
                EXTRACT_DATE_TIME CUSTOMER_NO PROPERTY_NUMBER CHANGE_TYPE CUSTOMER_NAME ADDRESS_NUMBER
                ENERGISED_FLAG ENERGISED_DESC PROPERTY_TYPE FRMP LOAD_DATE_TIME RECORD_SOURCE
                LSAT_DOMS_SPA_MV_PROPERTY_HSH_DIFF LINK_CUSTOMER_PROPERTY_HSH_KEY
                """
            ),
        ),
    ),
    "TMP_DOMS_TOTAL_FIRE_BAN": NamedView(
        satellite="SAT_DOMS_TOTAL_FIRE_BAN",
        hubs={"HUB_EQUIPMENT": ("EQUIPMENT_ID",)},
        shape=ViewShape(
            version_keys=("HUB_EQUIPMENT_HSH_KEY", "CHILD_COMP_ID", "DATE_TIME", "ID"),
            output=_words(
                """
                EXTRACT_DATE_TIME EQUIPMENT_ID BATCHCMDNAME CFA_REGION CHILD_COMP_ID DATE_TIME ID NO_OF_ATTEMPTS
                SETTING_TYPE STATUS HUB_EQUIPMENT_HSH_KEY SAT_DOMS_TOTAL_FIRE_BAN_HSH_DIFF CHANGE_TYPE
                RECORD_SOURCE LOAD_DATE_TIME
                """
            ),
        ),
    ),
}


def current_versions(lake: Lake, name: str, buckets: int = 64) -> CurrentVersions:
    """The table ``<view>_CV``: the satellite rows that can come into a view, in the columns that it reads."""
    view = VIEWS[name]
    hubs = [(f"{table}_HSH_KEY", columns) for table, columns in view.hubs.items()]
    own = own_columns(lake.columns(view.satellite), hubs, view.shape, view.link_key)
    keys = narrowing_keys(own, hubs, view.shape, view.link_key)
    ties = None if view.shape.ties is None else tuple(c for c in view.shape.ties if c in own)
    return CurrentVersions(lake, view.satellite, tuple(keys), view.shape.order_by, tuple(own), ties, f"{name}_CV", buckets)


def view_rows(lake: Lake, name: str) -> DataFrame:
    """Rows of a named view over the vault of an environment, from its table of current versions if there is one."""
    view = VIEWS[name]
    hubs = [Hub(lake.read(table), f"{table}_HSH_KEY", columns) for table, columns in view.hubs.items()]
    link = lake.read(view.link) if view.link else None
    current = current_versions(lake, name)
    narrowed = current.exists()
    return current_view(current.rows() if narrowed else lake.read(view.satellite), hubs, view.shape, link, view.link_key, narrowed)


def register_views(lake: Lake) -> list[str]:
    """Make every named view whose tables exist a temporary view; returns their names."""
    found = []
    for name, view in VIEWS.items():
        if all(lake.exists(t) for t in (view.satellite, *view.hubs, *([view.link] if view.link else []))):
            view_rows(lake, name).createOrReplaceTempView(name)
            found.append(name)
    return found
