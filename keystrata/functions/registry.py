"""The same functions under their SQL names, for use in SQL templates."""

from __future__ import annotations

from pyspark.sql import SparkSession

from keystrata.functions.geo import NETWORK_GRID
from keystrata.functions.times import WAREHOUSE_ZONE


def register_functions(spark: SparkSession) -> None:
    """Create ``st_x``, ``st_y``, ``fn_get_count_of_substring`` and ``convertolocaltime``.

    They are SQL functions, inlined by the analyser: no Python worker, full code generation.
    """
    longitude, latitude = NETWORK_GRID.sql("x", "y")
    bodies = {
        "st_x(x DOUBLE, y DOUBLE) RETURNS DOUBLE": longitude,
        "st_y(x DOUBLE, y DOUBLE) RETURNS DOUBLE": latitude,
        "fn_get_count_of_substring(input_text STRING, to_search STRING) RETURNS INT": (
            "CAST((octet_length(input_text) - octet_length(replace(input_text, to_search, '')))"
            " DIV nullif(octet_length(to_search), 0) AS INT)"
        ),
        "convertolocaltime(input_utc TIMESTAMP_NTZ) RETURNS TIMESTAMP_NTZ": (
            f"input_utc + (input_utc - convert_timezone('{WAREHOUSE_ZONE}', 'UTC', input_utc))"
        ),
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")


def register_business_days(spark: SparkSession, calendar_view: str) -> None:
    """Create the table function ``fn_get_business_days(start, end)`` over a calendar view.

    Business days from start to end, both included: different days of the date key with the indicator set. Made for a few
    look-ups in a template. For a column of date pairs use
    `keystrata.plans.calendar.with_business_days`, which does not scan the calendar per row.
    """
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION fn_get_business_days(first_day DATE, last_day DATE)
            RETURNS TABLE (businessdays BIGINT)
            RETURN SELECT count(DISTINCT day) FROM (
                SELECT to_date(CAST(DT_DATE_KEY AS STRING), 'yyyyMMdd') AS day, VIC_BD_IND FROM {calendar_view})
            WHERE VIC_BD_IND = 1 AND day BETWEEN first_day AND last_day"""
    )
