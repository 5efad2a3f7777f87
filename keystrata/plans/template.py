"""SQL text with ``${name}`` parameters."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from keystrata.plans.config import literal

# Fixed value: the run date of a migration, which stands for tomorrow.
MIGRATION_DATE = "1900-01-01"

_PARAMETER = re.compile(r"\$\{(\w+)\}")


def render(text: str, params: Mapping[str, Any]) -> str:
    """Put parameter values into the text; a parameter without a value is an error."""

    def value(match: re.Match) -> str:
        name = match.group(1)
        if name not in params:
            raise KeyError(f"no value for ${{{name}}}")
        return str(params[name])

    return _PARAMETER.sub(value, text).strip().rstrip(";").rstrip()


def run_sql(spark: SparkSession, text: str, params: Mapping[str, Any] | None = None, **args: Any) -> DataFrame:
    """Run a template. ``params`` are put into the text (names of schemas); ``args`` are bound values."""
    return spark.sql(render(text, params or {}), args=args or None)


def run_sql_file(spark: SparkSession, path: str, params: Mapping[str, Any] | None = None, **args: Any) -> DataFrame:
    text = "\n".join(row.value for row in spark.read.text(path, wholetext=True).collect())
    return run_sql(spark, text, params, **args)


def run_date(given: str, today: dt.date) -> str:
    return (today + dt.timedelta(days=1)).isoformat() if given == MIGRATION_DATE else given


def job_params(settings: Mapping[str, Any], given_date: str, today: dt.date, migration: bool = True) -> dict[str, Any]:
    """Parameters of a job: environment, run date, hour filter, then ``SqlParams``, which win.

    ``migration=False`` passes the run date as given, as the database export does.
    """
    params: dict[str, Any] = {
        "logicalenv": settings["LogicalEnv"],
        "run_date": run_date(given_date, today) if migration else given_date,
    }
    if "filter_hour" in settings:
        params["filter_hour"] = settings["filter_hour"]
    if settings.get("SqlParams"):
        params |= literal(settings["SqlParams"])
    return params
