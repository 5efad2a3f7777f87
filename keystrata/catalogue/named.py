"""The nine named views over a vault made from the events table.

Keys and attributes are expressions over events that read the same in both SQL dialects. The Spark side goes
through the view declarations; the SQL side states joins, ranking and delete test on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keystrata.catalogue.registry import query, sql_hash_key, table
from keystrata.functions.hashing import hash_key
from keystrata.operators.latest import Hub, current_view
from keystrata.plans.views import VIEWS, NamedView

_HUB_KEYS = {
    "HUB_DOMS_COMPONENT": "props",
    "HUB_REPORT": "user_id",
    "HUB_SUBSTATION": "user_id",
    "HUB_CALL": "event_id",
    "HUB_OPERATING_ZONE": "event_type",
    "HUB_CUSTOMER": "user_id",
    "HUB_PROPERTY": "props",
    "HUB_CUSTOMER_CONNECTION": "event_type",
    "HUB_FEEDER": "props",
    "HUB_NMI": "user_id",
    "HUB_EQUIPMENT": "user_id",
    "HUB_OUTAGE": "day(ts)",
    "HUB_REFERENCE": "hour(ts)",
}
_TEXTS = ("event_type", "props", "cast(hour(ts) as string)", "cast(value as string)")


def _satellite_columns(view: NamedView) -> dict[str, str]:
    """Column to expression of a view's satellite, without its hash key."""
    shape = view.shape
    hub_columns = {c for columns in view.hubs.values() for c in columns}
    skip = {view.link_key, *hub_columns, *(f"{t}_HSH_KEY" for t in view.hubs)}
    names = [c for c in dict.fromkeys((*shape.output, *shape.version_keys)) if c not in skip]
    given = {
        "EXTRACT_DATE_TIME": "ts",
        "LOAD_DATE_TIME": "ts",
        shape.change_column: "case when event_type = 'error' then 'D' else 'I' end",
        **{c: "ts" for c in shape.local_columns},
        **{c: "sha1(cast(event_id as string))" for c in names if c.endswith("_HSH_DIFF")},
    }
    return {c: given.get(c, _TEXTS[i % len(_TEXTS)]) for i, c in enumerate(names)}


def _rows(spark: SparkSession, sf: str, view: NamedView) -> DataFrame:
    events = table(spark, sf, "events")
    keys = {t: f"cast({_HUB_KEYS[t]} as string)" for t in view.hubs}
    keyed = events.selectExpr("*", *(f"{e} AS k_{t}" for t, e in keys.items()))
    hashes = {f"{t}_HSH_KEY": hash_key([f"k_{t}"]) for t in view.hubs}

    hubs = []
    for hub, columns in view.hubs.items():
        # The keys of the larger events only, so that some rows find no hub.
        rows = keyed.filter("value > 20").selectExpr(f"k_{hub}").distinct()
        rows = rows.withColumns({f"{hub}_HSH_KEY": hash_key([f"k_{hub}"])}).withColumnRenamed(f"k_{hub}", columns[0])
        hubs.append(Hub(rows, f"{hub}_HSH_KEY", columns))

    link = None
    satellite = keyed.selectExpr(*(f"k_{t}" for t in view.hubs), *(f"{e} AS {c}" for c, e in _satellite_columns(view).items()))
    if view.link:
        link_hash = hash_key([f"k_{t}" for t in view.hubs])
        link = keyed.select(*(f"k_{t}" for t in view.hubs)).distinct().withColumns(hashes | {view.link_key: link_hash})
        satellite = satellite.withColumn(view.link_key, link_hash)
    else:
        satellite = satellite.withColumns(hashes)
    return current_view(satellite, hubs, view.shape, link, view.link_key)


def _sql(view: NamedView) -> str:
    shape, tables = view.shape, list(view.hubs)
    exprs = {t: f"cast({_HUB_KEYS[t]} as string)" for t in tables}
    hub_of = {columns[0]: t for t, columns in view.hubs.items()}
    ctes = [
        f"h_{t} as (select distinct {e} as k from events where value > 20)" for t, e in exprs.items()
    ]
    link_hash = sql_hash_key(*(f"k_{t}" for t in tables))
    sat = ", ".join(
        [*(f"{e} as k_{t}" for t, e in exprs.items()), *(f'{e} as "{c}"' for c, e in _satellite_columns(view).items())]
    )

    def source(column: str) -> str:
        if column in hub_of:
            return f"h_{hub_of[column]}.k"
        if column == view.link_key:
            return link_hash
        if column.endswith("_HSH_KEY"):
            return sql_hash_key(f"k_{column[: -len('_HSH_KEY')]}")
        if column in shape.local_columns:
            return f"""s."{column}" at time zone 'UTC' at time zone '{shape.zone}'"""
        return f's."{column}"'

    joins = " ".join(f"join h_{t} on h_{t}.k = s.k_{t}" for t in tables)
    rank = f'row_number() over (partition by {", ".join(map(source, shape.version_keys))} order by s."EXTRACT_DATE_TIME" desc)'
    output = ", ".join(f'{source(c)} as "{c}"' for c in shape.output)
    ctes.append(f"sat as (select {sat} from events)")
    if shape.ranked == "before join":
        ctes.append(f"s as (select s.*, {rank} as rn from sat s)")
        return f"with {', '.join(ctes)} select {output} from s {joins} where rn = 1 and s.\"{shape.change_column}\" <> 'D'"
    ctes.append(f'f as (select {output}, s."{shape.change_column}" as ct, {rank} as rn from sat s {joins})')
    columns = ", ".join(f'"{c}"' for c in shape.output)
    return f"with {', '.join(ctes)} select {columns} from f where rn = 1 and ct <> 'D'"


def _register(name: str, view: NamedView) -> None:
    def rows(spark: SparkSession, sf: str) -> DataFrame:
        return _rows(spark, sf, view)

    rows.__name__ = name.lower()
    query(_sql(view))(rows)


for _name, _view in VIEWS.items():
    _register(_name, _view)
