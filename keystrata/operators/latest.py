"""Latest version per key and the current views built on it.

Spark plans ``row_number() = 1`` as a group limit on both sides of the shuffle: every map task sends at most
one row per key. A key that owns a third of all rows therefore costs one row per map task after the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystrata.functions.hashing import quoted
from keystrata.functions.times import REPORT_ZONE, local_time

_RANK = "__version_rank"


def _orderable(df: DataFrame, skip: Sequence[str]) -> list[str]:
    unordered = (T.MapType, T.VariantType)
    return [f.name for f in df.schema.fields if f.name not in skip and not isinstance(f.dataType, unordered)]


def top_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column], ties: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first by ``order``, then by ``ties``.

    By default every other column breaks ties, so that the result depends on the set of rows only and not on
    their order. Project to the columns you need before the call.
    """
    rest = _orderable(df, keys) if ties is None else list(ties)
    window = Window.partitionBy(*map(quoted, keys)).orderBy(*order, *map(quoted, rest))
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_by(
    df: DataFrame, keys: Sequence[str], order_by: str = "EXTRACT_DATE_TIME", ties: Sequence[str] | None = None
) -> DataFrame:
    """Newest row per key by one column."""
    return top_row(df, keys, [quoted(order_by).desc()], ties)


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Deterministic ``dropDuplicates(keys)``."""
    if set(df.columns) == set(keys):
        return df.distinct()
    return top_row(df, keys, [])


def latest_transaction(
    df: DataFrame,
    business_key: Sequence[str],
    batch: Sequence[str] = ("DM_TIMESTAMP", "_adfFilePath"),
    sequence: str = "REC_SEQ",
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Last record of a replicated key within one timestamp and file; the sequence text orders as a number."""
    return top_row(df, [*batch, *business_key], [quoted(sequence).try_cast("int").desc()], ties)


@dataclass(frozen=True)
class Hub:
    """A hub as seen by a view: its rows, its hash key and the business columns to add."""

    rows: DataFrame
    key: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ViewShape:
    """What makes one current view: keys of a version, where ranking happens, output columns."""

    version_keys: tuple[str, ...]
    output: tuple[str, ...]
    ranked: str = "before join"
    order_by: str = "EXTRACT_DATE_TIME"
    change_column: str = "CHANGE_TYPE"
    deleted: str = "D"
    local_columns: tuple[str, ...] = ()
    zone: str = REPORT_ZONE
    ties: tuple[str, ...] | None = None

    def __post_init__(self):
        if self.ranked not in ("before join", "after join"):
            raise ValueError(f"ranked must be 'before join' or 'after join', not {self.ranked!r}")


def own_columns(columns: Sequence[str], hubs: Sequence[tuple[str, Sequence[str]]], shape: ViewShape, link_key: str | None = None) -> list[str]:
    """Columns of a satellite that a view reads. ``hubs`` are hash key and business columns of each."""
    hub_columns = {c for _, business in hubs for c in business}
    hub_keys = {key for key, _ in hubs}
    return [
        c
        for c in columns
        if c not in hub_columns
        and (
            c in shape.output
            or c in shape.version_keys
            or c in (shape.order_by, shape.change_column, link_key)
            or (link_key is None and c in hub_keys)
            or (shape.ties is not None and c in shape.ties)
        )
    ]


def narrowing_keys(own: Sequence[str], hubs: Sequence[tuple[str, Sequence[str]]], shape: ViewShape, link_key: str | None = None) -> list[str]:
    """Keys by which only the newest satellite row can come into a view."""
    if shape.ranked == "before join":
        return list(shape.version_keys)
    # Rows of one link key meet the same hubs, so only the newest per (link key, own version columns) can
    # win after the join. Dropping the others first keeps old versions out of every join shuffle.
    anchor = [link_key] if link_key is not None else [key for key, _ in hubs]
    return [*anchor, *(k for k in shape.version_keys if k in own and k not in anchor)]


def current_view(
    satellite: DataFrame,
    hubs: Sequence[Hub],
    shape: ViewShape,
    link: DataFrame | None = None,
    link_key: str | None = None,
    narrowed: bool = False,
) -> DataFrame:
    """Latest version per key without deleted keys, joined to its hubs (through a link when given).

    ``ranked='before join'`` takes the newest satellite row and then loses it when its hub is missing;
    ``'after join'`` ranks only rows that found all hubs, and may use hub columns as version keys.

    The delete test comes after ranking: a newest row marked deleted hides the older versions, and a row
    without a change mark is dropped. ``narrowed`` says that the satellite rows are the newest by `narrowing_keys` already;
    ranked after the join, it may also be set when nearly all are, as ranking drops the others.
    """
    names = [(hub.key, hub.columns) for hub in hubs]
    by = link_key if link is not None else None
    own = own_columns(satellite.columns, names, shape, by)
    rows = satellite.select(*map(quoted, own))
    if not narrowed:
        ties = None if shape.ties is None else [c for c in shape.ties if c in own]
        rows = latest_by(rows, narrowing_keys(own, names, shape, by), shape.order_by, ties)
    joined = _join_hubs(rows, hubs, link, link_key)
    if shape.ranked == "after join":
        joined = latest_by(joined, shape.version_keys, shape.order_by, shape.ties)

    kept = joined.filter(quoted(shape.change_column) != shape.deleted)
    kinds = {f.name: f.dataType for f in kept.schema.fields}
    return kept.select(
        *(
            local_time(quoted(c), shape.zone, kinds[c]).alias(c) if c in shape.local_columns else quoted(c)
            for c in shape.output
        )
    )


def _join_hubs(rows: DataFrame, hubs: Sequence[Hub], link: DataFrame | None, link_key: str | None) -> DataFrame:
    def business(hub: Hub) -> DataFrame:
        return hub.rows.select(*map(quoted, dict.fromkeys([hub.key, *hub.columns])))

    if link is None:
        for hub in hubs:
            rows = rows.join(business(hub), hub.key)
        return rows
    if link_key is None:
        raise ValueError("a link needs link_key")
    # Keys and business columns are narrow: they are joined first, and the wide rows move once.
    bridge = link.select(*map(quoted, dict.fromkeys([link_key, *(h.key for h in hubs)])))
    for hub in hubs:
        bridge = bridge.join(business(hub), hub.key)
    return rows.join(bridge, link_key)
