"""Loads of hubs, links, same-as links, satellites and reference tables from staged rows.

The functions up to `reference_rows` are plans without side effects; `VaultFeed` runs them against tables.

Staged rows are not cached between targets. Every target reads only its own columns of the staged parquet
files, and the expressions in between need no shuffle, so reading again is cheaper than keeping all columns.
The one exception is a feed that removes repeated replication records, which shuffles: its result is written
to the shared folder once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystrata.functions.hashing import hash_diff, hash_key, hash_raw, quoted, satellite_diff_columns
from keystrata.functions.times import moment
from keystrata.operators import columns as C
from keystrata.operators.latest import latest_transaction, one_per_key
from keystrata.operators.merge import current_hashes, in_partitions, insert_only, new_versions
from keystrata.operators.transforms import apply_satellite, apply_staging, parse_file_date
from keystrata.plans.config import FeedConfig, HubSpec, LinkSpec, SameAsSpec
from keystrata.plans.counted import append_counted, logged_counts
from keystrata.plans.current import CurrentVersions, append_and_merge, for_delta_check, repair
from keystrata.plans.key_prefixes import KeyPrefixes
from keystrata.session import written
from keystrata.sources.files import BatchResult, append_count_log, load_in_batches, read_parquet
from keystrata.sources.tables import Lake

# Satellite columns that replicated feeds do not load.
UNMAPPED_COLUMNS = ("SRC_DEVICE_ID", "SRC_SERVICE_POINT_ID")


def named_rows(raw: DataFrame, config: FeedConfig) -> DataFrame:
    """Replicated rows under their real names, the last record per key and batch only, gaps filled."""
    df = C.rename_by_position(C.with_client_id(raw, config.settings), config.names)
    if config.flag("GENERATE_CDC_SEQNO") and "BUSINESS_KEY" in config.settings:
        df = latest_transaction(df, config.nested("BUSINESS_KEY"))
    if "SourceMissingColumns" in config.settings:
        df = C.fill_missing(df, config.settings["SourceMissingColumns"])
    return df


def staged_rows(raw: DataFrame, config: FeedConfig, load_ts: C.Moment) -> DataFrame:
    """Raw staging files to clean rows with process metadata and configured transforms."""
    date_column = config.settings.get("BUSINESSPARTITIONDATE")
    if config.replicated:
        df = named_rows(raw, config)
        if config.history:
            df = C.replicated_history_metadata(df, load_ts, date_column)
        else:
            df = C.drop_technical(C.drop_before_images(df))
            df = C.delta_metadata(df, config.record_source, load_ts)
    elif config.history:
        df = C.history_metadata(raw, load_ts, quoted(date_column))
    else:
        df = raw
        for column, spec in (config.transforms.get("TRANSFORM_PARSE_FILEDATE") or {}).items():
            df = parse_file_date(df, column, spec)
        df = C.file_metadata(df, config.record_source, load_ts)
    return apply_staging(df, config.transforms)


@dataclass(frozen=True)
class KeyHash:
    """How a hash column follows from other columns; ``raw`` keeps blanks and skips NULLs."""

    columns: tuple[str, ...]
    raw: bool = False

    def column(self) -> Column:
        return hash_raw(self.columns) if self.raw else hash_key(self.columns)


# Hash columns by name. A later one may be built on earlier ones.
Hashes = dict[str, KeyHash]


def with_hashes(df: DataFrame, hashes: Hashes) -> DataFrame:
    """Add hash columns, those built on other hashes after them."""
    waiting = dict(hashes)
    while waiting:
        ready = {n: spec for n, spec in waiting.items() if not set(spec.columns) & set(waiting)}
        if not ready:
            raise ValueError(f"hash columns depend on each other: {', '.join(waiting)}")
        df = df.withColumns({n: spec.column() for n, spec in ready.items()})
        waiting = {n: spec for n, spec in waiting.items() if n not in ready}
    return df


def map_hub(df: DataFrame, hub: HubSpec, record_source: str, spellings: bool = True) -> DataFrame:
    """Add the key columns and record source of a hub; a same-as hub gets a row per spelling of its key."""
    if hub.same_as and spellings:
        return C.map_same_as_keys(df, hub.mapping, record_source)
    first: dict[str, str] = {}
    for source, key in hub.mapping.items():
        if not hub.same_as or key not in first.values():
            first[source] = key
    return C.map_keys(df, first, record_source)


def hub_hash(hub: HubSpec) -> Hashes:
    return {hub.hash_key: KeyHash(hub.keys)}


def link_hash(link: LinkSpec) -> Hashes:
    return {link.hash_key: KeyHash(link.columns)}


def same_as_hashes(spec: SameAsSpec) -> Hashes:
    """Hash of every spelling (raw values), then the link's own hash key."""
    return {k: KeyHash(columns, raw=True) for k, columns in spec.key_columns.items()} | link_hash(spec.link)


def define_same_as(df: DataFrame, spec: SameAsSpec) -> DataFrame:
    return df.withColumns({column: F.lit(value) for column, value in spec.definitions.items()})


def hashed_rows(df: DataFrame, columns: Sequence[str], hashes: Hashes) -> DataFrame:
    """Distinct rows in the columns of a hub or link, with their hash keys.

    A batch names the same key many times. Equal rows are dropped before anything is hashed: that is a hash
    aggregation with a map-side part, so repeated keys, also a very frequent one, neither get hashed row by
    row nor sorted nor sent over the network.
    """
    wanted = set(columns)
    for name in reversed(hashes):
        if name in wanted:
            wanted |= set(hashes[name].columns)
    used = {name: spec for name, spec in hashes.items() if name in wanted}
    distinct = C.select_target(df, sorted(wanted - set(used))).distinct()
    return C.select_target(with_hashes(distinct, used), columns)


def key_rows(df: DataFrame, target: DataFrame, key: str, hashes: Hashes) -> DataFrame:
    """Rows to append to a hub or link: target columns, one per hash key, unknown keys only."""
    return insert_only(target, hashed_rows(df, target.columns, hashes), [key])


@dataclass(frozen=True)
class SatelliteShape:
    """Roles of a satellite's columns, read from its table."""

    columns: tuple[str, ...]
    types: Mapping[str, T.DataType]
    key: str
    diff: str

    @classmethod
    def of(cls, schema: T.StructType, key: str | None = None) -> SatelliteShape:
        keys = [n for n in schema.names if "HSH_KEY" in n]
        diffs = [n for n in schema.names if "HSH_DIFF" in n]
        return cls(tuple(schema.names), {f.name: f.dataType for f in schema.fields}, key or keys[-1], diffs[-1])


def satellite_versions(df: DataFrame, shape: SatelliteShape, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Rows in the satellite's columns with their change hash."""
    columns = [c for c in shape.columns if c not in ignore]
    diff_columns = satellite_diff_columns(columns)
    source_types = {f.name: f.dataType for f in df.schema.fields}
    diff = hash_diff(diff_columns, shape.types, source_types)
    return df.select(
        *(
            F.lit(None).cast(shape.types[c]).alias(c) if c in ignore else diff.alias(c) if c == shape.diff else quoted(c)
            for c in shape.columns
        )
    )


def satellite_rows(
    df: DataFrame,
    target: DataFrame,
    key: str | None = None,
    ignore: tuple[str, ...] = (),
    partition: str | Mapping[str, str | None] | None = None,
    direct: bool = False,
    current: CurrentVersions | None = None,
) -> DataFrame:
    """Rows to append to a satellite.

    ``direct`` appends every distinct version of the batch. Otherwise versions equal to the current one are
    left out; with ``partition``, a column or columns with the format of text values, a version is compared with
    all versions in the partitions the batch touches. With ``current`` the current versions are read from their table,
    and only from the buckets of the batch's keys.
    """
    shape = SatelliteShape.of(target.schema, key)
    versions = satellite_versions(df, shape, ignore)
    if direct:
        return one_per_key(versions, [shape.key, shape.diff])
    if partition is None and current is not None:
        known = current.near(versions)
    elif partition is None:
        known = current_hashes(target, shape.key, shape.diff, of=versions)
    else:
        known = in_partitions(target, versions, partition)
    return new_versions(versions, known, shape.key, shape.diff)


def reference_rows(
    df: DataFrame, columns: list[str], record_source: str, load_ts: C.Moment, extract_ts: C.Moment
) -> DataFrame:
    """Full contents of a reference table."""
    return C.select_target(C.reference_metadata(df, record_source, load_ts, extract_ts), columns)


@dataclass
class VaultFeed:
    """One run of a feed against the vault of an environment.

    A repeated run adds nothing twice to hubs and links, nor to satellites that are compared with their current
    version, as long as the batch holds one version of a key. Direct inserts (``DIRECTINSERT``, history feeds) append what they get, so a run
    that is repeated appends it again; `keystrata.plans.exactly_once` sees to it that it is not. ``resumed`` says that an earlier run with
    this load time broke off: satellites leave out the versions they have from it.
    """

    lake: Lake
    config: FeedConfig
    load_ts: C.Moment | None = None
    extract_ts: C.Moment | None = None
    resumed: bool = False

    def __post_init__(self):
        # One literal per run, so that a task that runs again writes the same rows.
        self.load_ts = self.load_ts or dt.datetime.now().replace(microsecond=0)
        self.hashes: Hashes = {}

    def run(self, raw: DataFrame | None = None, count_log: str | None = None) -> None:
        self.hashes = {}
        raw = raw if raw is not None else read_parquet(self.lake.spark, self.config.paths)
        df = staged_rows(raw, self.config, self.load_ts)
        if self.config.flag("GENERATE_CDC_SEQNO"):
            df = written(df, "staged")
        if self.config.flag("REFERENCE_TABLE"):
            self.load_reference(df)
            return
        df = self.load_hubs(df)
        df = self.load_links(df)
        df = self.load_same_as(df)
        # Hash before masking: keys come from clear values. Columns that a satellite lacks are never computed.
        self.load_satellites(apply_satellite(with_hashes(df, self.hashes), self.config.transforms))
        if self.config.history:
            for table in self.config.satellites:
                append_count_log(logged_counts(self.lake, table), count_log or self._count_log())

    def run_files(self, files: Sequence[str], count_log: str | None = None) -> list[BatchResult]:
        """Load files in as many groups as the feed asks for; see `load_in_batches`."""
        return load_in_batches(self.lake.spark, files, self.config.batches, lambda raw: self.run(raw, count_log))

    def _count_log(self) -> str:
        settings = self.config.settings
        return "/".join(
            [self.lake.root.rstrip("/"), "log/HIST_LOAD", settings["Source"], settings["TableName"], settings.get("RunID", "0"), "S2R"]
        )

    def _finish(self, table: str) -> None:
        if self.config.flag("RefreshExtractTable"):
            base = self.config.settings.get("extract_folder", f"{self.lake.root.rstrip('/')}/external/im{self.lake.env}")
            self.lake.export(table, f"{base.rstrip('/')}/{table}")

    def _subset(self, df: DataFrame, split: str, table: str) -> DataFrame:
        rules = self.config.nested(split)
        return C.subset_for(df, rules, table) if rules else df

    def load_hubs(self, df: DataFrame) -> DataFrame:
        """Load the hubs; returns the rows with mapped keys. Hash columns are collected in ``hashes``."""
        config = self.config
        for hub in config.hubs:
            df = self._keep_hashes(df, set(hub.mapping.values()))
            rows = map_hub(df, hub, config.record_source)
            df = rows if config.spellings_everywhere else map_hub(df, hub, config.record_source, spellings=False)
            self.hashes |= hub_hash(hub)
            rows = self._subset(rows, "SPLIT_HUB", hub.name)
            if config.source_is_file:
                rows = C.source_from_file(rows)
            self._append_keys(hub.name, rows, hub.hash_key)
        if config.source_is_file:
            return C.source_from_file(df)
        return df.withColumn("RECORD_SOURCE", F.lit(config.record_source))

    def _keep_hashes(self, df: DataFrame, overwritten: set[str]) -> DataFrame:
        """Add hash columns whose key columns are about to change as they are now."""
        kept = {n: spec for n, spec in self.hashes.items() if overwritten & set(spec.columns)}
        self.hashes = {n: spec for n, spec in self.hashes.items() if n not in kept}
        return with_hashes(df, kept)

    def _append_keys(self, table: str, rows: DataFrame, key: str) -> None:
        prefixes = KeyPrefixes(self.lake, table, key)
        if prefixes.exists():
            prefixes.append_new(hashed_rows(rows, self.lake.columns(table), self.hashes))
        else:
            self.lake.append(table, key_rows(rows, self.lake.read(table), key, self.hashes))
        self._finish(table)

    def load_links(self, df: DataFrame) -> DataFrame:
        for link in self.config.links:
            self.hashes |= link_hash(link)
            self._append_keys(link.name, df, link.hash_key)
        return df

    def load_same_as(self, df: DataFrame) -> DataFrame:
        spec = self.config.same_as
        if spec is None:
            return df
        df = define_same_as(df, spec)
        self.hashes |= same_as_hashes(spec)
        self._append_keys(spec.link.name, df, spec.link.hash_key)
        return df

    def load_satellites(self, df: DataFrame) -> None:
        config = self.config
        ignore = UNMAPPED_COLUMNS if config.replicated else ()
        for table in config.satellites:
            target = self.lake.read(table)
            current = self._current(table, target)
            rows = satellite_rows(
                self._subset(df, "SPLIT_SAT", table),
                target,
                ignore=ignore,
                partition=self._partition(table),
                direct=config.flag("DIRECTINSERT") or config.history,
                current=current,
            )
            if self.resumed:
                rows = self._without_loaded(rows, target)
            if current is not None:
                append_and_merge(current, rows)
            elif config.history:
                append_counted(self.lake, table, rows, [] if config.source_is_file else [config.record_source])
            else:
                self.lake.append(table, rows)
            self._finish(table)

    def _without_loaded(self, rows: DataFrame, target: DataFrame) -> DataFrame:
        """Rows less the versions that the target has from this load; statistics of its files rule out most others."""
        shape = SatelliteShape.of(target.schema)
        mine = target.filter(quoted("LOAD_DATE_TIME") == moment(self.load_ts).cast(shape.types["LOAD_DATE_TIME"]))
        at = [shape.key, shape.diff]
        return rows.join(mine.select(*map(quoted, at)), at, "left_anti")

    def _current(self, table: str, target: DataFrame) -> CurrentVersions | None:
        """The satellite's table ``_CV`` of current versions, when it has one."""
        shape = SatelliteShape.of(target.schema)
        current = for_delta_check(self.lake, table, shape.key, shape.diff, shape.columns)
        if not current.exists():
            return None
        repair(current)
        return current

    def _partition(self, table: str) -> dict[str, str | None] | None:
        """Partition columns to compare within and the formats of their values, when the feed asks for it.

        All configured columns by which the table is partitioned count.
        """
        wanted = self.config.nested("filter_on_partition_column")
        if not wanted:
            return None
        formats = {p["partition_column_name"].lower(): p.get("partition_column_date_format") for p in wanted["partition_config"]}
        return {c: formats[c.lower()] for c in self.lake.partition_columns(table) if c.lower() in formats} or None

    def load_reference(self, df: DataFrame) -> None:
        name = self.config.settings["Ref_Name"]
        extract: C.Moment | Column = self.extract_ts if self.extract_ts is not None else self.load_ts
        rows = reference_rows(df, self.lake.columns(name), self.config.record_source, self.load_ts, extract)
        self.lake.swap(name, rows)
        self._finish(name)
