"""Catalog tables: naming by environment, appends, whole-table replacement, backups.

Open-source Spark cannot update or delete rows of a parquet table and cannot overwrite a table it reads. So
rows are only appended, and a new state is written to a new folder before the table is pointed at it. There is
no transaction: readers see the old state until the switch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystrata.operators.columns import select_target


@dataclass(frozen=True)
class Lake:
    """Table names and folders of one environment.

    ``im<env>_<area>`` is the database of an area (``rawvault``, ``transform``, ``hist_data``, ``dimlayer``).
    ``locations`` gives single tables another base folder.
    """

    spark: SparkSession
    env: str
    root: str
    locations: Mapping[str, str] = field(default_factory=dict)

    def database(self, area: str) -> str:
        return f"im{self.env}_{area}"

    def name(self, table: str, area: str = "rawvault") -> str:
        return f"{self.database(area)}.{table}"

    def folder(self, table: str, area: str = "rawvault") -> str:
        if table in self.locations:
            return f"{self.locations[table].strip()}{self.env}/{area}/{table}"
        return f"{self.root.rstrip('/')}/im{self.env}/{area}/{table}"

    def create_database(self, area: str = "rawvault") -> None:
        database = self.database(area)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root.rstrip('/')}/{database}.db'")

    def create(
        self,
        table: str,
        schema: T.StructType | str,
        partition_by: Sequence[str] = (),
        area: str = "rawvault",
        bucket_by: tuple[int, Sequence[str]] | None = None,
    ) -> None:
        """Drop the table if it exists and create it empty, in a new folder.

        ``bucket_by`` suits hubs and links: their hash keys are unique and even, and joins on the key then read
        the table without a shuffle. A satellite with a very frequent key would get one very large bucket.
        """
        ddl = schema if isinstance(schema, str) else schema.toDDL()
        name = self.name(table, area)
        parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        buckets = f"CLUSTERED BY ({', '.join(bucket_by[1])}) INTO {bucket_by[0]} BUCKETS" if bucket_by else ""
        self.create_database(area)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(
            f"CREATE TABLE {name} ({ddl}) USING parquet {parts} {buckets} LOCATION '{self.new_folder(table, area)}'"
        )

    def new_folder(self, table: str, area: str = "rawvault") -> str:
        """A folder for a new state of the table or of some partitions."""
        return f"{self.folder(table, area)}/v-{uuid.uuid4().hex}"

    def exists(self, table: str, area: str = "rawvault") -> bool:
        return self.spark.catalog.tableExists(self.name(table, area))

    def read(self, table: str, area: str = "rawvault") -> DataFrame:
        return self.spark.table(self.name(table, area))

    def columns(self, table: str, area: str = "rawvault") -> list[str]:
        return self.read(table, area).columns

    def layout(self, table: str, area: str = "rawvault") -> tuple[list[str], list[str]]:
        """Partition columns and bucket columns."""
        columns = self.spark.catalog.listColumns(self.name(table, area))
        return [c.name for c in columns if c.isPartition], [c.name for c in columns if c.isBucket]

    def partition_columns(self, table: str, area: str = "rawvault") -> list[str]:
        return self.layout(table, area)[0]

    def bucketing(self, table: str, area: str = "rawvault") -> tuple[int, list[str]] | None:
        """Number of buckets and bucket columns."""
        columns = self.layout(table, area)[1]
        return (self._bucket_count(table, area), columns) if columns else None

    def _bucket_count(self, table: str, area: str) -> int:
        described = self.spark.sql(f"DESCRIBE EXTENDED {self.name(table, area)}").filter("col_name = 'Num Buckets'")
        return int(described.head().data_type)

    def append(
        self, table: str, rows: DataFrame, area: str = "rawvault", observed: Callable[[DataFrame], DataFrame] | None = None
    ) -> None:
        """Insert rows by the target's columns and order.

        Rows for a partitioned table are rebalanced by partition, which keeps files few and splits a
        partition that holds most of the rows over several tasks. Rows for a bucketed table are brought to one
        task per bucket, which writes one file. ``observed`` attaches an observation to the rows; it is put behind
        all shuffles, where a task that is repeated does not count twice.
        """
        rows = select_target(rows, self.columns(table, area))
        parts, buckets = self.layout(table, area)
        if buckets:
            rows = rows.repartition(self._bucket_count(table, area), *buckets)
        elif parts:
            rows = rows.hint("rebalance", *parts)
        if observed:
            rows = observed(rows)
        rows.write.insertInto(self.name(table, area))
        self.spark.catalog.refreshTable(self.name(table, area))

    def swap(self, table: str, state: DataFrame, area: str = "rawvault") -> None:
        """Replace the contents by ``state``, which may read the table itself.

        Only for plain tables, as the ones kept by upsert and reload are. Of partitioned tables single partitions are
        replaced, see `keystrata.sources.partitions`.
        """
        if any(self.layout(table, area)):
            raise ValueError(f"{table} is partitioned or bucketed; replace its partitions or append to it instead")
        name, folder = self.name(table, area), self.new_folder(table, area)
        schema = self.read(table, area).schema
        typed = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
        state.select(*typed).write.parquet(folder)
        self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        self.spark.catalog.refreshTable(name)

    def truncate(self, table: str, area: str = "rawvault") -> None:
        """Leave the table empty in a new folder; Spark does not truncate tables with a location of their own.

        A plain table is pointed at the new folder. A partitioned or bucketed one is dropped and created again; its name
        is missing for that moment.
        """
        if any(self.layout(table, area)):
            self.create_like(table, table, area)
        else:
            self.swap(table, self.read(table, area).limit(0), area)

    def drop(self, table: str, area: str = "rawvault") -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table, area)}")

    def create_like(self, table: str, model: str, area: str = "rawvault") -> None:
        """Create an empty table with the columns, partitions and buckets of another one, or of itself."""
        schema, parts = self.read(model, area).schema, self.partition_columns(model, area)
        self.create(table, schema, parts, area, self.bucketing(model, area))

    def backup(self, table: str, area: str = "rawvault") -> str:
        """Copy of the table as ``<table>_bkp``, laid out alike."""
        copy = f"{table}_bkp"
        self.create_like(copy, table, area)
        self.append(copy, self.read(table, area), area)
        return copy

    def export(self, table: str, folder: str, area: str = "rawvault") -> None:
        """Write the table as plain parquet files for readers outside Spark."""
        self.read(table, area).write.mode("overwrite").parquet(folder)

    def replace(
        self, table: str, rows: DataFrame, area: str = "transform", bucket_by: tuple[int, Sequence[str]] | None = None
    ) -> None:
        """Drop and recreate a table from a query, such as a JDBC scan.

        The rows are written under another name first, so a failing query leaves the old table as it was. Between the
        drop and the renaming the name is missing for a moment. Bucketed rows are brought to one task per bucket.
        """
        self.create_database(area)
        fresh, name = self.name(f"{table}__new", area), self.name(table, area)
        self.spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        if bucket_by:
            rows = rows.repartition(bucket_by[0], *bucket_by[1])
        writer = rows.write.format("parquet").option("path", self.new_folder(table, area))
        if bucket_by:
            writer = writer.bucketBy(bucket_by[0], *bucket_by[1])
        writer.saveAsTable(fresh)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
