"""Bitmaps of key hashes beside hubs and links, so that a load meets the target with possible hits only.

``<HUB>_KP`` holds 32,768 bits for each block of keys. A key has one block and three bits in it, all from its hash; about
four bytes stand for a key of forty. A batch first meets the bitmaps: what lacks a bit is new for certain. Only the
rest is looked up in the target, which is not read at all when nothing is left.

Bits are written before the rows they stand for. A load that breaks off in between leaves bits without rows; these only
cost a look-up. Whoever adds rows to the target past `append_new` has to `rebuild` the bitmaps.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystrata.functions.hashing import quoted
from keystrata.operators.latest import one_per_key
from keystrata.session import released, written
from keystrata.sources.tables import Lake

BITS = 1 << 15  # of a block: the size that Spark's bitmap aggregates have
KEYS_PER_BLOCK = 1024
_PLACES = 3
_DDL = "blocks bigint, block bigint, bits binary"


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _places(key: Column) -> list[Column]:
    """Bits of a key in its block, by a hash that does not depend on the one of the block."""
    spread = F.xxhash64(F.lit(17), key)
    return [F.shiftright(spread, 15 * i).bitwiseAND(F.lit(BITS - 1)) for i in range(_PLACES)]


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1


@dataclass(frozen=True)
class KeyPrefixes:
    """The bitmaps of a hub or link whose hash key is ``key``.

    Each load adds rows of its own blocks. All bits of a key are in one row, so rows are tested one by one. NULL keys are
    treated as the plain load does: they match nothing and are inserted by every load that has one.
    """

    lake: Lake
    target: str
    key: str
    area: str = "rawvault"

    @property
    def table(self) -> str:
        return f"{self.target}_KP"

    def exists(self) -> bool:
        return self.lake.exists(self.table, self.area)

    def rebuild(self, expected: int = 0) -> None:
        """Make the bitmaps anew from the target, for as many keys as it holds or ``expected``, whichever is more.

        Due when the target has outgrown its blocks (bits that are set for too many keys rule little out) or has
        many small loads behind it.
        """
        keys = self.lake.read(self.target, self.area)
        blocks = max(keys.count(), expected) // KEYS_PER_BLOCK + 1
        self.lake.create(self.table, _DDL, area=self.area)
        # A row without a block keeps the number of blocks where no key is yet.
        self.lake.append(self.table, self.lake.spark.sql(f"select {blocks}L as blocks, cast(null as bigint) as block, cast(null as binary) as bits"), self.area)
        self.add(keys)

    def _blocks(self) -> int:
        return self.lake.read(self.table, self.area).agg(F.max("blocks")).first()[0]

    def add(self, rows: DataFrame) -> None:
        """Set the bits of the rows' keys."""
        blocks = self._blocks()
        key = quoted(self.key).cast("string")
        # Dealt by block first: partial bitmaps made before a shuffle would outweigh the keys in them.
        dealt = rows.select(_block(key, blocks).alias("block"), F.array(*_places(key)).alias("places")).repartition("block")
        bits = dealt.select("block", F.explode("places").alias("place")).groupBy("block").agg(F.call_function("bitmap_construct_agg", "place").alias("bits"))
        self.lake.append(self.table, bits.select(F.lit(blocks).cast("long").alias("blocks"), "block", "bits"), self.area)

    def possible(self, rows: DataFrame) -> DataFrame:
        """Distinct keys of the rows that the target may hold; no key that it holds is left out."""
        key = quoted(self.key).cast("string")
        asked = rows.select(quoted(self.key)).distinct().withColumns(
            {"block": _block(key, self._blocks()), **{f"place{i}": p for i, p in enumerate(_places(key))}}
        )
        known = self.lake.read(self.table, self.area).filter("block is not null").select("block", "bits")
        hit = reduce(and_, (_is_set(F.col("k.bits"), F.col(f"a.place{i}")) for i in range(_PLACES)))
        return asked.alias("a").join(known.alias("k"), (F.col("a.block") == F.col("k.block")) & hit, "left_semi").select(quoted(self.key))

    def new_rows(self, rows: DataFrame, possible: DataFrame) -> DataFrame:
        """Rows whose key the target lacks. ``possible`` is what `possible` gave, written."""
        if possible.isEmpty():
            return rows
        # Few possible keys are broadcast and the target's keys are filtered where they are read.
        known = self.lake.read(self.target, self.area).select(quoted(self.key)).join(possible, self.key, "left_semi")
        return rows.join(known, self.key, "left_anti")

    def append_new(self, rows: DataFrame) -> None:
        """Append one row for each key that the target lacks, bits first."""
        batch = written(one_per_key(rows, [self.key]), "key-batch")
        possible = written(self.possible(batch), "possible-keys")
        fresh = written(self.new_rows(batch, possible), "new-keys")
        self.add(fresh)
        self.lake.append(self.target, fresh, self.area)
        released(batch, possible, fresh)
