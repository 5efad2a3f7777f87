"""Exact deduplication: group by a 128-bit content hash, then compare bytes inside the groups.

Only hashes and ids are grouped, with map-side combining, so a text held by a third of all rows sends one row per
task. Texts move once, in a plain join with the hashes that occur more than once, which adaptive execution can
split by rows when one hash is frequent. No group is ever gathered in a task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystrata.session import released, written


def hash128(text: Column) -> Column:
    """128-bit content hash."""
    return F.md5(text)


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "min",
    hashed: Callable[[Column], Column] = hash128,
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when their bytes are. ``keep`` says whether the smallest (``min``) or the largest (``max``) id
    of equal texts stays. A NULL text counts as empty; all empty texts are one group. A row whose id is NULL takes
    part in the group, is never the one that stays while another has an id, and keeps its NULL id. Repeated ids
    with equal texts: ``kept`` is true for each of those rows, as they cannot be told apart. Other columns are not
    read, whatever their names. An empty table gives an empty result.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is min or max")
    best = F.min if keep == "min" else F.max
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), text.alias("text"))
    rows = rows.select("id", "text", hashed(F.col("text")).alias("h"))
    # What is joined below is written first: both sides of each join are then plain shuffles, whose large
    # partitions Spark can split.
    keys = written(rows.select("id", "h", F.sha2("text", 256).alias("sha")), "exact-dedup-keys")
    groups = written(
        keys.groupBy("h").agg(F.count(F.lit(1)).alias("n"), best("id").alias("keep_id"), F.min("sha").alias("keep_sha")),
        "exact-dedup-groups",
    )

    # Bytes of every row in a group of two or more against those of one text of the group.
    members = written(rows.join(groups.filter("n > 1").select("h", "keep_sha"), "h"), "exact-dedup-members")
    first = written(
        members.filter(F.sha2("text", 256) == F.col("keep_sha")).groupBy("h").agg(F.max("text").alias("first_text")),
        "exact-dedup-firsts",
    )
    unequal = members.join(first, "h").filter(F.col("text") != F.col("first_text")).select("h")
    clashes = written(unequal, "exact-dedup-unequal").distinct()
    # Groups in which different texts met are grouped again by the text itself; as a rule there are none.
    regrouped = (
        members.join(clashes, "h", "left_semi")
        .groupBy("h", "text")
        .agg(F.count(F.lit(1)).alias("n"), best("id").alias("keep_id"))
        .select("h", F.sha2("text", 256).alias("sha"), F.col("n").alias("own_n"), F.col("keep_id").alias("own_keep"))
    )
    clashing = written(regrouped, "exact-dedup-clashes")
    released(members, first)
    found = keys.join(groups.select("h", "n", "keep_id"), "h").join(clashing, ["h", "sha"], "left")
    own = F.col("own_n").isNotNull()
    keep_id = F.when(own, F.col("own_keep")).otherwise(F.col("keep_id"))
    return found.select(
        F.col("id").alias(id_column),
        keep_id.alias("keep_id"),
        F.when(own, F.col("own_n")).otherwise(F.col("n")).alias("group_size"),
        F.coalesce(F.col("id") == keep_id, F.col("id").isNull() & keep_id.isNull()).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
