"""Settlement calendars kept by upsert, and business days between dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keystrata.functions.hashing import quoted
from keystrata.functions.times import moment
from keystrata.operators.columns import Moment
from keystrata.operators.merge import matched_keys, upsert
from keystrata.session import written
from keystrata.sources.files import read_csv_with_header
from keystrata.sources.tables import Lake

# The repeated column groups of the calendar file, in the order they are merged.
DELIVERY_BRANCHES = ("Prelim", "Revision 1", "Final", "Revision 2")
HOLIDAY = "Holiday"
NOT_AVAILABLE = "n/a"
WEEK_TABLE = "REF_AEMO_CDR"
DELIVERY_TABLE = "REF_METER_DATA_CDR"

# Every date of the calendar domain (years 1 to 9999) is one row of the day table at most.
MAX_DAYS = 3_652_059


def merge_weeks(target: DataFrame, wide: DataFrame, load_ts: Moment, on_duplicate: str = "error") -> DataFrame:
    """New state of the week table ``(YR, WK, BILL_PD_START_DT, BILL_PD_END_DT, ROW_INSERT_DTM)``."""
    weeks = wide.select(
        quoted("Year").alias("YR"), quoted("Week Id").alias("WK"), quoted("Start"), quoted("End")
    )
    changed = {"BILL_PD_START_DT": "Start", "BILL_PD_END_DT": "End", "ROW_INSERT_DTM": moment(load_ts)}
    return upsert(target, weeks, ["YR", "WK"], changed, {"YR": "YR", "WK": "WK", **changed}, on_duplicate, [F.col("End").desc()])


def delivery_rows(wide: DataFrame) -> DataFrame:
    """One row per filled column group: ``(branch, TYP, REQ_BY, DLVRY_DESC, FRM_DT, TO_DT, SRC_YR)``.

    The four delivery groups and the holiday group of a row unfold in one pass. A holiday needs both its date
    and its code.
    """
    groups = [
        F.struct(
            F.lit(i).alias("branch"),
            quoted(f"{name} Code").alias("TYP"),
            quoted(f"{name} When").alias("REQ_BY"),
            quoted(f"{name} Description").alias("DLVRY_DESC"),
            (quoted(f"{name} Start") if name != HOLIDAY else F.lit(None).cast("string")).alias("FRM_DT"),
            (quoted(f"{name} End") if name != HOLIDAY else F.lit(None).cast("string")).alias("TO_DT"),
            quoted("Year").alias("SRC_YR"),
        )
        for i, name in enumerate([*DELIVERY_BRANCHES, HOLIDAY], start=1)
    ]
    rows = wide.select(F.explode(F.array(*groups)).alias("g")).select("g.*")
    holiday = F.col("branch") == len(groups)
    valid = (F.col("TYP") != NOT_AVAILABLE) & (F.col("REQ_BY") != NOT_AVAILABLE)
    return rows.filter(~holiday | F.coalesce(valid, F.lit(False)))


_KEY = ["TYP", "REQ_BY"]
_CHANGED = ("DLVRY_DESC", "FRM_DT", "TO_DT")


def merge_deliveries(target: DataFrame, wide: DataFrame, load_ts: Moment) -> DataFrame:
    """New state of ``(REQ_BY, TYP, DLVRY_DESC, FRM_DT, TO_DT, SRC_YR, ROW_INSERT_DTM)``.

    The result is that of five merges in a row, one per column group, computed in one: the first group that
    holds a new key inserts it and gives its source year, the last group that holds a key gives its dates and
    description. A NULL in the key never matches, so such rows are always inserted. Several rows of one group
    for a key that exists already are an error, as in a merge.
    """
    rows = written(delivery_rows(wide), "deliveries")  # read by several branches below
    filled = F.col("TYP").isNotNull() & F.col("REQ_BY").isNotNull()
    stamp = moment(load_ts).cast(target.schema["ROW_INSERT_DTM"].dataType)

    per_branch = (
        rows.filter(filled)
        .groupBy(*_KEY, "branch")
        .agg(F.count("*").alias("n"), F.max(F.struct(*_CHANGED)).alias("change"))
    )
    per_key = per_branch.groupBy(*_KEY).agg(
        F.min("branch").alias("first"),
        F.max("branch").alias("last"),
        F.max_by("change", "branch").alias("change"),
        F.max(F.struct((F.col("n") > 1).alias("repeated"), F.col("branch").alias("branch"))).alias("latest_repeat"),
    )
    known = target.filter(filled)
    repeats = per_key.filter("latest_repeat.repeated")
    matched = matched_keys(known, per_key, _KEY)
    late = repeats.filter("latest_repeat.branch > first").select(*_KEY)
    clash = late.union(repeats.join(matched, _KEY, "left_semi").select(*_KEY))
    if not clash.isEmpty():
        raise ValueError("several calendar rows of one group match one delivery")

    def ordered(df: DataFrame) -> DataFrame:
        return df.select(*(F.col(c).cast(target.schema[c].dataType).alias(c) for c in target.columns))

    changes = per_key.select(*_KEY, F.col("change").alias("__change"))
    updated = known.join(changes, _KEY, "left")
    hit = F.col("__change").isNotNull()
    updated = updated.withColumns(
        {
            **{c: F.when(hit, F.col("__change")[c]).otherwise(F.col(c)) for c in _CHANGED},
            "ROW_INSERT_DTM": F.when(hit, stamp).otherwise(F.col("ROW_INSERT_DTM")),
        }
    )
    fresh = per_key.join(matched, _KEY, "left_anti").select(
        *_KEY, F.col("first").alias("branch"), "last", F.col("change").alias("__change")
    )
    later = F.col("last") > F.col("branch")
    inserted = rows.join(fresh, [*_KEY, "branch"]).withColumns(
        {c: F.when(later, F.col("__change")[c]).otherwise(F.col(c)) for c in _CHANGED}
    )
    unkeyed = rows.filter(~filled)
    return (
        ordered(updated)
        .unionByName(target.filter(~filled))
        .unionByName(ordered(inserted.withColumn("ROW_INSERT_DTM", stamp)))
        .unionByName(ordered(unkeyed.withColumn("ROW_INSERT_DTM", stamp)))
    )


def load_calendar(lake: Lake, path: str, load_ts: Moment, export_to: str | None = None, area: str = "transform") -> None:
    """Merge a calendar file into both calendar tables and export them."""
    wide = read_csv_with_header(lake.spark, path)
    for table, merge in ((WEEK_TABLE, merge_weeks), (DELIVERY_TABLE, merge_deliveries)):
        lake.swap(table, merge(lake.read(table, area), wide, load_ts), area)
        if export_to:
            lake.export(table, f"{export_to.rstrip('/')}/{table.lower()}", area)


def _dated(calendar: DataFrame) -> DataFrame:
    day = F.col("DT_CAL_DATE").cast("date")
    return calendar.select(day.alias("day"), F.col("VIC_BD_IND").cast("int").alias("open")).filter(
        F.year("day").between(1, 9999)
    )


def business_day_totals(calendar: DataFrame) -> DataFrame:
    """``(day, through)``: business days up to and including each day from the day before the calendar on.

    Running totals are taken within a year and then over years, so no task sees more than a year of days.
    """
    dated = _dated(calendar)
    marked = dated.groupBy("day").agg(F.max((F.coalesce("open", F.lit(0)) == 1).cast("int")).alias("open"))
    span = dated.agg(F.date_sub(F.min("day"), 1).alias("a"), F.max("day").alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("day")).join(marked, "day", "left")
    days = days.select("day", F.year("day").alias("yr"), F.coalesce("open", F.lit(0)).alias("open"))
    within = Window.partitionBy("yr").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("yr").rowsBetween(Window.unboundedPreceding, 0)
    spanned = days.groupBy("yr").agg(F.sum("open").alias("n"))
    before = spanned.select("yr", (F.sum("n").over(earlier) - F.col("n")).alias("before"))
    return days.withColumn("in_year", F.sum("open").over(within)).join(F.broadcast(before), "yr").select(
        "day", (F.col("before") + F.col("in_year")).alias("through")
    )


def with_business_days(df: DataFrame, start: str, end: str, calendar: DataFrame, name: str = "businessdays") -> DataFrame:
    """Business days from ``start`` to ``end``, both included; NULL or inverted dates give 0.

    A difference of two running totals, looked up by two joins on the day. The day table has at most
    `MAX_DAYS` rows whatever the data, so it is broadcast and ``df`` is not shuffled.
    """
    totals = business_day_totals(calendar)
    dated = _dated(calendar)
    low = dated.select(F.date_sub(F.min("day"), 1)).scalar()
    high = dated.select(F.max("day")).scalar()

    def clamp(day):
        # greatest and least skip NULLs, so a NULL date needs its own branch.
        return F.when(day.isNotNull(), F.greatest(low, F.least(high, day)))

    bounded = df.withColumns(
        {
            "__before": clamp(F.date_sub(quoted(start).cast("date"), 1)),
            "__until": clamp(quoted(end).cast("date")),
        }
    )
    at_start = totals.select(F.col("day").alias("__before"), F.col("through").alias("__n0"))
    at_end = totals.select(F.col("day").alias("__until"), F.col("through").alias("__n1"))
    looked_up = bounded.join(F.broadcast(at_start), "__before", "left").join(F.broadcast(at_end), "__until", "left")
    days = F.when(F.col("__n1") > F.col("__n0"), F.col("__n1") - F.col("__n0")).otherwise(F.lit(0))
    return looked_up.withColumn(name, days.cast("bigint")).select(*map(quoted, df.columns), name)
