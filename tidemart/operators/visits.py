"""Visitor logic on page logs, for tables. The streaming forms are in ``streaming.visits``.

Rows of one visitor are taken in the order (ts, seq). One visitor may own a large share of all
rows, so no step here puts all rows of a visitor into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.times import DAY_MS, to_date_str
from tidemart.functions.values import packed_first, slice_start, unpacked_first

MID = "common.mid"
IS_NEW = "common.is_new"
JUMP_TIMEOUT_MS = 10_000
JUMP_SLICE_MS = 60_000


def session_start_filter(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("page.last_page_id").isNull())


def first_visit_day(is_new: Column, ts: Column, tz: str) -> Column:
    """The date a first-seen record stands for: its own if marked new, else the day before."""
    marked = is_new.eqNullSafe(F.lit("1"))
    return F.when(marked, to_date_str(ts, tz)).otherwise(to_date_str(ts - F.lit(DAY_MS), tz))


#: Parts that rows which cannot change are dealt to, by day, in the join with the first visits.
SPREAD = 4096


def first_visits(logs: DataFrame, tz: str = "UTC") -> DataFrame:
    """``(_mid, _day)``: the date of each visitor's first visit, as a hash aggregate with map-side
    combine; a record travels as one number."""
    flag = F.when(F.col(IS_NEW) == "1", 1).otherwise(0)
    packed = packed_first(F.col("ts"), F.col("seq"), flag)
    firsts = logs.groupBy(F.col(MID).alias("_mid")).agg(F.min(packed).alias("_f"))
    ts, _, is_new = unpacked_first("_f")
    day = first_visit_day(F.col("flag").cast("string"), F.col("ts"), tz)
    return firsts.select("_mid", ts, is_new).select("_mid", day.alias("_day"))


def repair_is_new(logs: DataFrame, tz: str = "UTC") -> DataFrame:
    """Set ``common.is_new`` from '1' to '0' where the visitor was first seen on another day.

    The input is read twice: for the first visits, from four of its fields, and for the rows. Both
    meet on (visitor, day) in a left join: that splits a busy visitor by day, both join inputs are
    plain exchanges, so AQE can split what is still skewed. Rows that are not marked new have no day
    that a visit could have; they are spread over the tasks.
    """
    firsts = first_visits(logs, tz)
    marked = F.coalesce(F.col(IS_NEW) == "1", F.lit(False))
    nowhere = F.pmod(F.xxhash64("ts", "seq"), F.lit(SPREAD)).cast("string")
    dated = logs.withColumn("_d", F.when(marked, to_date_str("ts", tz)).otherwise(nowhere))
    on_first_day = (F.col(MID) == F.col("_mid")) & (F.col("_d") == F.col("_day"))
    joined = dated.join(firsts, on_first_day, "left")
    is_new = F.when(~marked, F.col(IS_NEW)).when(F.col("_mid").isNull(), "0").otherwise("1")
    return joined.withColumn("common", F.col("common").withField("is_new", is_new)).select(*logs.columns)


def unique_visitor(pages: DataFrame, tz: str = "UTC") -> DataFrame:
    """The first session start of each visitor on each day.

    In time order a date never comes back, so this is the first row per (visitor, day); it is
    cut to one row per group in each map task before the shuffle.
    """
    first = Window.partitionBy("_mid", "_day").orderBy("ts", "seq")
    starts = session_start_filter(pages)
    keyed = starts.withColumn("_mid", F.col(MID)).withColumn("_day", to_date_str("ts", tz))
    ranked = keyed.withColumn("_rn", F.row_number().over(first)).where("_rn = 1")
    return ranked.select(*pages.columns)


def user_jump(
    pages: DataFrame,
    timeout_ms: int = JUMP_TIMEOUT_MS,
    slice_ms: int = JUMP_SLICE_MS,
) -> DataFrame:
    """Session starts followed at once by another session start, or by nothing in time.

    Adds ``reason``: 'match' if the next record is a session start closer than the timeout,
    'timeout' if no record is that close. Only the next record within the timeout matters, so
    rows are grouped by visitor and time slice, and each slice also gets the head of the next
    slice. Records that start no session only travel as (ts, seq).
    """
    width = max(timeout_ms, slice_ms)
    is_start = F.col("page.last_page_id").isNull()
    keyed = pages.select(
        F.col(MID).alias("_mid"),
        slice_start(F.col("ts"), width).alias("_slice"),
        F.col("ts").alias("_ts"),
        F.col("seq").alias("_seq"),
        is_start.alias("_start"),
        F.when(is_start, F.struct(*pages.columns)).alias("_row"),
    )
    packed = packed_first(F.col("_ts"), F.col("_seq"), F.col("_start").cast("int"))
    heads = (
        keyed.where(F.col("_ts") - F.col("_slice") < timeout_ms)
        .groupBy("_mid", "_slice")
        .agg(F.min(packed).alias("_h"))
        .select("_mid", (F.col("_slice") - F.lit(width)).alias("_slice"), *unpacked_first("_h"))
        .selectExpr("_mid", "_slice", "ts AS _ts", "seq AS _seq", "flag = 1 AS _start")
    )
    rows = keyed.unionByName(heads, allowMissingColumns=True)
    in_order = Window.partitionBy("_mid", "_slice").orderBy("_ts", "_seq")
    following = rows.withColumn("_next_ts", F.lead("_ts").over(in_order)).withColumn(
        "_next_start", F.lead("_start").over(in_order)
    )
    close = F.coalesce(F.col("_next_ts") - F.col("_ts") < timeout_ms, F.lit(False))
    reason = F.when(~close, "timeout").when(F.col("_next_start"), "match")
    return (
        following.where(F.col("_row").isNotNull())
        .withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .select("_row.*", "reason")
    )


def split_jumps(jumps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Jumps that were followed by another session start, and those that timed out, as two outputs."""
    matched, timed_out = (jumps.where(F.col("reason") == r).drop("reason") for r in ("match", "timeout"))
    return matched, timed_out
