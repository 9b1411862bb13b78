"""Visitor logic on page-log streams; same results as ``operators.visits`` on tables.

Each function takes a streaming frame with ``common``, ``page``, ``ts``, ``seq`` and event time
``et``. Records travel through the state operators as JSON text.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.times import to_date_str
from tidemart.functions.values import slice_start
from tidemart.operators.visits import (
    IS_NEW,
    JUMP_SLICE_MS,
    JUMP_TIMEOUT_MS,
    MID,
    first_visit_day,
    session_start_filter,
)
from tidemart.streaming import processors

# Executors need no installed copy of the processors: they travel with the query.
cloudpickle.register_pickle_by_value(processors)

DAY_TTL_MS = 24 * 60 * 60 * 1000
#: Parts that the rows of one visitor are dealt to.
PARTS = 16
#: Buckets of visitors, of their parts or of their time slices: each is one call per micro-batch.
BUCKETS = 128


def _bucket(*columns):
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).cast("int")


def _payload(df: DataFrame):
    return F.to_json(F.struct(*[c for c in df.columns if c != "et"]))


def _record_schema(df: DataFrame) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != "et"])


def _unpacked(df: DataFrame, schema: T.StructType, *more: str) -> DataFrame:
    return df.select(F.from_json("payload", schema).alias("_r"), *more).select("_r.*", *more)


def repair_is_new_stream(logs: DataFrame, tz: str = "UTC", parts: int = PARTS) -> DataFrame:
    """``operators.visits.repair_is_new`` in two levels, so that a busy visitor is no single task.

    By visitor only the first-visit date is kept: it is found from one row for each chunk of input and
    part. Rows marked new are dealt by (visitor, part), where each part is told the date; all other rows
    cannot change and go neither through the state nor through Python. Visitors and parts are dealt to
    buckets, so calls grow with the buckets and not with the visitors.
    """
    schema = _record_schema(logs)
    marked = F.col(IS_NEW) == "1"
    part = F.pmod(F.xxhash64("ts", "seq"), F.lit(parts)).cast("int")
    thin = logs.select(
        F.col(MID).alias("mid"),
        F.when(marked, part).otherwise(F.lit(processors.NO_PART)).alias("part"),
        "ts",
        "seq",
        first_visit_day(F.col(IS_NEW), F.col("ts"), tz).alias("first_day"),
    )

    def heads(chunks):
        """One row for each visitor and part of a chunk, with the visitor's first record there."""
        for chunk in chunks:
            first = chunk.sort_values(["ts", "seq"]).drop_duplicates("mid").drop(columns="part")
            yield chunk[["mid", "part"]].drop_duplicates().merge(first, on="mid")[list(chunk.columns)]

    days = (
        thin.mapInPandas(heads, thin.schema)
        .withColumn("bucket", _bucket("mid"))
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=processors.FirstVisitDay(),
            outputStructType="mid string, part int, first_day string",
            outputMode="Append",
            timeMode="None",
        )
    )
    fresh = logs.where(marked).select(
        F.col(MID).alias("mid"), part.alias("part"), to_date_str("ts", tz).alias("day"), _payload(logs).alias("payload")
    )
    both = fresh.unionByName(days, allowMissingColumns=True)
    fixed = both.withColumn("bucket", _bucket("mid", "part")).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=processors.FirstVisitMark(),
        outputStructType="is_new string, payload string",
        outputMode="Append",
        timeMode="None",
    )
    rows = _unpacked(fixed, schema, "is_new")
    repaired = rows.withColumn("common", F.col("common").withField("is_new", F.col("is_new"))).drop("is_new")
    others = logs.where(F.coalesce(~marked, F.lit(True))).select(*repaired.columns)
    return others.unionByName(repaired)


def unique_visitor_stream(pages: DataFrame, tz: str = "UTC", ttl_ms: int = DAY_TTL_MS) -> DataFrame:
    """The first session start of a visitor on a day, given as it comes; no row is too late.

    Repeats within a chunk of input are dropped before the shuffle, so a busy visitor sends one row
    for each chunk and day. The state is kept ``ttl_ms`` of event time after a visit was given. The
    watermark moves that clock only: the state operator gets no event-time column to drop rows by.
    """
    schema = _record_schema(pages)
    keyed = session_start_filter(pages.withWatermark("et", "0 seconds")).select(
        F.col(MID).alias("mid"),
        to_date_str("ts", tz).alias("day"),
        "ts",
        "seq",
        _payload(pages).alias("payload"),
    )

    def first_of_chunk(chunks):
        for chunk in chunks:
            yield chunk.sort_values(["ts", "seq"]).drop_duplicates(["mid", "day"])

    thinned = keyed.mapInPandas(first_of_chunk, keyed.schema)
    firsts = thinned.groupBy("mid").transformWithStateInPandas(
        statefulProcessor=processors.DailyFirst(ttl_ms),
        outputStructType="payload string",
        outputMode="Append",
        timeMode="EventTime",
    )
    return _unpacked(firsts, schema)


def user_jump_stream(
    pages: DataFrame,
    timeout_ms: int = JUMP_TIMEOUT_MS,
    slice_ms: int = JUMP_SLICE_MS,
    delay: str = "2 seconds",
) -> DataFrame:
    """Jumps are given once the watermark, ``delay`` behind the newest row, passes the timeout.

    Rows near the start of a time slice are also sent to the slice before it, without payload, as
    possible successors. Pairs of a visitor and a slice are dealt to buckets, so a busy visitor is dealt
    by slice and calls grow with the buckets.
    """
    schema = _record_schema(pages)
    width = max(timeout_ms, slice_ms)
    is_start = F.col("page.last_page_id").isNull()
    this = slice_start(F.col("ts"), width)
    at_head = F.col("ts") - this < timeout_ms
    slices = F.when(at_head, F.array(this, this - F.lit(width))).otherwise(F.array(this))
    copies = (
        pages.withWatermark("et", delay)
        .withColumn("_own", this)
        .withColumn("slice", F.explode(slices))
    )
    keyed = copies.select(
        F.to_json(F.struct(F.col(MID).alias("mid"), "slice")).alias("name"),
        _bucket(MID, "slice").alias("bucket"),
        "slice",
        "et",
        "ts",
        "seq",
        is_start.alias("is_start"),
        F.when(is_start & (F.col("slice") == F.col("_own")), _payload(pages)).alias("payload"),
    )
    jumps = keyed.where("ts IS NOT NULL").groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=processors.JumpDetector(timeout_ms),
        outputStructType="reason string, payload string",
        outputMode="Append",
        timeMode="EventTime",
    )
    return _unpacked(jumps, schema, "reason")
