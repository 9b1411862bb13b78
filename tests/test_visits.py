"""Visitor operators against plain state machines, on tables and on streams."""

import datetime as dt
import random

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemart.functions.values import packed_first, unpacked_first
from tidemart.operators import config, visits
from tidemart.plans import traffic
from tidemart.schemas import COMMON, PAGE
from tidemart.session import scratch_dir
from tidemart.streaming import visits as streaming
from tidemart.streaming.runner import run_available, stream_of

SCHEMA = "mid string, is_new string, last string, ts long, seq long"
BASE = 1_704_067_200_000


def pages(spark, data):
    """``data``: (mid, is_new, last_page_id, ts) in arrival order."""
    made = [(m, n, last, BASE + ts, i) for i, (m, n, last, ts) in enumerate(data)]
    flat = spark.createDataFrame(made, SCHEMA)
    common = {"mid": F.col("mid"), "is_new": F.col("is_new")}
    page = {"page_id": F.lit("p"), "last_page_id": F.col("last"), "during_time": F.lit(5)}

    def struct(schema, values):
        return F.struct(*[
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])

    return flat.select(
        struct(COMMON, common).alias("common"), struct(PAGE, page).alias("page"), "ts", "seq")


def day(ts):
    return dt.datetime.fromtimestamp((BASE + ts) / 1000, dt.timezone.utc).strftime("%Y-%m-%d")


def in_order(data):
    numbered = [(*r, i) for i, r in enumerate(data)]
    return sorted(numbered, key=lambda r: (r[3], r[4]))


def plain_repair(data):
    first, out = {}, []
    for mid, is_new, _, ts, seq in in_order(data):
        if is_new == "1":
            if mid not in first:
                first[mid] = day(ts)
            elif first[mid] != day(ts):
                is_new = "0"
        elif mid not in first:
            first[mid] = day(ts - 86_400_000)
        out.append((seq, is_new))
    return sorted(out)


def plain_visitors(data):
    last, out = {}, []
    for mid, _, came_from, ts, seq in in_order(data):
        if came_from is None and last.get(mid) != day(ts):
            last[mid] = day(ts)
            out.append((seq,))
    return sorted(out)


def plain_jumps(data, timeout=10_000):
    out, ordered = [], in_order(data)
    for i, (mid, _, came_from, ts, seq) in enumerate(ordered):
        if came_from is not None:
            continue
        later = [r for r in ordered[i + 1:] if r[0] == mid]
        if not later or later[0][3] - ts >= timeout:
            out.append((seq, "timeout"))
        elif later[0][2] is None:
            out.append((seq, "match"))
    return sorted(out)


def check(spark, data):
    df = pages(spark, data).cache()
    repaired = visits.repair_is_new(df).select("seq", "common.is_new")
    assert rows(repaired) == sorted(plain_repair(data), key=repr)
    assert rows(visits.unique_visitor(df).select("seq")) == sorted(plain_visitors(data), key=repr)
    assert rows(visits.user_jump(df).select("seq", "reason")) == sorted(plain_jumps(data), key=repr)
    df.unpersist()


times = st.one_of(
    st.integers(0, 200_000),
    st.integers(0, 300).map(lambda s: s * 1000),
    st.integers(0, 4).map(lambda d: d * 86_400_000 - 1 if d else 0),
    st.integers(0, 30).map(lambda h: h * 3_600_000),
)
log = st.lists(
    st.tuples(
        st.sampled_from("abc"), st.sampled_from(["0", "1", None]),
        st.sampled_from([None, "home"]), times),
    min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=log)
def test_batch_forms_are_the_state_machines(spark, data):
    check(spark, data)


def test_busy_visitor(spark):
    random.seed(3)
    data = [
        ("busy" if random.random() < 0.6 else f"m{random.randrange(50)}",
         random.choice("01"), random.choice([None, "home"]),
         random.randrange(3 * 86_400_000) // 100 * 100 if random.random() < 0.3
         else random.randrange(2_000_000))
        for _ in range(1500)
    ]
    check(spark, data)


def test_timeout_edge(spark):
    data = [("a", "1", None, 0), ("a", "1", None, 10_000), ("a", "1", None, 19_999), ("a", "1", "x", 29_998)]
    got = rows(visits.user_jump(pages(spark, data)).select("seq", "reason"))
    assert got == [(0, "timeout"), (1, "match")]


def test_slice_edge(spark):
    """The successor lies in the next time slice."""
    data = [("a", "1", None, 59_500), ("a", "1", None, 60_100), ("b", "1", None, 59_500), ("b", "1", "x", 60_100)]
    got = rows(visits.user_jump(pages(spark, data)).select("seq", "reason"))
    assert got == [(0, "match"), (1, "timeout")]


def test_a_zone_moves_the_day(spark):
    data = [("a", "1", None, 15 * 3_600_000), ("a", "1", None, 17 * 3_600_000)]
    df = pages(spark, data)
    assert visits.unique_visitor(df).count() == 1
    assert visits.unique_visitor(df, tz="GMT+8").count() == 2


def test_repair_splits_a_busy_visitor(spark):
    """Rows meet the first visits by (visitor, day), an exchange that can be split further."""
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = pages(spark, [("a", "1", None, 0)])
        plan = visits.repair_is_new(df)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "SortMergeJoin" in plan and "partial_min" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


def stream_rows(spark, data, job, files, flush=True):
    """The job over the rows as a stream, in ``files`` micro-batches."""
    topic = scratch_dir(spark, "t")
    ordered = sorted(range(len(data)), key=lambda i: data[i][3])
    size = -(-len(data) // files)
    numbered = pages(spark, data)
    for f in range(files):
        part = ordered[f * size:(f + 1) * size]
        numbered.where(F.col("seq").isin(part)).coalesce(1).write.mode("append").parquet(topic)
    schema = spark.read.parquet(topic).schema
    out, checkpoint = scratch_dir(spark, "o"), scratch_dir(spark, "c")

    def run():
        stream = stream_of(spark, topic, schema, files_per_trigger=1)
        run_available(job(stream.withColumn("et", F.timestamp_millis("ts"))), out, checkpoint)

    run()
    if flush:
        later = pages(spark, [("flush", "0", "home", 10**11)]).withColumn("seq", F.lit(-1).cast("long"))
        later.coalesce(1).write.mode("append").parquet(topic)
        run()
    return spark.read.parquet(out).where("seq >= 0")


DATA = [
    ("a", "1", None, 0), ("a", "1", None, 3_000), ("a", "1", "x", 4_000), ("b", "0", None, 5_000),
    ("b", "1", "x", 59_000), ("a", "1", None, 59_500), ("a", "0", None, 60_200), ("c", "1", None, 61_000),
    ("c", None, None, 71_000), ("c", "1", None, 80_999), ("a", "1", None, 86_400_000),
    ("c", "1", "x", 86_400_500), ("b", "1", None, 2 * 86_400_000), ("a", "1", None, 2 * 86_400_000 + 5),
]


def test_streams_are_the_state_machines(spark):
    repaired = stream_rows(spark, DATA, traffic.repair_is_new, 3, flush=False)
    assert rows(repaired.select("seq", "common.is_new")) == sorted(plain_repair(DATA), key=repr)
    visitors = stream_rows(spark, DATA, traffic.unique_visitor_detail, 3, flush=False)
    assert rows(visitors.select("seq")) == sorted(plain_visitors(DATA), key=repr)
    jumps = stream_rows(spark, DATA, traffic.user_jump_detail, 3)
    assert rows(jumps.select("seq", "reason")) == sorted(plain_jumps(DATA), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_records_are_hash_aggregates(spark):
    """First visits, heads of slices and newest rules: no sort before the combine."""
    df = pages(spark, [("a", "1", None, 0)])
    rules = spark.createDataFrame(
        [], "before struct<source_table:string>, after struct<source_table:string,sink_table:string,sink_columns:string,"
        "sink_pk:string,sink_extend:string>, op string, ts_ms long")
    for plan in map(plan_of, (visits.repair_is_new(df), visits.user_jump(df), config.latest_config(rules))):
        assert "SortAggregate" not in plan
    assert "HashAggregate" in plan_of(visits.first_visits(df))


def test_packed_first_records(spark):
    """The smallest number is the first record; all parts come back."""
    data = [(ts, seq, flag) for ts in (-5, 0, 1_704_067_200_000, 10**14) for seq in (-(10**18), -1, 0, 7, 4 * 10**18)
            for flag in (0, 1)]
    df = spark.createDataFrame(data, "ts long, seq long, flag int")
    packed = df.select("*", packed_first(F.col("ts"), F.col("seq"), F.col("flag")).alias("p"))
    back = packed.select("p", *unpacked_first("p")).orderBy("p").select("ts", "seq", "flag")
    assert [tuple(r) for r in back.collect()] == sorted(data)


def test_a_busy_visitor_of_a_stream(spark):
    """With nine tenths of the rows; marked rows are dealt to parts, and late rows count."""
    rng = random.Random(8)
    data = [
        ("busy" if rng.random() < 0.9 else f"m{rng.randrange(9)}", rng.choice(["0", "1", None]),
         rng.choice([None, "home"]), rng.randrange(3 * 86_400_000))
        for _ in range(600)
    ]
    repaired = stream_rows(spark, data, traffic.repair_is_new, 3, flush=False)
    assert rows(repaired.select("seq", "common.is_new")) == sorted(plain_repair(data), key=repr)
    df = pages(spark, data).withColumn("part", F.pmod(F.xxhash64("ts", "seq"), F.lit(streaming.PARTS)))
    marked = df.where("common.is_new = '1' AND common.mid = 'busy'")
    largest = max(n for _, n in marked.groupBy("part").count().collect())
    assert largest < marked.count() / 8


def test_a_late_visit_is_given(spark):
    """Days after the newest row: nothing is too late, and its date is kept like any other."""
    data = [("a", "1", None, 5 * 86_400_000), ("b", "1", None, 0), ("a", "1", None, 9 * 86_400_000)]
    topic, out, checkpoint = (scratch_dir(spark, n) for n in "toc")
    for part in ([0], [1], [2]):
        pages(spark, data).where(F.col("seq").isin(part)).coalesce(1).write.mode("append").parquet(topic)
        stream = stream_of(spark, topic, spark.read.parquet(topic).schema)
        run_available(traffic.unique_visitor_detail(stream.withColumn("et", F.timestamp_millis("ts"))), out, checkpoint)
    assert rows(spark.read.parquet(out).select("seq")) == [(0,), (1,), (2,)]
