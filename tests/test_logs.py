import json

from conftest import rows
from pyspark.sql import functions as F

from tidemart.functions import times
from tidemart.functions.text import explode_keywords
from tidemart.operators import applog, summaries
from tidemart.plans import summary, traffic
from tidemart.session import scratch_dir
from tidemart.streaming.late import late_aside

COMMON = {"ar": "1", "ch": "c", "is_new": "1", "mid": "m", "vc": "v"}
START = {"common": COMMON, "start": {"entry": "widget", "loading_time": 5}, "ts": 1_700_000_000_000}
PAGE = {
    "common": COMMON,
    "page": {"page_id": "home", "during_time": 7},
    "displays": [{"item": "1"}, {"item": "2", "ts": "old"}],
    "actions": [{"action_id": "get", "ts": "77"}],
    "err": {"error_code": 3},
    "ts": 1_700_000_000_001,
}


def logs(spark, *records):
    lines = spark.createDataFrame(
        [(json.dumps(r), i) for i, r in enumerate(records)], "value string, seq long")
    return lines


def routed(spark, *records):
    out, dirty = traffic.base_log(logs(spark, *records))
    return [(k, json.loads(v)) for k, v in out.collect()], dirty.count()


def test_routes(spark):
    out, dirty = routed(spark, START, PAGE, {"no": "common"})
    kinds = sorted(k for k, _ in out)
    assert kinds == ["action", "display", "display", "error", "page", "start"] and dirty == 1
    by = {k: v for k, v in out}
    assert by["error"] == PAGE
    assert by["page"] == {
        "common": COMMON, "page": PAGE["page"], "ts": PAGE["ts"]}
    assert by["start"]["start"]["entry"] == "widget"
    assert by["action"]["ts"] == "77" and by["action"]["page_id"] == "home"
    shown = [v for k, v in out if k == "display"]
    assert {d["item"] for d in shown} == {"1", "2"}
    assert all(d["ts"] == PAGE["ts"] and d["common"] == COMMON for d in shown)


def test_fields_of_no_layout(spark):
    common = {**COMMON, "sid": "s", "flags": [1, None]}
    page = {"page_id": "home", "during_time": 7.5, "source_type": "promo"}
    record = {"common": common, "page": page, "displays": [{"item": 4, "at": {"x": 1}}, 5],
              "actions": [{"n": 2}, None], "err": {"code": [1]}, "trace": {"id": 9}, "ts": "1700000000000"}
    out, dirty = routed(spark, record)
    by = dict(out)
    assert dirty == 0 and by["error"] == record
    assert by["page"] == {k: record[k] for k in ("common", "page", "trace", "ts")}
    assert by["action"] == {"n": 2, "common": common, "page_id": "home"}
    # An element that is no object gives no entry.
    assert by["display"] == {"item": 4, "at": {"x": 1}, "common": common, "page_id": "home", "ts": record["ts"]}
    assert sorted(k for k, _ in out) == ["action", "display", "error", "page"]
    start = {"common": {"mid": "n"}, "start": {"first_open": True}, "ts": 5}
    assert routed(spark, start) == ([("start", start)], 0)


def test_dirty_lines(spark):
    texts = ["", "x", "[1]", "7", "null", "{", '{"ts":1}', '{"common":{"mid":"m"}}',
             '{"common":{"mid":null},"ts":1}', '{"common":"m","ts":1}', None,
             '{"common":{"mid":"m"},"ts":1,"ts":2}']
    lines = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, seq long")
    out, dirty = traffic.base_log(lines)
    assert out.count() == 0
    assert rows(dirty.select("value", "seq")) == sorted(((t, i) for i, t in enumerate(texts)), key=repr)


def test_error_in_start_record(spark):
    out, _ = routed(spark, {**START, "err": "x"})
    assert sorted(k for k, _ in out) == ["error", "start"]
    assert all("err" not in v for k, v in out if k == "start")


def test_split_is_route(spark):
    valid, _ = traffic.valid_logs(logs(spark, START, PAGE, {**PAGE, "displays": [], "err": None}))
    counts = {k: df.count() for k, df in applog.split_log(valid).items()}
    expected = dict(applog.route_log(valid).groupBy("kind").count().collect())
    assert counts == expected == {"error": 1, "start": 1, "display": 2, "action": 2, "page": 2}


def test_times(spark):
    df = spark.createDataFrame([("2024-01-31", "2024-01-31 23:59:59", 1_706_716_799_999)], "d string, t string, ms long")
    got = df.select(
        times.to_ts("d", tz="GMT+8"), times.to_ts("t", True, "GMT+8"), times.to_date_str("ms"),
        times.to_ymdhms("ms", "GMT+8"), times.date_id("t"), times.date_id(F.lit("x")),
        F.unix_millis(times.row_time("ms")), times.now_seconds_ms() % 1000).first()
    assert tuple(got) == (
        1_706_630_400_000, 1_706_716_799_000, "2024-01-31",
        "2024-01-31 23:59:59", "2024-01-31", None, 1_706_716_799_000, 0)


def test_zone_does_not_depend_on_the_session(spark):
    df = spark.createDataFrame([(0, "1970-01-01 08:00:00")], "ms long, t string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = df.select(times.to_ymdhms("ms", "GMT+8"), times.to_ts("t", True, "GMT+8")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(got) == ("1970-01-01 08:00:00", 0)


def test_keywords(spark):
    df = spark.createDataFrame([("Big-Data, 小米 x2", 1), ("...", 2), (None, 3)], "item string, n int")
    assert rows(explode_keywords(df)) == sorted([(1, "big"), (1, "data"), (1, "小米"), (1, "x2")], key=repr)
    failing = explode_keywords(df, tokenizer=lambda t: F.lit(None).cast("array<string>"))
    assert rows(failing) == sorted([(1, "Big-Data, 小米 x2"), (2, "...")], key=repr)


def test_keyword_window(spark):
    def page(item, ts, last="search", kind="keyword"):
        return ({"item": item, "item_type": kind, "last_page_id": last}, ts)

    df = spark.createDataFrame(
        [page("a b a", 9_999), page("a", 10_000), page("a", 500, last="home"), page("a", 500, kind="id"),
         page(None, 500)], "page map<string,string>, ts long")
    got = summary.keyword_page_view_window(df)
    first, second = ("1970-01-01 00:00:00", "1970-01-01 00:00:10"), ("1970-01-01 00:00:10", "1970-01-01 00:00:20")
    assert rows(got) == sorted(
        [(*first, "search", "a", 2), (*first, "search", "b", 1), (*second, "search", "a", 1)], key=repr)


def test_traffic_window(spark):
    records = [
        {**PAGE, "ts": 1_000}, {**PAGE, "page": {"page_id": "x", "last_page_id": "home", "during_time": 5}, "ts": 9_999},
        {**PAGE, "ts": 10_000}]
    pages, _ = traffic.valid_logs(logs(spark, *records))
    got = summary.traffic_page_view_window(pages, pages.where("ts = 1000"), pages.where("ts = 10000"))
    picked = got.select("stt", *summaries.TRAFFIC_KEYS, *summaries.MEASURES)
    key = ("v", "c", "1", "1")
    assert rows(picked) == sorted(
        [("1970-01-01 00:00:00", *key, 1, 1, 2, 12, 0), ("1970-01-01 00:00:10", *key, 0, 1, 1, 7, 1)], key=repr)


def test_six_kinds_in_one_frame(spark):
    texts = [json.dumps(START), json.dumps(PAGE), "x", None, '{"ts":1}', '{"common":{"mid":"m"}}']
    lines = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, seq long")
    found = traffic.log_kinds(lines)
    split, dirty = traffic.base_log(lines)
    kept = split.unionByName(dirty.select(F.lit("dirty").alias("kind"), "value"))
    assert rows(found) == rows(kept) and found.where("kind = 'dirty'").count() == 4
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("try_parse_json") <= 2


def test_late_rows_are_taken_aside(spark):
    """Behind the watermark of the batches before, by the end of the window; a batch that runs again
    finds the same watermark."""
    late, state, kept = scratch_dir(spark, "late"), scratch_dir(spark, "marks"), []
    write = late_aside(lambda df, n: kept.append((n, rows(df.selectExpr("v")))), late, state, "et", "10 seconds", 2000)

    def batch(n, *seconds):
        made = spark.createDataFrame([(v, s) for v, s in enumerate(seconds)], "v int, s double")
        write(made.selectExpr("v", "cast(s as timestamp) AS et"), n)

    batch(0, 5.0, 21.9, None)
    assert kept[-1] == (0, [(0,), (1,), (2,)])
    batch(1, 5.0, 10.0, 12.0, 9.999, None)
    assert kept[-1] == (1, [(1,), (2,), (4,)])
    batch(2, 31.9)
    batch(2, 19.0, 12.0, 32.0)  # again, with the mark of batch 1
    assert kept[-1] == (2, [(0,), (1,), (2,)])
    batch(3, 19.0, 20.0, 30.5)
    assert kept[-1] == (3, [(2,)])
    assert rows(spark.read.parquet(late).select("batch_id", "v")) == [(1, 0), (1, 3), (3, 0), (3, 1)]
