import json

from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.values import field
from tidemart.operators import changes
from tidemart.plans import members, trade
from tidemart.schemas import APP_LOG, CHANGE_RECORD, DICTIONARY
from tidemart.session import scratch_dir
from tidemart.sinks.writers import read_upsert, write_upsert
from tidemart.sources.tables import read_change_feed, read_stream_raw, with_times
from tidemart.streaming.runner import run_batches

# Made-up records around the documented change types.
RECORDS = [
    {"database": "m", "table": "warehouse", "type": "bootstrap-start", "ts": 20, "data": {}},
    {"database": "m", "table": "warehouse", "type": "bootstrap-insert", "ts": 21,
     "data": {"code": "north", "shelves": 40}},
    {"database": "m", "table": "warehouse", "type": "bootstrap-complete", "ts": 22, "data": {}},
    {"database": "m", "table": "warehouse", "type": "insert", "ts": 23,
     "data": {"code": "south", "shelves": 8}},
    {"database": "m", "table": "warehouse", "type": "update", "ts": 24,
     "data": {"code": "south", "shelves": 9}, "old": {"shelves": 8}},
    {"database": "m", "table": "warehouse", "type": "delete", "ts": 25, "data": {"code": "south"}},
]
DIRTY = ["not json", "", None, '{"database": "m", "ty', "[1]", "7"]


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def feed(spark, *records):
    return read_change_feed(lines(spark, [json.dumps(r) for r in records]))


def change(table, kind, data, old=None, ts=100):
    return {"database": "m", "table": table, "type": kind, "ts": str(ts), "data": data, "old": old}


def dictionary(spark, *codes):
    return spark.createDataFrame([(c, f"name {c}", "0", None, None) for c in codes], DICTIONARY)


def test_split_valid_json(spark):
    texts = [json.dumps(r) for r in RECORDS] + DIRTY
    valid, dirty = changes.split_valid_json(lines(spark, texts), CHANGE_RECORD)
    assert valid.count() == len(RECORDS)
    assert sorted(map(str, (r[0] for r in dirty.collect()))) == sorted(map(str, DIRTY))


def test_values_of_other_types_are_kept(spark):
    schema = T.StructType.fromDDL(
        "n bigint, t string, f double, m map<string,string>, s struct<a:int,b:string>, l array<int>")
    texts = [
        '{"n": 1.5, "t": 7, "f": "2.5", "m": {"x": 1, "y": {"z": [1]}, "w": null}, "s": {"a": "3", "b": true}, "l": [1, "2", "x"]}',
        '{"n": "12", "t": {"a": 1}, "f": 1, "m": "no map", "s": 5, "l": {}}',
        '{"n": "x"}', "{}", '{"n": 1, "n": 2}', "[]", '{"n": 1']
    valid, dirty = changes.split_valid_json(lines(spark, texts), schema)
    assert [r.asDict(True) for r in valid.collect()] == [
        {"n": 1, "t": "7", "f": 2.5, "m": {"x": "1", "y": '{"z":[1]}', "w": None}, "s": {"a": 3, "b": "true"},
         "l": [1, 2, None]},
        {"n": 12, "t": '{"a":1}', "f": 1.0, "m": None, "s": None, "l": None},
        *[dict.fromkeys(schema.names)] * 2]
    assert [r[0] for r in dirty.collect()] == texts[4:]


def test_messages_keep_their_position(spark):
    """Two changes of one second: the later row of the file wins, whatever its value."""
    source, path, state = (scratch_dir(spark, n) for n in ("in", "out", "state"))
    texts = [json.dumps(change("t", "update", {"id": "1", "v": v})) for v in "cab"]
    lines(spark, texts).coalesce(1).write.parquet(source)
    read = read_stream_raw(spark, "parquet", schema="value string", path=source, positions=True)
    facts = changes.cdc_filter(read_change_feed(read), "t", ["id", "v"], types=None, keep=["ts", "position"])
    run_batches(facts, write_upsert(path, ["id"], ["ts"]), state)
    assert rows(read_upsert(spark, path, ["id"]).select("id", "v")) == [("1", "b")]


def test_log_without_common_is_dirty(spark):
    texts = ['{"common": {"mid": "a"}, "ts": 1}', '{"ts": 1}', '{"common": {}, "ts": 1}']
    valid, dirty = changes.split_valid_json(
        lines(spark, texts), APP_LOG, required=("common.mid", "ts")
    )
    assert valid.count() == 1 and dirty.count() == 2


def test_feed_types_and_missing_keys(spark):
    df = feed(spark, *RECORDS)
    assert df.where("pt is null or et is null").count() == 0
    kept = changes.cdc_upserts_only(df).select("type", field("no_such").alias("x"))
    assert rows(kept) == [("bootstrap-insert", None), ("insert", None), ("update", None)]


def test_status_transition(spark):
    df = feed(
        spark,
        change("t", "update", {"s": "2"}, {"s": "1"}),
        change("t", "update", {"s": "2"}, {"s": "9"}),
        change("t", "update", {"s": "2"}, {"x": "1"}),
        change("t", "update", {"s": "2"}),
        change("t", "insert", {"s": "2"}, {"s": "1"}),
        change("t", "update", {"s": "3"}, {"s": "1"}),
    )
    assert df.where(changes.status_transition("s", "2")).count() == 2
    assert df.where(changes.status_transition("s", "2", "1")).count() == 1


def test_cart_add(spark):
    row = {"id": "1", "source_type": "a"}
    df = feed(
        spark,
        change("cart_info", "insert", {**row, "sku_num": "5"}),
        change("cart_info", "update", {**row, "sku_num": "9"}, {"sku_num": "5"}),
        change("cart_info", "update", {**row, "sku_num": "2"}, {"sku_num": "5"}),
        change("cart_info", "update", {**row, "sku_num": "2"}, {"is_checked": "1"}),
        change("cart_info", "update", {**row, "sku_num": "many"}, {"sku_num": "5"}),
        change("cart_info", "insert", {**row, "sku_num": "1", "source_type": "unknown"}),
        change("cart_info", "delete", {**row, "sku_num": "1"}),
    )
    out = trade.cart_add(df, dictionary(spark, "a"))
    assert out.columns == trade.CART_COLUMNS
    assert rows(out.select("sku_num", "source_type_name")) == [("4", "name a"), ("5", "name a")]
    assert trade.cart_add(df, dictionary(spark, "a"), database="other").count() == 0


def test_config_column_filter(spark):
    df = spark.createDataFrame([({"id": "1", "a": "2", "b": "3"}, "id,b")], "data map<string,string>, c string")
    kept = df.select(changes.config_column_filter(F.col("c"), F.col("data")))
    assert kept.first()[0] == {"id": "1", "b": "3"}


def test_latest_by_key_cuts_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as v")
    latest = changes.latest_by_key(df, ["k"], ["v"])
    assert rows(latest) == [(0, 999), (1, 997), (2, 998)]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_order_jobs(spark):
    order = {"id": "o1", "user_id": "u1", "province_id": "7", "refundable_time": "later"}
    df = feed(
        spark,
        change("order_detail", "insert", {"id": "d1", "order_id": "o1", "source_type": "a"}),
        change("order_detail", "insert", {"id": "d2", "order_id": "o1", "source_type": "a"}),
        change("order_detail", "insert", {"id": "d3", "order_id": "none", "source_type": "a"}),
        change("order_info", "insert", {**order, "order_status": "1001"}),
        change("order_info", "update", {**order, "order_status": "1003", "operate_time": "t"},
               {"order_status": "1001"}, 160),
        change("order_info", "update", {**order, "order_status": "1003"}, {"x": "y"}, 170),
        change("order_detail_activity", "insert", {"id": "x1", "order_detail_id": "d1", "activity_id": "5"}),
        change("order_detail_coupon", "insert", {"id": "y2", "order_detail_id": "d2", "coupon_id": "6"}),
        change("payment_info", "update",
               {"order_id": "o1", "payment_type": "a", "payment_status": "1602"}),
        change("payment_info", "update",
               {"order_id": "o1", "payment_type": "a", "payment_status": "1601"}),
    )
    dic = dictionary(spark, "a")
    pre = trade.order_pre_process(df, dic)
    assert pre.columns == [*trade.PRE_PROCESS_COLUMNS, "version", "et"]
    assert len(trade.PRE_PROCESS_COLUMNS) == 43
    assert pre.count() == 6
    assert pre.where("refundable_time = 'later'").count() == 6
    details = trade.order_detail(pre)
    assert rows(details.select("id", "activity_id", "coupon_id")) == [
        ("d1", "5", None), ("d2", None, "6")]
    assert rows(trade.cancel_detail(pre).select("id", "cancel_time")) == [("d1", "t"), ("d2", "t")]
    paid = trade.pay_detail_suc(df, details, dic)
    assert rows(paid.select("order_detail_id", "payment_type_name")) == [
        ("d1", "name a"), ("d2", "name a")]


def test_refund_jobs(spark):
    df = feed(
        spark,
        change("order_refund_info", "insert", {
            "id": "r1", "order_id": "o1", "sku_id": "s1", "refund_type": "a", "refund_num": "2",
            "refund_reason_type": "b", "create_time": "2024-01-02 03:04:05"}),
        change("order_info", "update", {"id": "o1", "order_status": "1005", "province_id": "7"},
               {"order_status": "1002"}),
        change("order_info", "update", {"id": "o1", "order_status": "1006", "user_id": "u"},
               {"order_status": "1005"}),
        change("refund_payment", "insert", {
            "id": "p1", "order_id": "o1", "sku_id": "s1", "payment_type": "a", "total_amount": "3.10",
            "callback_time": "not a time"}),
        change("refund_payment", "insert", {
            "id": "p2", "order_id": "o1", "sku_id": "other", "payment_type": "a"}),
    )
    dic = dictionary(spark, "a", "b")
    refund = trade.order_refund(df, dic)
    assert refund.columns == trade.REFUND_COLUMNS
    picked = refund.select("id", "province_id", "date_id", "refund_type_name", "refund_reason_type_name")
    assert rows(picked) == [("r1", "7", "2024-01-02", "name a", "name b")]
    paid = trade.refund_pay_suc(df, dic)
    assert paid.columns == trade.REFUND_PAY_COLUMNS
    assert rows(paid.select("id", "user_id", "date_id", "refund_num", "refund_amount")) == [
        ("p1", "u", None, "2", "3.10")]
    assert trade.refund_pay_suc(df, dic, strict=True).count() == 0


def test_member_jobs(spark):
    day = "2024-01-02 00:00:01"
    coupon = {"id": "1", "coupon_id": "2", "user_id": "3", "order_id": "4"}
    df = feed(
        spark,
        change("coupon_use", "insert", {**coupon, "get_time": day}),
        change("coupon_use", "update", {**coupon, "using_time": day, "coupon_status": "1402"},
               {"coupon_status": "1401"}),
        change("coupon_use", "update", {**coupon, "used_time": day, "coupon_status": "1403"},
               {"coupon_status": "1402"}),
        change("favor_info", "insert", {"id": "1", "create_time": day}),
        change("favor_info", "update", {"id": "2", "is_cancel": "0", "create_time": day}),
        change("favor_info", "update", {"id": "3", "is_cancel": "1", "create_time": day}),
        change("comment_info", "insert", {"id": "1", "appraise": "a", "create_time": day}),
        change("comment_info", "insert", {"id": "2", "appraise": "none", "create_time": day}),
        change("user_info", "insert", {"id": "9", "create_time": day}),
        change("user_info", "update", {"id": "9", "create_time": day}),
    )
    assert rows(members.coupon_get(df)) == [("1", "2", "3", "2024-01-02", day, "100")]
    assert rows(members.coupon_order(df)) == [("1", "2", "3", "4", "2024-01-02", day, "100")]
    assert rows(members.coupon_pay(df)) == [("1", "2", "3", "4", "2024-01-02", day, "100")]
    assert rows(members.favor_add(df).select("id", "date_id")) == [("1", "2024-01-02"), ("2", "2024-01-02")]
    comments = members.comment(df, dictionary(spark, "a"))
    assert rows(comments.select("id", "appraise_name", "date_id")) == [("1", "name a", "2024-01-02")]
    assert rows(members.user_register(df)) == [("9", "2024-01-02", day, "100")]


def test_late_values_do_not_fail_the_feed(spark):
    df = with_times(spark.createDataFrame([("m", "t", "insert", "soon", {}, None)], CHANGE_RECORD))
    assert df.select("et").first()[0] is None
