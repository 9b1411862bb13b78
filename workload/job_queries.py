"""Fact jobs, filters, joins and dimensions over the change feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.functions.values import field
from tidemart.operators import changes, config, joins
from tidemart.plans import dim, members, trade
from tidemart.schemas import CHANGE_RECORD, CONFIG_RECORD, SENSOR_READING
from tidemart.sources import tables as sources
from workload import adapters as a
from workload.oracle import BASE, DETAIL_ID, money, stamp, txt, with_ctes
from workload.registry import query

PRE_VISIBLE = [c for c in trade.PRE_PROCESS_COLUMNS if c != "old"]


ORDER_TABLES = ("order_info", "order_detail", "order_detail_activity", "order_detail_coupon")
DIM_TABLES = ("customer", "supplier", "part", "nation", "region")

# Line ids are made of four columns and can repeat; the other columns settle ties.
LATEST_ORDER = "version order_price sku_num create_time activity_id coupon_id".split()


def _inputs(spark, d, *tables):
    return a.change_feed(spark, d, *tables), a.dictionary(spark, d)


def _pre(spark, d):
    return trade.order_pre_process(*_inputs(spark, d, *ORDER_TABLES), database=a.DATABASE)


# Filters and projections


@query(
    "cdc_filter",
    f"SELECT {txt('l_orderkey')} AS order_id, {txt('l_partkey')} AS sku_id,"
    f" {money('l_extendedprice')} AS order_price, NULL::VARCHAR AS no_such_key FROM lineitem",
)
def cdc_filter(spark, d):
    fields = ["order_id", "sku_id", "order_price", "no_such_key"]
    return changes.cdc_filter(a.change_feed(spark, d, "order_detail"), "order_detail", fields, database=a.DATABASE)


@query(
    "cdc_upserts_only",
    f"""SELECT 'customer' AS "table", 'bootstrap-insert' AS type, {txt('c_custkey')} AS id, c_mktsegment AS detail
      FROM customer
    UNION ALL SELECT 'customer', 'update', {txt('c_custkey')}, lower(c_mktsegment) FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT 'part', 'insert', {txt('p_partkey')}, p_brand FROM part""",
)
def cdc_upserts_only(spark, d):
    """Every row that stays, with a value of its own; deleted customers are among the input."""
    feed = a.change_feed(spark, d, "customer", "part").where(F.col("table").isin("customer", "part"))
    detail = F.coalesce(field("segment"), field("brand")).alias("detail")
    return changes.cdc_upserts_only(feed).select("table", "type", field("id").alias("id"), detail)


@query(
    "status_transition",
    with_ctes(
        "SELECT id, order_status, old_status FROM order_info"
        " WHERE type = 'update' AND order_status = '1005'",
        "order_info",
    ),
)
def status_transition(spark, d):
    return changes.cdc_filter(
        a.change_feed(spark, d, "order_info"),
        "order_info",
        ["id", "order_status", field("order_status", "old").alias("old_status")],
        types=None,
        where=changes.status_transition("order_status", trade.REFUNDING),
    )


@query(
    "delta_value",
    with_ctes(
        "SELECT id, CAST(first_num AS VARCHAR) AS sku_num FROM cart UNION ALL"
        " SELECT id, CAST(last_num - first_num AS VARCHAR) FROM cart WHERE last_num > first_num",
        "cart",
    ),
)
def delta_value(spark, d):
    return changes.cdc_filter(
        a.change_feed(spark, d, "cart_info"),
        "cart_info",
        ["id", changes.delta_value("sku_num").alias("sku_num")],
        types=None,
        where=changes.is_increase("sku_num"),
    )


@query(
    "config_column_filter",
    "SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS brand, 2::BIGINT AS n FROM part",
)
def config_column_filter(spark, d):
    feed = a.change_feed(spark, d, "part").where("table = 'part'")
    kept = changes.config_column_filter(F.lit("id,brand,colour"), F.col("data"))
    return feed.select(kept.alias("data")).select(
        field("id").alias("id"), field("brand").alias("brand"), F.size("data").cast("bigint").alias("n")
    )


@query(
    "rename_constant",
    f"SELECT {txt('o_orderkey')} AS order_id, 'search' AS source, {txt('o_custkey')} AS buyer FROM orders",
)
def rename_constant(spark, d):
    feed = a.change_feed(spark, d, "order_info")
    buyer = field("user_id").alias("buyer")
    source = F.lit("search").alias("source")
    return changes.cdc_filter(feed, "order_info", [field("id").alias("order_id"), source, buyer])


# Parsing of texts made from the tables


@query(
    "read_change_feed",
    with_ctes(
        f"SELECT type, id, {txt('version')} AS ts, CAST(version AS BIGINT) AS second, old_status FROM order_info",
        "order_info",
    ),
)
def read_change_feed(spark, d):
    """Inserts and updates, with what an update replaced, through their JSON text."""
    read = sources.read_change_feed(a.feed_messages(a.change_feed(spark, d, "order_info")))
    second = F.unix_seconds("et").alias("second")
    old = field("order_status", "old").alias("old_status")
    return read.where(F.col("pt").isNotNull()).select("type", field("id").alias("id"), "ts", second, old)


@query(
    "read_change_feed_open",
    f"""SELECT {txt('o_orderkey')} AS id, {txt('o_orderkey')} || '.5' AS amount, '{{"a":[1]}}' AS nested,
      CAST(o_orderkey AS BIGINT) AS second, NULL::VARCHAR AS dirty FROM orders
    UNION ALL SELECT NULL, NULL, NULL, NULL, md5(text) FROM documents""",
)
def read_change_feed_open(spark, d):
    """Numbers where texts are expected and the other way round, and nested values, come through; what
    is no change record is an output of its own."""
    key = F.col("o_orderkey")
    nested = F.struct(F.array(F.lit(1)).alias("a"))
    data = F.struct(key.alias("id"), (key + 0.5).alias("amount"), nested.alias("nested"))
    # Odd orders have a fraction of a second, even ones a text.
    ts = F.when(key % 2 == 0, F.concat(F.lit('"'), a.text_of(key), F.lit('"'))).otherwise(a.text_of(key))
    text = F.concat(F.lit('{"table":"t","type":"insert","ts":'), ts, F.lit(',"data":'), F.to_json(data), F.lit("}"))
    good = a.table(spark, d, "orders").select(text.alias("value"))
    bad = a.table(spark, d, "documents").select(F.col("text").alias("value"))
    texts = good.unionByName(bad)
    read = sources.read_change_feed(texts).select(
        field("id").alias("id"),
        field("amount").alias("amount"),
        field("nested").alias("nested"),
        F.unix_seconds("et").alias("second"),
        F.lit(None).cast("string").alias("dirty"),
    )
    dirty = sources.dirty_messages(texts, CHANGE_RECORD).select(F.md5("value").alias("dirty"))
    return read.unionByName(dirty, allowMissingColumns=True)


@query(
    "read_json_table",
    with_ctes("SELECT mid, page_id, ts FROM page", "page"),
)
def read_json_table(spark, d):
    texts = a.page_log(spark, d).select(F.to_json(F.struct("common", "page", "ts")).alias("value"))
    schema = "common struct<mid:string>, page struct<page_id:string>, ts bigint"
    read = sources.read_json_table(texts, spark.createDataFrame([], schema).schema)
    return read.select("common.mid", "page.page_id", "ts")


@query(
    "read_csv_lines",
    "SELECT CAST(user_id AS VARCHAR) AS id, value AS vc, epoch_us(ts) // 1000000 AS ts FROM events",
)
def read_csv_lines(spark, d):
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    lines = a.table(spark, d, "events").select(
        F.concat_ws(",", "user_id", "value", second).alias("value")
    )
    return sources.read_csv_lines(lines, SENSOR_READING)


def _rules(spark):
    return sources.read_config_cdc(a.rule_messages(spark))


_CUSTOMER_DIM = f"""SELECT 'customer' AS source_table, 'dim_customer' AS sink_table, 'id' AS sink_pk,
      {txt('c_custkey')} AS pk, c_name AS name, c_mktsegment AS segment, 4::BIGINT AS n FROM customer
    UNION ALL SELECT 'customer', 'dim_customer', 'id', {txt('c_custkey')}, c_name,
      lower(c_mktsegment), 4 FROM customer WHERE c_acctbal < 0"""
_OTHER_DIMS = f"""
    UNION ALL SELECT 'supplier', 'dim_supplier', 'id', {txt('s_suppkey')}, s_name, NULL, 3 FROM supplier
    UNION ALL SELECT 'part', 'dim_part', 'id', {txt('p_partkey')}, p_name, NULL, 3 FROM part
    UNION ALL SELECT 'nation', 'dim_nation', 'n_id', {txt('n_nationkey')}, NULL, NULL, 2 FROM nation"""


def _routed(rows):
    return rows.select(
        F.col("table").alias("source_table"),
        "sink_table",
        "sink_pk",
        F.col("data")[F.col("sink_pk")].alias("pk"),
        field("name").alias("name"),
        field("segment").alias("segment"),
        F.size("data").cast("bigint").alias("n"),
    )


@query("config_broadcast_join", _CUSTOMER_DIM + _OTHER_DIMS)
def config_broadcast_join(spark, d):
    feed = changes.cdc_upserts_only(a.change_feed(spark, d, *DIM_TABLES))
    return _routed(config.config_broadcast_join(feed, config.latest_config(_rules(spark))))


@query("dim_app", _CUSTOMER_DIM + _OTHER_DIMS)
def dim_app(spark, d):
    return _routed(dim.dim_app(a.change_feed(spark, d, *DIM_TABLES), _rules(spark)))


_SEGMENT_RULE = """SELECT c_mktsegment AS source_table, max(c_custkey) AS last_key,
    'dim_' || max_by(c_nationkey, c_custkey) AS sink_table FROM customer GROUP BY 1"""


@query("latest_config", _SEGMENT_RULE)
def latest_config(spark, d):
    """Rules made of customers: one source per segment, the newest rule is that of the last key."""
    records = a.table(spark, d, "customer").select(
        F.struct(
            F.col("c_mktsegment").alias("source_table"),
            F.concat(F.lit("dim_"), F.col("c_nationkey").cast("string")).alias("sink_table"),
            F.col("c_custkey").cast("string").alias("sink_columns"),
        ).alias("after"),
        F.lit("c").alias("op"),
        F.col("c_custkey").alias("ts_ms"),
    )
    texts = records.select(F.to_json(F.struct("after", "op", "ts_ms")).alias("value"))
    rules = config.latest_config(sources.read_config_cdc(texts))
    last = F.col("sink_columns").cast("bigint").alias("last_key")
    return rules.select("source_table", last, "sink_table")


@query(
    "read_config_cdc",
    "SELECT 'dim_' || r_name AS sink_table, 'u' AS op, CAST(r_regionkey AS BIGINT) AS ts_ms FROM region",
)
def read_config_cdc(spark, d):
    sink = F.concat(F.lit("dim_"), F.col("r_name")).alias("sink_table")
    texts = a.table(spark, d, "region").select(
        F.to_json(
            F.struct(
                F.struct(F.col("r_name").alias("source_table"), sink).alias("after"),
                F.lit("u").alias("op"),
                F.col("r_regionkey").alias("ts_ms"),
            )
        ).alias("value")
    )
    read = sources.read_config_cdc(texts)
    assert read.schema.names == CONFIG_RECORD.names
    return read.select("after.sink_table", "op", "ts_ms")


# Joins


def _details(feed):
    return changes.cdc_filter(feed, "order_detail", ["id", "order_id", "sku_id"])


def _orders(feed, types=("insert", "update")):
    return changes.cdc_filter(
        feed, "order_info", [field("id").alias("oi_id"), "order_status"], types=types
    )


@query(
    "inner_stream_join",
    with_ctes(
        "SELECT d.id, d.sku_id, o.order_status FROM detail d JOIN order_info o ON d.order_id = o.id",
        "detail",
        "order_info",
    ),
)
def inner_stream_join(spark, d):
    feed = a.change_feed(spark, d, "order_info", "order_detail")
    joined = joins.inner_stream_join(_details(feed), _orders(feed), [("order_id", "oi_id")])
    return joined.select("id", "sku_id", "order_status")


@query(
    "left_stream_join",
    with_ctes(
        "SELECT d.id, x.activity_id, c.coupon_id FROM detail d"
        " LEFT JOIN activity x ON d.id = x.order_detail_id"
        " LEFT JOIN coupon c ON d.id = c.order_detail_id",
        "detail",
        "activity",
        "coupon",
    ),
)
def left_stream_join(spark, d):
    feed = a.change_feed(spark, d, "order_detail", "order_detail_activity", "order_detail_coupon")
    link = field("order_detail_id")
    activity = changes.cdc_filter(feed, "order_detail_activity", [link.alias("oa_id"), "activity_id"])
    coupon = changes.cdc_filter(feed, "order_detail_coupon", [link.alias("oc_id"), "coupon_id"])
    joined = joins.left_stream_join(_details(feed), activity, [("id", "oa_id")])
    joined = joins.left_stream_join(joined, coupon, [("id", "oc_id")])
    return joined.select("id", "activity_id", "coupon_id")


@query(
    "right_stream_join",
    f"SELECT CASE WHEN l_orderkey IS NOT NULL THEN {DETAIL_ID} END AS id, {txt('o_orderkey')} AS oi_id"
    " FROM lineitem RIGHT JOIN orders ON l_orderkey = o_orderkey",
)
def right_stream_join(spark, d):
    feed = a.change_feed(spark, d, "order_info", "order_detail")
    orders = _orders(feed, ("insert",))
    joined = joins.right_stream_join(_details(feed), orders, [("order_id", "oi_id")])
    return joined.select("id", "oi_id")


@query(
    "full_stream_join",
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(p_partkey AS VARCHAR) AS part_id
    FROM orders FULL JOIN part ON o_custkey = p_partkey""",
)
def full_stream_join(spark, d):
    feed = a.change_feed(spark, d, "order_info", "part")
    buyers = changes.cdc_filter(feed, "order_info", [field("id").alias("order_id"), "user_id"])
    parts = changes.cdc_filter(feed, "part", [field("id").alias("part_id")])
    joined = joins.full_stream_join(buyers, parts, [("user_id", "part_id")])
    return joined.select("order_id", "part_id")


def _interval_sql(seconds: int) -> str:
    return with_ctes(
        f"""SELECT l.id, l.l_seq, r.name FROM reading l JOIN name r ON l.id = r.id
        AND r.r_et BETWEEN l.l_et - INTERVAL {seconds} SECOND AND l.l_et + INTERVAL {seconds} SECOND""",
        "reading",
        "name",
    )


def _interval(spark, d, seconds):
    left, right = a.sensors(spark, d)
    pairs = joins.interval_join(left, right, "id", ("l_et", "r_et"), -seconds * 1000, seconds * 1000)
    return pairs.select("id", "l_seq", "name")


@query("interval_join", _interval_sql(5))
def interval_join(spark, d):
    return _interval(spark, d, 5)


@query("interval_join_hours", _interval_sql(4 * 3600))
def interval_join_hours(spark, d):
    return _interval(spark, d, 4 * 3600)


@query(
    "lookup_join",
    with_ctes(
        "SELECT conv_id || '-' || turn AS id, role AS appraise, dic_name AS appraise_name"
        " FROM conversations JOIN dic ON role = dic_code",
        "dic",
    ),
)
def lookup_join(spark, d):
    feed, dic = _inputs(spark, d, "comment_info")
    rows = changes.cdc_filter(feed, "comment_info", ["id", "appraise"])
    return joins.lookup_join(rows, joins.lookup_entries(dic), "appraise", "appraise_name")


@query(
    "double_lookup",
    with_ctes(
        "SELECT r.id, t.dic_name AS refund_type_name, w.dic_name AS refund_reason_type_name FROM refund r"
        " JOIN dic t ON refund_type = t.dic_code JOIN dic w ON reason_type = w.dic_code",
        "dic",
        "refund",
    ),
)
def double_lookup(spark, d):
    feed, dic = _inputs(spark, d, "order_refund_info")
    rows = changes.cdc_filter(feed, "order_refund_info", ["id", "refund_type", "refund_reason_type"])
    names = joins.lookup_entries(dic)
    rows = joins.lookup_join(rows, names, "refund_type", "refund_type_name")
    rows = joins.lookup_join(rows, names, "refund_reason_type", "refund_reason_type_name")
    return rows.select("id", "refund_type_name", "refund_reason_type_name")


@query(
    "composite_key_join",
    with_ctes(
        "SELECT p.id, r.id AS ri_id, r.refund_num FROM refund p JOIN refund r"
        " ON p.order_id = r.order_id AND p.sku_id = r.sku_id",
        "refund",
    ),
)
def composite_key_join(spark, d):
    feed = a.change_feed(spark, d, "order_refund_info", "refund_payment")
    paid = changes.cdc_filter(feed, "refund_payment", ["id", "order_id", "sku_id"])
    asked = changes.cdc_filter(
        feed,
        "order_refund_info",
        [field(k).alias(f"ri_{k}") for k in ("id", "order_id", "sku_id")] + ["refund_num"],
    )
    keys = [("order_id", "ri_order_id"), ("sku_id", "ri_sku_id")]
    return joins.inner_stream_join(paid, asked, keys).select("id", "ri_id", "refund_num")


# Jobs


@query(
    "order_pre_process",
    with_ctes(f"SELECT {', '.join(PRE_VISIBLE)}, old_status, version FROM pre", "pre"),
)
def order_pre_process(spark, d):
    old = field("order_status", "old").alias("old_status")
    return _pre(spark, d).select(*PRE_VISIBLE, old, "version")


@query(
    "order_pre_process_latest",
    with_ctes(
        f"""SELECT {', '.join(PRE_VISIBLE)} FROM (SELECT *, row_number() OVER (
        PARTITION BY id ORDER BY {', '.join(f'{c} DESC NULLS LAST' for c in LATEST_ORDER)}) AS rn
        FROM pre) WHERE rn = 1""",
        "pre",
    ),
)
def order_pre_process_latest(spark, d):
    return changes.latest_by_key(_pre(spark, d), ["id"], LATEST_ORDER).select(*PRE_VISIBLE)


@query(
    "order_detail",
    with_ctes(
        f"SELECT {', '.join(trade.ORDER_DETAIL_COLUMNS)} FROM pre WHERE type = 'insert'", "pre"
    ),
)
def order_detail(spark, d):
    return trade.order_detail(_pre(spark, d)).drop("et")


@query(
    "cancel_detail",
    with_ctes(
        "SELECT "
        + ", ".join(c.replace("cancel_time", "operate_time AS cancel_time") for c in trade.CANCEL_COLUMNS)
        + " FROM pre WHERE type = 'update' AND old_status IS NOT NULL AND order_status = '1003'",
        "pre",
    ),
)
def cancel_detail(spark, d):
    return trade.cancel_detail(_pre(spark, d))


_PAY_SOURCE = {
    "order_detail_id": "pre.id AS order_detail_id",
    "order_id": "pre.order_id",
    "payment_type_code": "p.payment_type AS payment_type_code",
    "payment_type_name": "t.dic_name AS payment_type_name",
    "callback_time": "p.callback_time",
    "split_payment_amount": "split_total_amount AS split_payment_amount",
}


@query(
    "pay_detail_suc",
    with_ctes(
        "SELECT "
        + ", ".join(_PAY_SOURCE.get(c, c) for c in trade.PAY_COLUMNS)
        + " FROM payment p JOIN pre ON p.order_id = pre.order_id AND pre.type = 'insert'"
        " JOIN dic t ON p.payment_type = t.dic_code",
        "pre",
        "payment",
    ),
)
def pay_detail_suc(spark, d):
    feed, dic = _inputs(spark, d, *ORDER_TABLES, "payment_info")
    details = trade.order_detail(trade.order_pre_process(feed, dic))
    return trade.pay_detail_suc(feed, details, dic)


@query(
    "cart_add",
    with_ctes(
        """SELECT id, user_id, sku_id, cart_price, sku_num, NULL::VARCHAR AS img_url, sku_name,
        '1' AS is_checked, create_time, NULL::VARCHAR AS operate_time, NULL::VARCHAR AS is_ordered,
        NULL::VARCHAR AS order_time, source_type AS source_type_id,
        dic_name AS source_type_name, source_id
        FROM (SELECT *, CAST(first_num AS VARCHAR) AS sku_num FROM cart UNION ALL
              SELECT *, CAST(last_num - first_num AS VARCHAR) FROM cart WHERE last_num > first_num)
        JOIN dic ON source_type = dic_code""",
        "dic",
        "cart",
    ),
)
def cart_add(spark, d):
    return trade.cart_add(*_inputs(spark, d, "cart_info"), database=a.DATABASE)


@query(
    "order_refund",
    with_ctes(
        f"""SELECT r.id, r.user_id, r.order_id, r.sku_id,
        CAST(o.o_custkey % 34 AS VARCHAR) AS province_id, substr(create_time, 1, 10) AS date_id,
        create_time, refund_type AS refund_type_code, t.dic_name AS refund_type_name,
        reason_type AS refund_reason_type_code, w.dic_name AS refund_reason_type_name,
        reason_txt AS refund_reason_txt, refund_num, amount AS refund_amount,
        CAST(r.l_orderkey + {BASE + 700} AS VARCHAR) AS ts
        FROM refund r JOIN order_info o ON r.order_id = o.id AND o.order_status = '1005'
        JOIN dic t ON refund_type = t.dic_code JOIN dic w ON reason_type = w.dic_code""",
        "refund",
        "order_info",
        "dic",
    ),
)
def order_refund(spark, d):
    return trade.order_refund(*_inputs(spark, d, "order_refund_info", "order_info")).drop("row_op_ts")


@query(
    "row_operation_time",
    with_ctes(
        """SELECT r.id, r.sku_id, true AS stamped FROM refund r
        JOIN order_info o ON r.order_id = o.id AND o.order_status = '1005'
        JOIN dic t ON refund_type = t.dic_code JOIN dic w ON reason_type = w.dic_code""",
        "refund",
        "order_info",
        "dic",
    ),
)
def row_operation_time(spark, d):
    """``row_op_ts`` of refunds is the time of the run."""
    rows = trade.order_refund(*_inputs(spark, d, "order_refund_info", "order_info"))
    now = F.current_timestamp()
    stamped = F.col("row_op_ts").between(now - F.expr("INTERVAL 1 HOUR"), now)
    return rows.select("id", "sku_id", stamped.alias("stamped"))


@query(
    "refund_pay_suc",
    with_ctes(
        f"""SELECT p.id, CAST(o.o_custkey AS VARCHAR) AS user_id, p.order_id, p.sku_id,
        CAST(o.o_custkey % 34 AS VARCHAR) AS province_id, p.refund_type AS payment_type_code,
        t.dic_name AS payment_type_name, substr(p.callback_time, 1, 10) AS date_id,
        p.callback_time, r.refund_num, p.amount AS refund_amount,
        CAST(p.l_orderkey + {BASE + 1300} AS VARCHAR) AS ts
        FROM refund p JOIN order_info o ON p.order_id = o.id AND o.order_status = '1006'
        JOIN refund r ON p.order_id = r.order_id AND p.sku_id = r.sku_id
        JOIN dic t ON p.refund_type = t.dic_code""",
        "refund",
        "order_info",
        "dic",
    ),
)
def refund_pay_suc(spark, d):
    return trade.refund_pay_suc(*_inputs(spark, d, "order_refund_info", "refund_payment", "order_info")).drop("row_op_ts")


_COUPON = f"""SELECT {txt('o_orderkey')} AS id, {txt('o_custkey % 10')} AS coupon_id,
    {txt('o_custkey')} AS user_id"""
_COUPON_ORDER = f", {txt('o_orderkey')} AS order_id"


def _dated(time: str, name: str, offset: int, key: str = "o_orderkey") -> str:
    return f", substr({time}, 1, 10) AS date_id, {time} AS {name}, {txt(f'{key} + {BASE + offset}')} AS ts"


@query("coupon_get", _COUPON + _dated(stamp("o_orderdate"), "get_time", 0) + " FROM orders")
def coupon_get(spark, d):
    return members.coupon_get(a.change_feed(spark, d, "coupon_use"))


@query(
    "coupon_order",
    _COUPON + _COUPON_ORDER + _dated(stamp("o_orderdate", "1 HOUR"), "order_time", 10) + " FROM orders",
)
def coupon_order(spark, d):
    return members.coupon_order(a.change_feed(spark, d, "coupon_use"))


@query(
    "coupon_pay",
    _COUPON
    + _COUPON_ORDER
    + _dated(stamp("o_orderdate", "2 HOUR"), "payment_time", 20)
    + " FROM orders WHERE o_orderstatus = 'O'",
)
def coupon_pay(spark, d):
    return members.coupon_pay(a.change_feed(spark, d, "coupon_use"))


@query(
    "favor_add",
    f"SELECT {txt('event_id')} AS id, {txt('user_id')} AS user_id, {txt('event_id % 100')} AS sku_id"
    + _dated(stamp("ts"), "create_time", 0, "event_id")
    + " FROM events WHERE event_type = 'view' OR (event_type = 'click' AND event_id % 2 = 0)",
)
def favor_add(spark, d):
    return members.favor_add(a.change_feed(spark, d, "favor_info"))


@query(
    "comment",
    with_ctes(
        f"SELECT conv_id || '-' || turn AS id, {txt('conv_id')} AS user_id, {txt('turn')} AS sku_id,"
        f" {txt('conv_id')} AS order_id, role AS appraise_code, dic_name AS appraise_name"
        + _dated(stamp(f"make_timestamp((conv_id + {BASE}) * 1000000)"), "create_time", 0, "conv_id")
        + " FROM conversations JOIN dic ON role = dic_code",
        "dic",
    ),
)
def comment(spark, d):
    return members.comment(*_inputs(spark, d, "comment_info"))


@query(
    "user_register",
    f"SELECT {txt('user_id')} AS user_id"
    + _dated(stamp("ts"), "create_time", 0, "event_id")
    + " FROM events WHERE event_type = 'signup'",
)
def user_register(spark, d):
    return members.user_register(a.change_feed(spark, d, "user_info"))
