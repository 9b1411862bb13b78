"""Change feed, app log, dictionary and rules derived from the driver's tables.

``workload.oracle`` states the same derivations in SQL.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.times import DATE_TIME
from tidemart.schemas import STRING_MAP
from tidemart.session import configure, is_local, scratch_dir
from tidemart.sources.tables import read_lookup, with_times

BASE_SECONDS = 1_704_067_200  # 2024-01-01 UTC
DATABASE = "mart"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def few_stores(spark: SparkSession):
    """For streams that start within: on one machine a state store for each of 200 partitions takes minutes.

    Jobs on tables keep the session's partitions, or what one task reads would grow to a core's share of
    the whole table.
    """
    partitions = "spark.sql.shuffle.partitions"
    before = spark.conf.get(partitions)
    if is_local(spark) and before == "200":
        spark.conf.set(partitions, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(partitions, before)


def text_of(c: Column) -> Column:
    return c.cast("string")


def money(name: str) -> Column:
    return text_of(F.col(name).cast("decimal(18,2)"))


def whole(c: Column) -> Column:
    return text_of(F.round(c).cast("bigint"))


def stamp(name: str, add: str | None = None) -> Column:
    moment = F.col(name) if add is None else F.col(name) + F.expr(f"INTERVAL {add}")
    return F.date_format(moment, DATE_TIME)


def _map(values: dict[str, Column] | None) -> Column:
    if not values:
        return F.lit(None).cast(STRING_MAP)
    return F.create_map(*[part for k, v in values.items() for part in (F.lit(k), text_of(v))])


def changes(
    df: DataFrame,
    name: str,
    kind: str | Column,
    ts: Column,
    data: dict[str, Column],
    old: dict[str, Column] | Column | None = None,
) -> DataFrame:
    """Rows of a table as change records; ``ts`` is in seconds, as text."""
    return df.select(
        F.lit(DATABASE).alias("database"),
        F.lit(name).alias("table"),
        (kind if isinstance(kind, Column) else F.lit(kind)).alias("type"),
        text_of(ts).alias("ts"),
        _map(data).alias("data"),
        (old if isinstance(old, Column) else _map(old)).alias("old"),
    )


def at(key: str, offset: int = 0) -> Column:
    """Commit second of the transaction about order ``key``."""
    return F.col(key).cast("bigint") + F.lit(BASE_SECONDS + offset)


# Changes of an order by its final state: (type, new state, state before, seconds later).
ORDER_STEPS = {
    "O": [("update", "1002", "1001", 600)],
    "F": [("update", "1003", "1001", 600)],
    "P": [("update", "1005", "1001", 600), ("update", "1006", "1005", 1200)],
}


def order_info(orders: DataFrame) -> list[DataFrame]:
    """Each order is inserted, then moves on by its state. One scan gives all its changes."""

    def step(kind, new, before, later) -> Column:
        values = {"kind": kind, "new": new, "before": before, "later": later}
        return F.struct(*[F.lit(v).alias(k) for k, v in values.items()])

    inserted = ("insert", "1001", "", 0)
    steps = F.array(step(*inserted))
    for status, more in ORDER_STEPS.items():
        all_steps = F.array(*[step(*x) for x in (inserted, *more)])
        steps = F.when(F.col("o_orderstatus") == status, all_steps).otherwise(steps)
    moved = orders.select("*", F.explode(steps).alias("step")).select("*", "step.*")
    is_update = F.col("kind") == "update"
    row = {
        "id": F.col("o_orderkey"),
        "consignee": F.concat(F.lit("Customer "), text_of(F.col("o_custkey"))),
        "total_amount": money("o_totalprice"),
        "user_id": F.col("o_custkey"),
        "payment_way": F.col("o_orderpriority"),
        "create_time": stamp("o_orderdate"),
        "province_id": F.col("o_custkey") % 34,
        "order_status": F.col("new"),
        "operate_time": F.when(is_update, stamp("o_orderdate", "1 DAY")),
    }
    old = F.when(is_update, _map({"order_status": F.col("before")}))
    second = at("o_orderkey") + F.col("later")
    return [changes(moved, "order_info", F.col("kind"), second, row, old)]


def detail_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def order_lines(lineitem: DataFrame) -> list[DataFrame]:
    percent_off, tax = F.col("l_discount") * 100, F.col("l_tax") * 100
    link = {
        "id": F.concat(F.lit("x"), detail_id()),
        "order_id": F.col("l_orderkey"),
        "order_detail_id": detail_id(),
        "sku_id": F.col("l_partkey"),
        "create_time": stamp("l_shipdate"),
    }
    return [
        changes(
            lineitem,
            "order_detail",
            "insert",
            at("l_orderkey"),
            {
                "id": detail_id(),
                "order_id": F.col("l_orderkey"),
                "sku_id": F.col("l_partkey"),
                "sku_name": F.concat(F.lit("part "), text_of(F.col("l_partkey"))),
                "order_price": money("l_extendedprice"),
                "sku_num": whole(F.col("l_quantity")),
                "create_time": stamp("l_shipdate"),
                "source_type": F.col("l_returnflag"),
                "source_id": F.col("l_suppkey"),
                "split_total_amount": money("l_extendedprice"),
                "split_activity_amount": whole(percent_off),
                "split_coupon_amount": whole(tax),
            },
        ),
        changes(
            lineitem.where("l_discount > 0"),
            "order_detail_activity",
            "insert",
            at("l_orderkey"),
            {**link, "activity_id": whole(percent_off), "activity_rule_id": F.col("l_linenumber")},
        ),
        changes(
            lineitem.where("l_tax > 0"),
            "order_detail_coupon",
            "insert",
            at("l_orderkey"),
            {**link, "coupon_id": whole(tax), "coupon_use_id": F.col("l_suppkey")},
        ),
    ]


def payments(orders: DataFrame) -> list[DataFrame]:
    row = {
        "user_id": F.col("o_custkey"),
        "order_id": F.col("o_orderkey"),
        "payment_type": F.col("o_orderpriority"),
    }
    paid = {**row, "payment_status": F.lit("1602"), "callback_time": stamp("o_orderdate", "1 HOUR")}
    return [
        changes(
            orders,
            "payment_info",
            "insert",
            at("o_orderkey", 60),
            {**row, "payment_status": F.lit("1601")},
        ),
        changes(
            orders.where("o_orderstatus = 'O'"),
            "payment_info",
            "update",
            at("o_orderkey", 300),
            paid,
            {"payment_status": F.lit("1601")},
        ),
    ]


def refunds(lineitem: DataFrame) -> list[DataFrame]:
    returned = lineitem.where("l_returnflag = 'R'")
    line = {"id": detail_id(), "order_id": F.col("l_orderkey"), "sku_id": F.col("l_partkey")}
    return [
        changes(
            returned,
            "order_refund_info",
            "insert",
            at("l_orderkey", 700),
            {
                **line,
                "user_id": F.col("l_suppkey"),
                "refund_type": F.col("l_linestatus"),
                "refund_num": whole(F.col("l_quantity")),
                "refund_amount": money("l_extendedprice"),
                "refund_reason_type": F.col("l_returnflag"),
                "refund_reason_txt": F.concat(F.lit("line "), text_of(F.col("l_linenumber"))),
                "create_time": stamp("l_shipdate"),
            },
        ),
        changes(
            returned,
            "refund_payment",
            "insert",
            at("l_orderkey", 1300),
            {
                **line,
                "payment_type": F.col("l_linestatus"),
                "callback_time": stamp("l_shipdate", "3 DAYS"),
                "total_amount": money("l_extendedprice"),
            },
        ),
    ]


def carts(lineitem: DataFrame) -> list[DataFrame]:
    row = {
        "id": detail_id(),
        "user_id": F.col("l_suppkey"),
        "sku_id": F.col("l_partkey"),
        "cart_price": money("l_extendedprice"),
        "sku_name": F.concat(F.lit("part "), text_of(F.col("l_partkey"))),
        "is_checked": F.lit("1"),
        "create_time": stamp("l_shipdate"),
        "source_type": F.col("l_returnflag"),
        "source_id": F.col("l_suppkey"),
    }
    return [
        changes(
            lineitem,
            "cart_info",
            "insert",
            at("l_orderkey"),
            {**row, "sku_num": F.col("l_linenumber")},
        ),
        changes(
            lineitem,
            "cart_info",
            "update",
            at("l_orderkey", 30),
            {**row, "sku_num": whole(F.col("l_quantity"))},
            {"sku_num": F.col("l_linenumber")},
        ),
    ]


def coupons(orders: DataFrame) -> list[DataFrame]:
    row = {
        "id": F.col("o_orderkey"),
        "coupon_id": F.col("o_custkey") % 10,
        "user_id": F.col("o_custkey"),
        "order_id": F.col("o_orderkey"),
        "get_time": stamp("o_orderdate"),
    }
    using = {**row, "using_time": stamp("o_orderdate", "1 HOUR")}
    used = {**using, "used_time": stamp("o_orderdate", "2 HOURS")}
    return [
        changes(
            orders, "coupon_use", "insert", at("o_orderkey"), {**row, "coupon_status": F.lit("1401")}
        ),
        changes(
            orders,
            "coupon_use",
            "update",
            at("o_orderkey", 10),
            {**using, "coupon_status": F.lit("1402")},
            {"coupon_status": F.lit("1401")},
        ),
        changes(
            orders.where("o_orderstatus = 'O'"),
            "coupon_use",
            "update",
            at("o_orderkey", 20),
            {**used, "coupon_status": F.lit("1403")},
            {"coupon_status": F.lit("1402")},
        ),
    ]


def event_members(events: DataFrame) -> list[DataFrame]:
    second = F.col("event_id") + F.lit(BASE_SECONDS)
    favour = {
        "id": F.col("event_id"),
        "user_id": F.col("user_id"),
        "sku_id": F.col("event_id") % 100,
        "create_time": stamp("ts"),
    }
    cancel = F.col("event_id") % 2
    return [
        changes(
            events.where("event_type = 'view'"),
            "favor_info",
            "insert",
            second,
            {**favour, "is_cancel": F.lit("0")},
        ),
        changes(
            events.where("event_type = 'click'"),
            "favor_info",
            "update",
            second,
            {**favour, "is_cancel": cancel},
            {"is_cancel": 1 - cancel},
        ),
        changes(
            events.where("event_type = 'signup'"),
            "user_info",
            "insert",
            second,
            {"id": F.col("user_id"), "create_time": stamp("ts")},
        ),
    ]


def comments(conversations: DataFrame) -> list[DataFrame]:
    turn_id = F.concat_ws("-", "conv_id", "turn")
    turn_time = F.timestamp_seconds(F.col("conv_id") + F.lit(BASE_SECONDS))
    return [
        changes(
            conversations,
            "comment_info",
            "insert",
            F.col("conv_id") + F.lit(BASE_SECONDS),
            {
                "id": turn_id,
                "user_id": F.col("conv_id"),
                "sku_id": F.col("turn"),
                "order_id": F.col("conv_id"),
                "create_time": F.date_format(turn_time, DATE_TIME),
                "appraise": F.col("role"),
            },
        ),
    ]


def dimension_rows(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    second = F.lit(BASE_SECONDS)
    customer = table(spark, sf_dir, "customer")
    buyer = {
        "id": F.col("c_custkey"),
        "name": F.col("c_name"),
        "nation": F.col("c_nationkey"),
        "acctbal": money("c_acctbal"),
        "segment": F.col("c_mktsegment"),
    }
    debtor = {**buyer, "segment": F.lower("c_mktsegment")}
    return [
        changes(customer, "customer", "bootstrap-insert", second, buyer),
        changes(
            customer.where("c_acctbal < 0"),
            "customer",
            "update",
            second + 60,
            debtor,
            {"segment": F.col("c_mktsegment")},
        ),
        changes(customer.where("c_acctbal > 9000"), "customer", "delete", second + 90, buyer),
        changes(
            table(spark, sf_dir, "supplier"),
            "supplier",
            "bootstrap-insert",
            second,
            {
                "id": F.col("s_suppkey"),
                "name": F.col("s_name"),
                "nation": F.col("s_nationkey"),
                "acctbal": money("s_acctbal"),
            },
        ),
        changes(
            table(spark, sf_dir, "part"),
            "part",
            "insert",
            second,
            {
                "id": F.col("p_partkey"),
                "name": F.col("p_name"),
                "brand": F.col("p_brand"),
                "type": F.col("p_type"),
                "size": F.col("p_size"),
            },
        ),
        changes(
            table(spark, sf_dir, "nation"),
            "nation",
            "bootstrap-insert",
            second,
            {"n_id": F.col("n_nationkey"), "n_name": F.col("n_name")},
        ),
        changes(
            table(spark, sf_dir, "region"),
            "region",
            "bootstrap-insert",
            second,
            {"id": F.col("r_regionkey"), "name": F.col("r_name")},
        ),
    ]


def change_feed(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Change records of the named source tables, or of all.

    A filter on ``table`` removes the other inputs from the plan anyway; naming the tables also
    spares planning them.
    """
    wanted = names or tuple(t for tables, _ in FEED_PARTS for t in tables)
    parts = []
    for tables, build in FEED_PARTS:
        if set(tables) & set(wanted):
            parts += build(spark, sf_dir)
    feed = reduce(DataFrame.unionByName, parts)
    return with_times(feed.where(F.col("table").isin(*wanted)))


# Which function makes the changes of which source tables.
FEED_PARTS = (
    (("order_info",), lambda s, d: order_info(table(s, d, "orders"))),
    (
        ("order_detail", "order_detail_activity", "order_detail_coupon"),
        lambda s, d: order_lines(table(s, d, "lineitem")),
    ),
    (("payment_info",), lambda s, d: payments(table(s, d, "orders"))),
    (("order_refund_info", "refund_payment"), lambda s, d: refunds(table(s, d, "lineitem"))),
    (("cart_info",), lambda s, d: carts(table(s, d, "lineitem"))),
    (("coupon_use",), lambda s, d: coupons(table(s, d, "orders"))),
    (("favor_info", "user_info"), lambda s, d: event_members(table(s, d, "events"))),
    (("comment_info",), lambda s, d: comments(table(s, d, "conversations"))),
    (("customer", "supplier", "part", "nation", "region"), lambda s, d: dimension_rows(s, d)),
)


def feed_messages(feed: DataFrame) -> DataFrame:
    """Change records as JSON texts."""
    record = F.struct("database", "table", "type", "ts", "data", "old")
    return feed.select(F.to_json(record).alias("value"))


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes in use and their names. The codes of a column are few: it is a status or a flag.

    It is a stored table, as a dictionary is: made once, not in each lookup and micro-batch, and the
    planner sees its size. A few codes are sent to the facts, which then are not dealt by code; an
    estimate by the size of the tables it is made of would deal each code's facts to one task.
    """
    flags = F.array("l_returnflag", "l_linestatus")
    codes = [
        table(spark, sf_dir, "lineitem").select(F.explode(flags).alias("dic_code")),
        table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("dic_code")),
        table(spark, sf_dir, "conversations")
        .where("role <> 'system'")
        .select(F.col("role").alias("dic_code")),
    ]
    distinct = reduce(DataFrame.unionByName, codes).distinct()
    none = F.lit(None).cast("timestamp")
    entries = distinct.select(
        "dic_code",
        F.concat(F.lit("name of "), F.col("dic_code")).alias("dic_name"),
        F.lit("0").alias("parent_code"),
        none.alias("create_time"),
        none.alias("operate_time"),
    )
    path = scratch_dir(spark, "dictionary")
    entries.write.parquet(path)
    return read_lookup(spark, path)


# Routing rules as (source table, target table, columns, key, time written). The first customer
# rule is replaced by a later one, and the region rule is deleted.
RULES = [
    ("customer", "dim_customer", "id,name", "id", 1),
    ("customer", "dim_customer", "id,name,segment,acctbal", "id", 2),
    ("supplier", "dim_supplier", "id,name,nation", None, 1),
    ("part", "dim_part", "id,name,brand", "", 1),
    ("nation", "dim_nation", "n_id,n_name", "n_id", 1),
    ("region", "dim_region", "id,name", "id", 1),
]


def rule_messages(spark: SparkSession) -> DataFrame:
    """The rules as change-capture JSON texts."""
    names = ("source_table", "sink_table", "sink_columns", "sink_pk")
    rows = []
    for *rule, ms in RULES:
        rows.append((None, dict(zip(names, rule)), "r", ms))
    rows.append((dict(zip(names, RULES[-1][:4])), None, "d", 3))
    fields = "source_table string, sink_table string, sink_columns string, sink_pk string"
    schema = f"before struct<{fields}>, after struct<{fields}>, op string, ts_ms long"
    fields_sql = schema.replace(" string", ":string")
    made = spark.createDataFrame(rows, fields_sql)
    return made.select(F.to_json(F.struct(*made.columns)).alias("value"))


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as page records: ``common``, ``page``, ``ts``, ``seq``."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    none = F.lit(None).cast("string")
    came_from = F.when(kind.isin("signup", "view"), none).when(kind == "click", "search")
    return events.select(
        F.struct(
            text_of(F.col("user_id") % 5).alias("ar"),
            text_of(F.col("user_id")).alias("uid"),
            none.alias("os"),
            text_of(F.col("user_id") % 3).alias("ch"),
            F.when(F.col("event_id") % 3 != 0, "1").otherwise("0").alias("is_new"),
            none.alias("md"),
            text_of(F.col("user_id")).alias("mid"),
            text_of(F.col("event_id") % 4).alias("vc"),
            none.alias("ba"),
        ).alias("common"),
        F.struct(
            kind.alias("page_id"),
            F.col("props").alias("item"),
            F.when(kind == "click", "keyword").alias("item_type"),
            came_from.otherwise("home").alias("last_page_id"),
            F.round(F.col("value") * 100).cast("bigint").alias("during_time"),
        ).alias("page"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        F.col("event_id").alias("seq"),
    )


#: How much faster time runs on dense pages: records of a visitor then follow within seconds.
DENSER = 600


def dense_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_log`` in so little time that bounces match within 10 s and windows hold many rows."""
    base = BASE_SECONDS * 1000
    return page_log(spark, sf_dir).withColumn("ts", F.expr(f"{base} + (ts - {base}) div {DENSER}"))


def app_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page records with displays, actions and errors; signups are start records."""
    pages = page_log(spark, sf_dir)
    kind = F.col("page.page_id")
    text_map = "map<string,string>"
    shown = F.transform(
        F.sequence(F.lit(1), (F.col("seq") % 3).cast("int")),
        lambda i: F.create_map(F.lit("item"), text_of(i), F.lit("display_type"), F.lit("promotion")),
    )
    done = F.array(F.create_map(F.lit("action_id"), F.lit("buy"), F.lit("ts"), text_of(F.col("ts"))))
    return pages.select(
        "common",
        F.when(kind != "signup", F.col("page")).alias("page"),
        F.when(
            kind == "signup",
            F.struct(F.lit("icon").alias("entry"), F.col("page.during_time").alias("loading_time")),
        ).alias("start"),
        F.when(F.col("seq") % 3 > 0, shown).cast(f"array<{text_map}>").alias("displays"),
        F.when(kind == "purchase", done).cast(f"array<{text_map}>").alias("actions"),
        F.when(kind == "error", F.concat(F.lit("code "), F.col("seq").cast("string"))).alias("err"),
        "ts",
        "seq",
    )


def dealt(df: DataFrame) -> DataFrame:
    """On one machine, rows dealt over its cores: the events are one file of one row group there, and
    would be one task. A log has as many parts as its topic has partitions."""
    spark = df.sparkSession
    return df.repartition(spark.sparkContext.defaultParallelism) if is_local(spark) else df


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App log as JSON texts, and the documents as lines that are no records."""
    logs = dealt(app_log(spark, sf_dir))
    record = F.struct(*[c for c in logs.columns if c != "seq"])
    good = logs.select(F.to_json(record).alias("value"), "seq")
    bad = table(spark, sf_dir, "documents").select(
        F.col("text").alias("value"), (-1 - F.col("doc_id")).alias("seq")
    )
    return good.unionByName(bad)


def open_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log texts with fields, types and nesting that no fixed layout has, and as objects
    without a visitor."""
    pages = dealt(page_log(spark, sf_dir))
    seq = F.col("seq")
    view = F.struct(
        F.col("page.page_id").alias("page_id"),
        F.lit("promo").alias("source_type"),
        (seq + 0.5).alias("during_time"),
    )
    record = F.struct(
        F.struct("common.mid", "common.is_new", F.concat(F.lit("s"), seq).alias("sid")).alias("common"),
        view.alias("page"),
        F.array(F.struct(seq.alias("item"), F.lit("old").alias("ts"))).alias("displays"),
        F.when(F.col("page.page_id") == "error", F.struct(seq.alias("error_code"))).alias("err"),
        F.struct(seq.alias("id")).alias("trace"),
        F.col("ts").cast("string").alias("ts"),
    )
    good = pages.select(F.to_json(record).alias("value"), "seq")
    bad = pages.select(F.to_json(F.struct("seq")).alias("value"), (-1 - seq).alias("seq"))
    return good.unionByName(bad)


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as searched keywords, one per second, and all events, as page maps."""
    documents = table(spark, sf_dir, "documents")
    searched = documents.select(
        F.create_map(
            F.lit("item"),
            F.col("text"),
            F.lit("item_type"),
            F.lit("keyword"),
            F.lit("last_page_id"),
            F.lit("search"),
        ).alias("page"),
        ((F.col("doc_id") + F.lit(BASE_SECONDS)) * 1000 + 500).alias("ts"),
    )
    page = F.col("page")
    seen = page_log(spark, sf_dir).select(
        F.create_map(
            F.lit("item"),
            page["item"],
            F.lit("item_type"),
            page["item_type"],
            F.lit("last_page_id"),
            page["last_page_id"],
        ).alias("page"),
        "ts",
    )
    return searched.unionByName(seen)


def sensors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Clicks as readings and all events as names, both with an event time."""
    events = table(spark, sf_dir, "events").withColumn("et", F.col("ts").cast("timestamp"))
    readings = events.where("event_type = 'click'").select(
        text_of(F.col("user_id")).alias("id"),
        F.col("value").alias("vc"),
        F.col("event_id").alias("l_seq"),
        F.col("et").alias("l_et"),
    )
    names = events.select(
        text_of(F.col("user_id")).alias("id"),
        F.concat(F.lit("sensor "), text_of(F.col("event_id"))).alias("name"),
        F.col("et").alias("r_et"),
    )
    return readings, names
