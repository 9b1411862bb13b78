"""Order, cart, payment and refund facts from the change feed.

All functions take data frames, bounded or streaming. ``within`` bounds the distance of the
change times of joined rows; streams need it, tables do not. A bound of '5 SECONDS' (orders,
refunds) or '905 SECONDS' (payments: 15 minutes to pay plus 5 seconds) keeps join state as small
as short-lived state would; a longer one also joins later changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.times import date_id
from tidemart.functions.values import field
from tidemart.operators.changes import cdc_filter, delta_value, is_increase, status_transition
from tidemart.operators.joins import (
    inner_stream_join,
    left_stream_join,
    lookup_entries,
    lookup_join,
)

# Order and payment states.
CANCELLED, REFUNDING, REFUNDED, PAID = "1003", "1005", "1006", "1602"

# Columns of the source tables and of the facts.
DETAIL_FIELDS = (
    "id order_id sku_id sku_name order_price sku_num create_time source_type source_id "
    "split_total_amount split_activity_amount split_coupon_amount"
).split()
ORDER_FIELDS = (
    "consignee consignee_tel total_amount order_status user_id payment_way delivery_address "
    "order_comment out_trade_no trade_body operate_time expire_time process_status tracking_no "
    "parent_order_id province_id activity_reduce_amount coupon_reduce_amount "
    "original_total_amount feight_fee feight_fee_reduce refundable_time"
).split()
CART_FIELDS = (
    "id user_id sku_id cart_price img_url sku_name is_checked create_time operate_time "
    "is_ordered order_time source_type source_id"
).split()
PRE_PROCESS_COLUMNS = (
    "id order_id sku_id sku_name order_price sku_num create_time source_type_id "
    "source_type_name source_id split_total_amount split_activity_amount split_coupon_amount "
    "consignee consignee_tel total_amount order_status user_id payment_way delivery_address "
    "order_comment out_trade_no trade_body operate_time expire_time process_status tracking_no "
    "parent_order_id province_id activity_reduce_amount coupon_reduce_amount "
    "original_total_amount feight_fee feight_fee_reduce refundable_time "
    "order_detail_activity_id activity_id activity_rule_id "
    "order_detail_coupon_id coupon_id coupon_use_id type old"
).split()
ORDER_DETAIL_COLUMNS = (
    "id order_id user_id sku_id sku_name sku_num order_price province_id activity_id "
    "activity_rule_id coupon_id create_time source_id source_type_id source_type_name "
    "split_activity_amount split_coupon_amount split_total_amount"
).split()
CANCEL_COLUMNS = (
    "id order_id user_id sku_id sku_name province_id activity_id activity_rule_id coupon_id "
    "cancel_time source_id source_type_id source_type_name sku_num order_price "
    "split_activity_amount split_coupon_amount split_total_amount"
).split()
PAY_COLUMNS = (
    "order_detail_id order_id user_id sku_id sku_name province_id activity_id activity_rule_id "
    "coupon_id payment_type_code payment_type_name callback_time source_id source_type_id "
    "source_type_name sku_num order_price split_activity_amount split_coupon_amount "
    "split_payment_amount"
).split()
CART_COLUMNS = (
    "id user_id sku_id cart_price sku_num img_url sku_name is_checked create_time operate_time "
    "is_ordered order_time source_type_id source_type_name source_id"
).split()
REFUND_COLUMNS = (
    "id user_id order_id sku_id province_id date_id create_time refund_type_code "
    "refund_type_name refund_reason_type_code refund_reason_type_name refund_reason_txt "
    "refund_num refund_amount ts row_op_ts"
).split()
REFUND_PAY_COLUMNS = (
    "id user_id order_id sku_id province_id payment_type_code payment_type_name date_id "
    "callback_time refund_num refund_amount ts row_op_ts"
).split()


def _as(key: str, name: str):
    return field(key).alias(name)


def _time(name: str):
    return F.col("et").alias(name)


def _named(facts: DataFrame, dictionary: DataFrame | None, names: dict[str, str]) -> DataFrame:
    """Facts with dictionary names (``{code column: name column}``), or as they are without a dictionary."""
    if dictionary is None:
        return facts
    entries = lookup_entries(dictionary)
    for code, name in names.items():
        facts = lookup_join(facts, entries, code, name)
    return facts


def _shown(columns: list[str], dictionary: DataFrame | None, names: dict[str, str]) -> list[str]:
    return [c for c in columns if dictionary is not None or c not in names.values()]


# Which names a job takes from the dictionary. A stream runs the job without a dictionary and gives
# these to ``runner.with_lookups``, so that a code which came after its start is found.
PRE_NAMES = {"source_type_id": "source_type_name"}
PAY_NAMES = {"payment_type_code": "payment_type_name"}
REFUND_NAMES = {
    "refund_type_code": "refund_type_name",
    "refund_reason_type_code": "refund_reason_type_name",
}


def order_pre_process(
    feed: DataFrame,
    dictionary: DataFrame | None = None,
    database: str | None = None,
    within: str | None = None,
) -> DataFrame:
    """Order lines with their order, activity, coupon and source name, one row per order change.

    Without a dictionary there is no ``source_type_name``: streams add it per micro-batch.
    ``et`` (time of the line's change) and ``version`` (of the order's change, in seconds) are
    added to the columns, for later joins and for upserts by ``id``.
    """
    details = cdc_filter(feed, "order_detail", DETAIL_FIELDS, database=database, keep=["et"])
    details = details.withColumnRenamed("source_type", "source_type_id")
    details = _named(details, dictionary, PRE_NAMES)
    version = F.col("ts").try_cast("bigint").alias("version")
    orders = cdc_filter(
        feed,
        "order_info",
        [_as("id", "oi_id"), *ORDER_FIELDS, version, _time("oi_et")],
        types=("insert", "update"),
        database=database,
        keep=["type", "old"],
    )
    activities = cdc_filter(
        feed,
        "order_detail_activity",
        [_as("id", "order_detail_activity_id"), _as("order_detail_id", "oa_detail_id")]
        + ["activity_id", "activity_rule_id", _time("oa_et")],
        database=database,
    )
    coupons = cdc_filter(
        feed,
        "order_detail_coupon",
        [_as("id", "order_detail_coupon_id"), _as("order_detail_id", "oc_detail_id")]
        + ["coupon_id", "coupon_use_id", _time("oc_et")],
        database=database,
    )
    # One event-time column between the joins: a stream allows no second one.
    # Orders come last: they multiply a line by its order's changes and make it wide. Activities
    # and coupons meet the narrow lines on one key.
    joined = left_stream_join(
        details, activities, [("id", "oa_detail_id")], times=("et", "oa_et"), within=within
    ).drop("oa_et")
    joined = left_stream_join(
        joined, coupons, [("id", "oc_detail_id")], times=("et", "oc_et"), within=within
    ).drop("oc_et")
    joined = inner_stream_join(
        joined, orders, [("order_id", "oi_id")], times=("et", "oi_et"), within=within
    ).drop("oi_et")
    return joined.select(*_shown(PRE_PROCESS_COLUMNS, dictionary, PRE_NAMES), "version", "et")


def order_detail(pre: DataFrame) -> DataFrame:
    return pre.where(F.col("type") == "insert").select(*ORDER_DETAIL_COLUMNS, "et")


def cancel_detail(pre: DataFrame) -> DataFrame:
    cancelled = status_transition("order_status", CANCELLED, current=F.col("order_status"))
    return (
        pre.where(cancelled)
        .withColumnRenamed("operate_time", "cancel_time")
        .select(*CANCEL_COLUMNS)
    )


def pay_detail_suc(
    feed: DataFrame, details: DataFrame, dictionary: DataFrame | None = None, within: str | None = None
) -> DataFrame:
    """Order lines that were paid. ``details`` is the result of ``order_detail``.

    Without a dictionary there is no ``payment_type_name``.
    """
    payments = cdc_filter(
        feed,
        "payment_info",
        [_as("order_id", "pi_order_id"), _as("payment_type", "payment_type_code")]
        + ["callback_time", _time("pi_et")],
        types=("update",),
        where=field("payment_status") == PAID,
    )
    payments = _named(payments, dictionary, PAY_NAMES)
    joined = inner_stream_join(
        payments, details, [("pi_order_id", "order_id")], times=("pi_et", "et"), within=within
    )
    return (
        joined.withColumnRenamed("id", "order_detail_id")
        .withColumnRenamed("split_total_amount", "split_payment_amount")
        .select(*_shown(PAY_COLUMNS, dictionary, PAY_NAMES))
    )


def cart_add(
    feed: DataFrame, dictionary: DataFrame | None = None, database: str | None = None
) -> DataFrame:
    """Inserted cart rows, and by how much an update raised the number.

    Without a dictionary there is no ``source_type_name``: streams add it per micro-batch.
    """
    carts = cdc_filter(
        feed,
        "cart_info",
        [*CART_FIELDS, delta_value("sku_num").alias("sku_num")],
        types=None,
        database=database,
        where=is_increase("sku_num"),
    )
    named = _named(carts.withColumnRenamed("source_type", "source_type_id"), dictionary, PRE_NAMES)
    return named.select(*_shown(CART_COLUMNS, dictionary, PRE_NAMES))


def order_refund(
    feed: DataFrame, dictionary: DataFrame | None = None, within: str | None = None
) -> DataFrame:
    """Refunded lines of orders that moved to the refund state. Without a dictionary no names."""
    refunds = cdc_filter(
        feed,
        "order_refund_info",
        "id user_id order_id sku_id refund_num refund_amount refund_reason_txt create_time".split()
        + [_as("refund_type", "refund_type_code")]
        + [_as("refund_reason_type", "refund_reason_type_code")],
        keep=["ts", "et"],
    )
    refunds = _named(refunds, dictionary, REFUND_NAMES)
    orders = cdc_filter(
        feed,
        "order_info",
        [_as("id", "oi_id"), "province_id", _time("oi_et")],
        types=("update",),
        where=status_transition("order_status", REFUNDING),
    )
    joined = inner_stream_join(
        refunds, orders, [("order_id", "oi_id")], times=("et", "oi_et"), within=within
    )
    return (
        joined.withColumn("date_id", date_id("create_time"))
        .withColumn("row_op_ts", F.current_timestamp())
        .select(*_shown(REFUND_COLUMNS, dictionary, REFUND_NAMES))
    )


def refund_pay_suc(
    feed: DataFrame,
    dictionary: DataFrame | None = None,
    within: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Paid-back refunds. ``strict`` also asks for the refund states 0702 and 0705.

    Without a dictionary there is no ``payment_type_name``.
    """
    payments = cdc_filter(
        feed,
        "refund_payment",
        ["id", "order_id", "sku_id", "callback_time", _as("payment_type", "payment_type_code")]
        + [_as("total_amount", "refund_amount")],
        types=None,
        where=status_transition("refund_status", "0702") if strict else None,
        keep=["ts", "et"],
    )
    payments = _named(payments, dictionary, PAY_NAMES)
    orders = cdc_filter(
        feed,
        "order_info",
        [_as("id", "oi_id"), "user_id", "province_id", _time("oi_et")],
        types=("update",),
        where=status_transition("order_status", REFUNDED),
    )
    refunds = cdc_filter(
        feed,
        "order_refund_info",
        [_as("order_id", "ri_order_id"), _as("sku_id", "ri_sku_id"), "refund_num", _time("ri_et")],
        types=None,
        where=status_transition("refund_status", "0705") if strict else None,
    )
    joined = inner_stream_join(
        payments, orders, [("order_id", "oi_id")], times=("et", "oi_et"), within=within
    ).drop("oi_et")
    joined = inner_stream_join(
        joined,
        refunds,
        [("order_id", "ri_order_id"), ("sku_id", "ri_sku_id")],
        times=("et", "ri_et"),
        within=within,
    )
    return (
        joined.withColumn("date_id", date_id("callback_time"))
        .withColumn("row_op_ts", F.current_timestamp())
        .select(*_shown(REFUND_PAY_COLUMNS, dictionary, PAY_NAMES))
    )
