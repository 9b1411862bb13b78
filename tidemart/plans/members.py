"""Coupon, favourite, comment and registration facts: narrow passes over the change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.times import date_id
from tidemart.functions.values import field
from tidemart.operators.changes import cdc_filter, status_transition
from tidemart.operators.joins import lookup_entries, lookup_join

# Coupon states.
COUPON_UNUSED, COUPON_IN_USE = "1401", "1402"


def _dated(rows: DataFrame, time: str, columns: str) -> DataFrame:
    return rows.withColumn("date_id", date_id(time)).select(*columns.split())


def coupon_get(feed: DataFrame) -> DataFrame:
    rows = cdc_filter(feed, "coupon_use", ["id", "coupon_id", "user_id", "get_time"], keep=["ts"])
    return _dated(rows, "get_time", "id coupon_id user_id date_id get_time ts")


def coupon_order(feed: DataFrame) -> DataFrame:
    rows = cdc_filter(
        feed,
        "coupon_use",
        ["id", "coupon_id", "user_id", "order_id", field("using_time").alias("order_time")],
        types=("update",),
        where=status_transition("coupon_status", COUPON_IN_USE, COUPON_UNUSED),
        keep=["ts"],
    )
    return _dated(rows, "order_time", "id coupon_id user_id order_id date_id order_time ts")


def coupon_pay(feed: DataFrame) -> DataFrame:
    rows = cdc_filter(
        feed,
        "coupon_use",
        ["id", "coupon_id", "user_id", "order_id", field("used_time").alias("payment_time")],
        types=("update",),
        where=field("used_time").isNotNull(),
        keep=["ts"],
    )
    return _dated(rows, "payment_time", "id coupon_id user_id order_id date_id payment_time ts")


def favor_add(feed: DataFrame) -> DataFrame:
    added = (F.col("type") == "insert") | (
        (F.col("type") == "update") & (field("is_cancel") == "0")
    )
    rows = cdc_filter(
        feed,
        "favor_info",
        ["id", "user_id", "sku_id", "create_time"],
        types=None,
        where=added,
        keep=["ts"],
    )
    return _dated(rows, "create_time", "id user_id sku_id date_id create_time ts")


COMMENT_COLUMNS = "id user_id sku_id order_id date_id create_time appraise_code appraise_name ts".split()
COMMENT_NAMES = {"appraise_code": "appraise_name"}


def comment(feed: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Inserted comments. Without a dictionary there is no ``appraise_name``: streams add it per
    micro-batch with ``runner.with_lookups`` and COMMENT_NAMES."""
    fields = ["id", "user_id", "sku_id", "order_id", "create_time"]
    rows = cdc_filter(
        feed, "comment_info", [*fields, field("appraise").alias("appraise_code")], keep=["ts"]
    )
    if dictionary is None:
        coded = [c for c in COMMENT_COLUMNS if c not in COMMENT_NAMES.values()]
        return _dated(rows, "create_time", " ".join(coded))
    named = lookup_join(rows, lookup_entries(dictionary), "appraise_code", "appraise_name")
    return _dated(named, "create_time", " ".join(COMMENT_COLUMNS))


def user_register(feed: DataFrame) -> DataFrame:
    rows = cdc_filter(
        feed, "user_info", [field("id").alias("user_id"), "create_time"], keep=["ts"]
    )
    return _dated(rows, "create_time", "user_id date_id create_time ts")
