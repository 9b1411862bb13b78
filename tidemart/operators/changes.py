"""Operators on change records: validation, filters, projections."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.values import as_int, field
from tidemart.functions.variants import as_type

# Change types that carry a new row state.
UPSERT_TYPES = ("insert", "update", "bootstrap-insert")

#: Column of a feed that keeps the message text of a record (see ``sources.read_change_feed``).
MESSAGE = "_message"


def split_valid_json(
    lines: DataFrame,
    schema: T.StructType,
    column: str = "value",
    required: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Parsed records, and the lines that are no JSON object or miss a required field.

    A value of another type than the layout's is taken as far as it can be (``variants.as_type``) and
    does not make a record dirty. An object that repeats a key is dirty. Both results come from one
    narrow expression over the same scan. Columns of ``lines`` other than the text pass through.
    """
    rest = [c for c in lines.columns if c != column]
    # Generators are evaluated once per row. A projection would be copied into the filters and the
    # text parsed anew for each field they look at.
    once = F.explode(F.array(as_type(json_object(F.col(column)), schema))).alias("_r")
    taken = lines.select(*rest, F.col(column), once)
    good = F.col("_r").isNotNull()
    for name in required:
        good = good & F.col(f"_r.{name}").isNotNull()
    valid = taken.where(good).select(*rest, *[F.col(f"_r.{f.name}") for f in schema.fields])
    dirty = taken.where(~good).select(*rest, F.col(column))
    return valid, dirty


def json_object(text: Column) -> Column:
    """The JSON object in a text as a variant; NULL for all other texts."""
    return F.when(F.ltrim(text).startswith("{"), F.try_parse_json(text))


def may_name(message: Column, table: str) -> Column:
    """Whether a JSON text may hold ``table`` as a text value; false only where it cannot.

    A text stands in quotes as it is, or has a backslash. Names that could also come from a number or
    ``true`` are not told from the text.
    """
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", table) or table in ("true", "false"):
        return F.lit(True)
    return message.contains(f'"{table}"') | message.contains("\\")


def cdc_filter(
    feed: DataFrame,
    table: str,
    fields: Sequence[str | Column],
    types: Sequence[str] | None = ("insert",),
    database: str | None = None,
    where: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows of one source table, with ``fields`` taken out of ``data``.

    Where the feed keeps its message texts, a text that cannot be of the table is not parsed: a job on
    several tables of one feed opens each message once, not once for each table.
    """
    if MESSAGE in feed.columns:
        feed = feed.where(may_name(F.col(MESSAGE), table))
    rows = feed.where(F.col("table") == table)
    if types is not None:
        rows = rows.where(F.col("type").isin(*types))
    if database is not None:
        rows = rows.where(F.col("database") == database)
    if where is not None:
        rows = rows.where(where)
    picked = [field(f).alias(f) if isinstance(f, str) else f for f in fields]
    return rows.select(*picked, *keep)


def cdc_upserts_only(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("type").isin(*UPSERT_TYPES))


def status_transition(
    key: str, new: str, old: str | None = None, current: Column | None = None
) -> Column:
    """True for an update that moved ``key`` to ``new`` (from ``old``, or from any value).

    ``current`` is the new value where it is not in ``data``.
    """
    current = field(key) if current is None else current
    before = field(key, "old")
    moved = before.isNotNull() if old is None else before == old
    return (F.col("type") == "update") & moved & (current == new)


def is_increase(key: str) -> Column:
    """True for an insert, or an update that raised the number under ``key``."""
    raised = as_int(field(key)) > as_int(field(key, "old"))
    return (F.col("type") == "insert") | ((F.col("type") == "update") & raised)


def delta_value(key: str) -> Column:
    """Inserted value, or by how much an update raised it, as text."""
    rise = (as_int(field(key)) - as_int(field(key, "old"))).cast("string")
    return F.when(F.col("type") == "insert", field(key)).otherwise(rise)


def config_column_filter(columns: Column, data: Column) -> Column:
    """Entries of ``data`` whose key is in the comma-separated ``columns``."""
    names = F.split(columns, ",")
    return F.map_filter(data, lambda k, v: F.array_contains(names, k))


def union_streams(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all inputs by column name; duplicates stay."""
    for other in others:
        first = first.unionByName(other)
    return first


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key by ``order``.

    ``row_number() = 1`` is cut to one row per key in each map task before the shuffle, so a
    key with very many versions does not reach one task whole.
    """
    from pyspark.sql import Window

    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(newest_first)).where("_rn = 1").drop("_rn")
