"""Dimension routing rules: the newest rule per source table, applied to change records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.operators.changes import config_column_filter, latest_by_key
from tidemart.schemas import CONFIG_FIELDS

DEFAULT_PK = "id"


def latest_config(records: DataFrame, order: str = "ts_ms") -> DataFrame:
    """One rule per source table, the last one written. A deleted rule (no ``after``) is gone."""
    source = F.coalesce(F.col("after.source_table"), F.col("before.source_table"))
    newest = latest_by_key(records.select(source.alias("_source"), "after", order), ["_source"], [order])
    rules = newest.where("after IS NOT NULL").select(*[F.col(f"after.{name}").alias(name) for name in CONFIG_FIELDS])
    pk = F.when(F.coalesce(F.col("sink_pk"), F.lit("")) == "", DEFAULT_PK).otherwise(
        F.col("sink_pk")
    )
    return rules.withColumn("sink_pk", pk)


def rule_versions(records: DataFrame) -> DataFrame:
    """Rule records as versions: ``(source_table, from_ms, gone, ...)`` with the rule's other fields.

    A rule read in the first snapshot (``op`` r) holds for everything before; a later one from its
    time on. A deleted rule is a version that is ``gone``.
    """
    source = F.coalesce(F.col("after.source_table"), F.col("before.source_table"))
    start = F.when(F.col("op") == "r", F.lit(0)).otherwise(F.col("ts_ms")).cast("bigint")
    rest = [F.col(f"after.{name}").alias(name) for name in CONFIG_FIELDS if name != "source_table"]
    versions = records.select(
        source.alias("source_table"), start.alias("from_ms"), "ts_ms", F.col("after").isNull().alias("gone"), *rest
    )
    return versions.where("source_table IS NOT NULL AND from_ms IS NOT NULL")


def rule_spans(versions: DataFrame) -> DataFrame:
    """Each rule with the time ``[from_ms, to_ms)`` in which it holds, its key, and whether the key is
    one of its columns (``keyed``). ``to_ms`` is null for the present rule."""
    in_time = Window.partitionBy("source_table").orderBy("from_ms")
    spans = versions.withColumn("to_ms", F.lead("from_ms").over(in_time)).where("NOT gone")
    pk = F.when(F.coalesce("sink_pk", F.lit("")) == "", DEFAULT_PK).otherwise(F.col("sink_pk"))
    keyed = F.array_contains(F.split("sink_columns", ","), pk)
    return spans.withColumns({"sink_pk": pk, "keyed": F.coalesce(keyed, F.lit(False))})


def rules_at_change(changes: DataFrame, spans: DataFrame, time_ms: Column) -> DataFrame:
    """Change records with the rule that held at their time; those without one are dropped.

    Adds ``sink_table``, ``sink_pk``, ``sink_key`` and ``keyed``, and cuts ``data`` to the rule's
    columns, after the key has been taken. Rules are written by hand: they are sent to the changes, which
    would else be dealt by source table, each to one task.
    """
    rules = spans.select(
        F.col("source_table").alias("_source"), "from_ms", "to_ms", "sink_table", "sink_columns", "sink_pk", "keyed"
    )
    timed = changes.withColumn("_ms", time_ms)
    held = (
        (F.col("table") == F.col("_source"))
        & (F.col("_ms") >= F.col("from_ms"))
        & (F.col("to_ms").isNull() | (F.col("_ms") < F.col("to_ms")))
    )
    matched = timed.join(F.broadcast(rules), held).withColumn("sink_key", F.col("data")[F.col("sink_pk")])
    cut = config_column_filter(F.col("sink_columns"), F.col("data"))
    return matched.withColumn("data", cut).drop("_source", "_ms", "from_ms", "to_ms", "sink_columns")


def config_broadcast_join(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Change records of configured tables, ``data`` cut to the configured columns.

    Adds ``sink_table``, ``sink_pk`` and ``sink_key``, the key's value, which is taken before the
    cut. Records of other tables are dropped. Rules are written by hand, so they are sent to the changes.
    """
    wanted = rules.select(
        F.col("source_table").alias("_source"), "sink_table", "sink_columns", "sink_pk"
    )
    matched = changes.join(F.broadcast(wanted), F.col("table") == F.col("_source"))
    keyed = matched.withColumn("sink_key", F.col("data")[F.col("sink_pk")])
    return keyed.withColumn(
        "data", config_column_filter(F.col("sink_columns"), F.col("data"))
    ).drop("_source", "sink_columns")


def has_key(rules: DataFrame) -> DataFrame:
    """The rules whose key is one of their columns; a table cannot be made for the others."""
    return rules.where(F.array_contains(F.split("sink_columns", ","), F.col("sink_pk")))


def lacks_key(rules: DataFrame) -> DataFrame:
    """The rules that ``has_key`` leaves out, to be reported."""
    named = F.array_contains(F.split("sink_columns", ","), F.col("sink_pk"))
    return rules.where(~F.coalesce(named, F.lit(False)))
