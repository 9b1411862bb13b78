"""Dimension tables from the change feed, routed by rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.operators.changes import cdc_upserts_only
from tidemart.operators.config import (
    config_broadcast_join,
    has_key,
    latest_config,
    rule_spans,
    rule_versions,
    rules_at_change,
)
from tidemart.schemas import CONFIG_RECORD
from tidemart.sinks.keyed import KeyedTable
from tidemart.sinks.writers import BatchWriter, ensure_dim_table, write_dim_routed


def dim_app(feed: DataFrame, rule_records: DataFrame, order: str = "ts_ms") -> DataFrame:
    """Inserted, updated and bootstrapped rows of configured tables, with their target table.

    A rule whose key is not among its columns makes no table; ``config.lacks_key`` names these.
    """
    rules = has_key(latest_config(rule_records, order))
    return config_broadcast_join(cdc_upserts_only(feed), rules)


def make_dim_tables(spark: SparkSession, root: str, rules: DataFrame) -> None:
    """Tables for all rules. Rules are written by hand, so they are walked one by one."""
    for rule in rules.toLocalIterator():
        ensure_dim_table(spark, root, rule.asDict())


def write_dims(root: str, rule_records, order: str = "ts_ms", version: str = "ts") -> BatchWriter:
    """Batch writer: reads the rules anew for each micro-batch, routes and upserts it.

    ``rule_records`` is a function that gives the current rule records. Where the rules come as a
    stream of their own, see ``write_dims_live``.
    """
    upsert = write_dim_routed(root, version)

    def write(feed: DataFrame, batch_id: int) -> None:
        upsert(dim_app(feed, rule_records(), order), batch_id)

    return write


CHANGE_PART, RULE_PART = "change", "rule"


def with_rules(feed: DataFrame, rule_records: DataFrame) -> DataFrame:
    """The change feed and the rule feed as one, for ``write_dims_live``; both may be streams."""
    change = feed.select(F.struct(*feed.columns).alias(CHANGE_PART))
    rule = rule_records.select(F.struct(*CONFIG_RECORD.names).alias(RULE_PART))
    return change.unionByName(rule, allowMissingColumns=True)


def rule_table(spark: SparkSession, root: str) -> KeyedTable:
    """All versions of all rules. Of two that a source table got in one millisecond the last stands."""
    return KeyedTable(spark, f"{root}/_rules", ["source_table", "from_ms"], ["ts_ms"], buckets=1)


def write_dims_live(root: str, version: str = "ts") -> BatchWriter:
    """Batch writer for ``with_rules``: rules that come make, widen and stop tables while it runs.

    The rules of a micro-batch go to the rule table first; a rule with a key makes its table or adds
    its new columns at once. Each change is then routed by the rule that held at its own time
    (``version``, in seconds), so that a backlog is not routed by rules that came after it. Changes of a
    table without a rule are dropped; a change that comes before its rule was read is not kept for it.
    What a rule without its key among the columns would route is counted, by batch, source and sink
    table, in the folder ``_lacking``.

    The change rows of a batch are used twice (routing, counts), so a batch is kept until it is done.
    """
    upsert = write_dim_routed(root, version)

    def write(both: DataFrame, batch_id: int) -> None:
        spark = both.sparkSession
        both = both.persist()
        rules = rule_table(spark, root)
        versions = rule_versions(both.where(f"{RULE_PART} IS NOT NULL").select(f"{RULE_PART}.*"))
        rules.write(versions, batch_id)
        spans = rule_spans(rules.read())
        # Rules are written by hand: the new ones are few.
        fresh = spans.where("keyed").join(versions.select("source_table", "from_ms").distinct(), ["source_table", "from_ms"])
        make_dim_tables(spark, root, fresh)
        changes = both.where(f"{CHANGE_PART} IS NOT NULL").select(f"{CHANGE_PART}.*")
        time = F.col(version).try_cast("bigint") * 1000
        routed = rules_at_change(cdc_upserts_only(changes), spans, time)
        upsert(routed.where("keyed").drop("keyed"), batch_id)
        lacking = routed.where("NOT keyed").groupBy(F.col("table").alias("source_table"), "sink_table").agg(
            F.count("*").alias("n")
        )
        lacking.write.mode("overwrite").parquet(f"{root}/_lacking/batch_id={batch_id}")
        both.unpersist()

    return write


LACKING = T.StructType(
    [
        T.StructField("source_table", T.StringType()),
        T.StructField("sink_table", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def read_lacking(spark: SparkSession, root: str) -> DataFrame:
    """How many changes each batch had for rules that lack their key."""
    return spark.read.schema(LACKING).parquet(f"{root}/_lacking")
