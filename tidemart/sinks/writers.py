"""Sinks for tables and, as ``foreachBatch`` functions, for streams.

Appending file sinks write a micro-batch to its own ``batch_id=<n>`` folder and replace that folder
when the batch runs again after a failure, so no row is written twice; their work grows with the
batch, never with what was written before. Upserts and dimensions are tables that fold by themselves
(``sinks.keyed``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.times import now_ms, now_seconds_ms
from tidemart.operators.changes import latest_by_key
from tidemart.sinks import files
from tidemart.sinks.keyed import REMOVED, KeyedTable

BatchWriter = Callable[[DataFrame, int], None]

KAFKA_PRODUCER_SAFE = {"kafka.enable.idempotence": "true", "kafka.acks": "all"}


def as_messages(df: DataFrame, key: Sequence[str] = (), topic: str | None = None) -> DataFrame:
    """Rows as JSON messages; with ``key`` also a JSON key, so one key stays in one partition."""
    columns = [F.to_json(F.struct(*df.columns)).alias("value")]
    if key:
        columns.insert(0, F.to_json(F.struct(*key)).alias("key"))
    if topic is not None:
        columns.append(F.lit(topic).alias("topic"))
    return df.select(*columns)


def never_null(messages: DataFrame) -> DataFrame:
    return messages.withColumn("value", F.coalesce(F.col("value"), F.lit("")))


def kafka_sink_options(servers: str, topic: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, **KAFKA_PRODUCER_SAFE}
    if topic is not None:
        options["topic"] = topic
    return options


def _batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def write_append(path: str) -> BatchWriter:
    """Rows as JSON text."""

    def write(df: DataFrame, batch_id: int) -> None:
        as_messages(df).write.mode("overwrite").text(_batch_path(path, batch_id))

    return write


def write_messages(
    topic: str | None = None,
    key: Sequence[str] = (),
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
) -> BatchWriter:
    """Rows as JSON messages to a topic; with ``key`` a key's messages stay in one partition.

    To a queue by its options, at least once, as its writer is; or, with ``path``, to files of another
    format, a folder for each batch.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        out = as_messages(df, key, topic).write.format(fmt).options(**(options or {}))
        if path is None:
            out.mode("append").save()
        else:
            out.mode("overwrite").save(_batch_path(path, batch_id))

    return write


def write_exactly_once(path: str) -> BatchWriter:
    """Message texts; a missing text becomes an empty one."""

    def write(df: DataFrame, batch_id: int) -> None:
        never_null(df.select("value")).write.mode("overwrite").parquet(_batch_path(path, batch_id))

    return write


def write_upsert(path: str, keys: Sequence[str], order: Sequence[str]) -> BatchWriter:
    """The last row per key of each batch into a table that folds by itself.

    A row with ``_removed`` true takes its key out. Rows of one batch with the same ``order`` values
    are told apart by their ``position`` in the source, where they have one.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        KeyedTable(df.sparkSession, path, keys, in_source(df, order)).write(df, batch_id)

    return write


def in_source(df: DataFrame, order: Sequence[str]) -> list[str]:
    """The order columns, then the position in the source, if the rows carry it."""
    return [*order, *(["position"] if "position" in df.columns and "position" not in order else [])]


def read_upsert(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The current row per key: the newest batch that has the key wins."""
    return KeyedTable(spark, path, keys).read()


def compact_upsert(spark: SparkSession, path: str, target: str, keys: Sequence[str]) -> None:
    """The current rows as the first batch of another folder, to go on from there."""
    KeyedTable(spark, target, keys).write(read_upsert(spark, path, keys), 0)


def drop_transient(df: DataFrame, transient: Sequence[str]) -> DataFrame:
    return df.drop(*transient)


def jdbc_options(url: str, table: str, driver: str | None = None, batch: int = 1000) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch)}
    if driver:
        options["driver"] = driver
    return options


def write_summary(
    columns: Sequence[str],
    jdbc: Mapping[str, str] | None = None,
    path: str | None = None,
    transient: Sequence[str] = (),
    whole_seconds: bool = False,
) -> BatchWriter:
    """Summary rows with the write time ``ts``, columns in the given order.

    ``ts`` is in milliseconds, as the traffic summary has it, or in milliseconds of whole seconds, as
    the keyword summary has it. To a database by JDBC (each task one connection, rows in batches) or to parquet files.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        stamped = df.withColumn("ts", now_seconds_ms() if whole_seconds else now_ms()).select(*columns)
        rows = drop_transient(stamped, transient)
        if jdbc is not None:
            rows.write.format("jdbc").options(**jdbc).mode("append").save()
        else:
            rows.write.mode("overwrite").parquet(_batch_path(path, batch_id))

    return write


def write_routed(path: str, by: str = "kind") -> BatchWriter:
    """Rows to one folder per value of ``by``, all in one job over the batch."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").partitionBy(by).parquet(_batch_path(path, batch_id))

    return write


def dim_schema(rule: Mapping[str, str]) -> T.StructType:
    """Columns of a dimension table: all text, the key (default ``id``) not null."""
    pk = rule.get("sink_pk") or "id"
    return T.StructType(
        [
            T.StructField(name, T.StringType(), name != pk)
            for name in rule["sink_columns"].split(",")
        ]
    )


def dim_rows(routed: DataFrame, version: str) -> DataFrame:
    """Routed change records as keyed dimension rows. Changes of one second keep the order of their
    ``position`` in the source, if they carry it."""
    order = [F.col(version).cast("bigint").alias("version")]
    if "position" in routed.columns:
        order.append(F.col("position"))
    return routed.select("sink_table", F.col("sink_key").alias("pk"), "data", F.struct(*order).alias("version"))


def merged_dim_rows(rows: DataFrame, keys: Sequence[str] = ("sink_table", "pk")) -> DataFrame:
    """One row per table and key, each column with the value that came last.

    A change sets only the columns it has; a column it does not have keeps its value.
    """
    cells = rows.select(*keys, "version", F.explode("data").alias("name", "value"))
    last = latest_by_key(cells, [*keys, "name"], ["version"])
    entry = F.struct("name", "value")
    return last.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("data"))


def _typed(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(pk, data)`` as stored rows: a text column for each name, and which of them are set."""
    return rows.select(
        F.col("pk").alias("_pk"),
        *(F.col("data")[c].alias(c) for c in columns),
        F.map_keys("data").alias("_set"),
        F.lit(False).alias(REMOVED),
    )


def dim_table(spark: SparkSession, root: str, sink_table: str) -> KeyedTable:
    """A dimension table whose stored columns are its own; each column has its newest set value."""

    def merge(rows: DataFrame) -> DataFrame:
        columns = [c for c in rows.columns if not c.startswith("_")]
        values = F.create_map(*(x for c in columns for x in (F.lit(c), F.col(c))))
        data = F.map_filter(values, lambda k, v: F.array_contains("_set", k))
        open_rows = rows.select(F.col("_pk").alias("pk"), F.col("_part").alias("version"), data.alias("data"))
        merged = _typed(merged_dim_rows(open_rows, ["pk"]), columns)
        return merged.withColumns({"_part": F.lit(0)})

    return KeyedTable(spark, f"{root}/{sink_table}", ["_pk"], merge=merge)


_INNER = (
    T.StructField("_pk", T.StringType()),
    T.StructField("_set", T.ArrayType(T.StringType())),
)


def ensure_dim_table(spark: SparkSession, root: str, rule: Mapping[str, str]) -> T.StructType:
    """Make a table with the rule's columns, or add the columns that it does not have yet.

    Gives the columns as they are stored. Old rows have nulls in an added column.
    """
    return _with_columns(spark, root, rule["sink_table"], dim_schema(rule).names).schema()


def _with_columns(spark: SparkSession, root: str, sink_table: str, columns: Sequence[str]) -> KeyedTable:
    table = dim_table(spark, root, sink_table)
    fields = [T.StructField(name, T.StringType()) for name in columns]
    table.create(T.StructType([_INNER[0], *fields, _INNER[1]]))
    return table


def write_dim_routed(root: str, version: str = "ts") -> BatchWriter:
    """Upsert each routed record into the table it names.

    The last value per (table, key, column) of the batch is kept, cut on the map side first, and
    written once for all tables; from there each table that the batch touches takes its rows, under
    its own columns. Columns that a table does not have yet are added. Records without a key go to the
    folder ``_keyless``, which table reads pass over.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        rows = dim_rows(df, version)
        staged = f"{root}/_staged"
        merged = merged_dim_rows(rows.where("pk IS NOT NULL"))
        write_routed(staged, "sink_table")(merged, batch_id)
        keyless = rows.where("pk IS NULL")
        keyless.write.mode("overwrite").parquet(_batch_path(f"{root}/_keyless", batch_id))
        here = _batch_path(staged, batch_id)
        touched = [n.partition("=")[2] for n in files.names(spark, here) if n.startswith("sink_table=")]
        if touched:
            # What a batch sets is few names for each table.
            found = spark.read.parquet(here).select("sink_table", F.explode(F.map_keys("data"))).distinct()
            columns: dict[str, list[str]] = {}
            for sink_table, name in found.collect():
                columns.setdefault(sink_table, []).append(name)
            for sink_table, names in sorted(columns.items()):
                table = _with_columns(spark, root, sink_table, sorted(names))
                part = spark.read.parquet(here).where(F.col("sink_table") == sink_table)
                shown = [f.name for f in table.schema().fields]
                table.write(_typed(part, shown), batch_id, unique=True)
        files.remove(spark, here)

    return write


def read_dim(spark: SparkSession, root: str, rule: Mapping[str, str]) -> DataFrame:
    """The current rows of one dimension table, with the columns of the rule.

    A column that the table does not have is null.
    """
    rows = dim_table(spark, root, rule["sink_table"]).read()
    return rows.select(
        *(F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in dim_schema(rule).names)
    )
