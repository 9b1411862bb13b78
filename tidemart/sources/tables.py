"""Reading message streams, change feeds, rules, dictionaries and text lines.

A source is a data frame, bounded or streaming, with one text column ``value``. The parsers
below take any such frame, so the same job runs on files, on tables and on a message queue.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.operators.changes import MESSAGE, split_valid_json
from tidemart.schemas import CHANGE_RECORD, CONFIG_RECORD, DICTIONARY


def kafka_source_options(servers: str, topic: str, per_trigger: int | None = None) -> dict[str, str]:
    """Options of Spark's Kafka source; consumed positions live in the stream's checkpoint."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def read_stream_raw(
    spark: SparkSession,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    schema: T.StructType | str | None = None,
    path: str | None = None,
    positions: bool = False,
) -> DataFrame:
    """A stream of message texts in column ``value``; a message without a body is NULL.

    ``positions`` adds the place of a message in its source as ``position``: partition and offset of a
    queue, or time, file and row of a Parquet file. It orders changes of the same second.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    stream = reader.load(path) if path else reader.load()
    text = F.col("value").cast("string").alias("value")
    if not positions:
        return stream.select(text)
    files = ("_metadata.file_modification_time", "_metadata.file_path", "_metadata.row_index")
    place = ("partition", "offset") if fmt == "kafka" else files
    return stream.select(text, F.struct(*place).alias("position"))


def read_json_table(messages: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Messages as typed rows; texts that are no JSON objects are left out (see ``dirty_messages``)."""
    valid, _ = split_valid_json(messages, schema, column)
    return valid


def dirty_messages(messages: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """The texts that ``read_json_table`` leaves out, for an output of their own."""
    _, dirty = split_valid_json(messages, schema, column)
    return dirty


def read_change_feed(messages: DataFrame, column: str = "value", keep_message: bool = False) -> DataFrame:
    """Change records with ``pt`` (time of reading) and ``et`` (time of the change).

    ``keep_message`` keeps the text as ``_message``, by which ``cdc_filter`` passes over the messages of
    other tables before they are parsed; for jobs that take several tables out of one feed.
    """
    if keep_message:
        messages = messages.withColumn(MESSAGE, F.col(column))
    return with_times(read_json_table(messages, CHANGE_RECORD, column))


def with_times(feed: DataFrame) -> DataFrame:
    et = F.timestamp_seconds(F.col("ts").try_cast("bigint"))
    return feed.withColumn("pt", F.current_timestamp()).withColumn("et", et)


def read_config_cdc(messages: DataFrame, column: str = "value") -> DataFrame:
    """Routing-rule changes as ``before``, ``after``, ``op``, ``ts_ms``."""
    return read_json_table(messages, CONFIG_RECORD, column)


def read_lookup(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    jdbc: Mapping[str, str] | None = None,
    schema: T.StructType = DICTIONARY,
) -> DataFrame:
    """The dictionary as a table. A stream sees its changes through ``runner.with_lookups``."""
    if jdbc is not None:
        return spark.read.format("jdbc").options(**jdbc).load().select(*schema.names)
    return spark.read.format(fmt).schema(schema).load(path)


def read_csv_lines(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Comma-separated lines as typed columns; a part of a wrong form is NULL."""
    parts = F.split(F.col(column), ",")
    return lines.select(
        *[
            F.get(parts, i).try_cast(f.dataType).alias(f.name)
            for i, f in enumerate(schema.fields)
        ]
    )
