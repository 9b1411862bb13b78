"""App-log jobs: splitting, daily visitors, jumps. Tables and streams take the same calls."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.operators import visits
from tidemart.operators.applog import DIRTY, open_records, opened_lines, route_open
from tidemart.operators.changes import split_valid_json
from tidemart.schemas import APP_LOG
from tidemart.sinks.writers import BatchWriter, write_routed


def valid_logs(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Log records with a visitor id, and all other lines."""
    return split_valid_json(lines, APP_LOG, column, required=("common.mid", "ts"))


def _by_kind(on_table: Callable, on_stream: str) -> Callable:
    def run(df: DataFrame, *args, **kwargs) -> DataFrame:
        if not df.isStreaming:
            return on_table(df, *args, **kwargs)
        from tidemart.streaming import visits as streaming

        return getattr(streaming, on_stream)(df, *args, **kwargs)

    return run


repair_is_new = _by_kind(visits.repair_is_new, "repair_is_new_stream")
unique_visitor_detail = _by_kind(visits.unique_visitor, "unique_visitor_stream")
user_jump_detail = _by_kind(visits.user_jump, "user_jump_stream")


def base_log(lines: DataFrame, tz: str = "UTC", column: str = "value") -> tuple[DataFrame, DataFrame]:
    """All log lines as routed records ``(kind, value)``, and the dirty lines.

    ``lines`` has ``seq``, the position of a line in its source, next to the text. Records keep
    all their fields.
    """
    logs, dirty = open_records(lines, column)
    return route_open(repair_is_new(logs, tz)), dirty


def log_kinds(lines: DataFrame, tz: str = "UTC", column: str = "value") -> DataFrame:
    """All log lines as ``(kind, value)``: the five kinds of records, and dirty lines as a sixth.

    One frame for one writer: a table is read twice, once for the first visits and once for
    everything else, and each line is opened once there.
    """
    if lines.isStreaming:
        routed, dirty = base_log(lines, tz, column)
        return routed.unionByName(dirty.select(F.lit(DIRTY).alias("kind"), F.col(column).alias("value")))
    opened = opened_lines(lines, column)
    return route_open(visits.repair_is_new(opened, tz), dirty=column)


def write_base_log(path: str) -> BatchWriter:
    """The record kinds of a batch, and its dirty lines, to a folder each in one job."""
    return write_routed(path, "kind")


def page_records(values: DataFrame) -> DataFrame:
    """Page records read back from their text, as later jobs take them."""
    schema = [f for f in APP_LOG.fields if f.name in ("common", "page", "ts")]
    from pyspark.sql import types as T

    rest = [c for c in values.columns if c not in ("value", "kind")]
    parsed = values.select(F.from_json("value", T.StructType(schema)).alias("r"), *rest)
    return parsed.select("r.*", *rest)
