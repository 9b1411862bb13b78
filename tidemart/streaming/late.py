"""Rows that come when their window is closed, as an output of their own."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.sinks import files


def late_aside(
    write: Callable[[DataFrame, int], None],
    late_path: str,
    state_path: str,
    time: str = "et",
    size: str = "10 seconds",
    delay_ms: int = 2000,
) -> Callable[[DataFrame, int], None]:
    """Batch writer: rows whose window is closed go to ``late_path``, all others to ``write``.

    A windowed sum drops rows without a trace when their window ends at or before the watermark: the
    newest time of all micro-batches before, less the delay. This writer keeps the same watermark (one
    small file for each micro-batch in ``state_path``) and takes those rows aside first, with the
    ``watermark`` that closed their window; what it passes on is never late for a sum with the same size
    and delay. A micro-batch that runs again finds the watermark it had. Rows without a time pass.
    """

    def run(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        names = [n for n in files.names(spark, state_path) if n.endswith(".json")]
        before = [n for n in names if int(n.partition(".")[0]) < batch_id]
        newest = json.loads(files.read_text(spark, f"{state_path}/{max(before)}")) if before else None
        df = df.persist()
        mark = F.lit(None if newest is None else newest - delay_ms).cast("bigint")
        closed = F.unix_millis(F.window(time, size)["end"]) <= mark
        # A window column is made by an expansion of the rows: no two of them in one filter.
        marked = df.withColumn("_closed", F.coalesce(closed, F.lit(False)))
        rest = marked.where("NOT _closed").drop("_closed")
        if df.schema[time].nullable:
            rest = rest.unionByName(df.where(F.col(time).isNull()))
        late = marked.where("_closed").drop("_closed").withColumn("watermark", F.timestamp_millis(mark))
        late.write.mode("overwrite").parquet(f"{late_path}/batch_id={batch_id}")
        write(rest, batch_id)
        here = df.agg(F.max(F.unix_millis(time))).first()[0]
        known = [x for x in (newest, here) if x is not None]
        if known:
            target = f"{state_path}/{batch_id:012d}.json"
            files.remove(spark, target)
            files.write_text(spark, target, json.dumps(max(known)))
        for name in sorted(before)[:-1]:
            files.remove(spark, f"{state_path}/{name}")
        df.unpersist()

    return run
