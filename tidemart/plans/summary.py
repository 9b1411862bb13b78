"""Window summaries of keywords and traffic. Event-time delays apply to streams only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.text import explode_keywords, words
from tidemart.functions.times import row_time
from tidemart.operators.summaries import (
    keyword_window_count,
    search_filter,
    traffic_measures,
    traffic_window_sum,
)

KEYWORD_DELAY = "2 seconds"
# A jump comes up to 10 s (timeout) + 2 s (its own delay) late; 2 s more for this job.
TRAFFIC_DELAY = "14 seconds"


def keyword_page_view_window(
    page_map: DataFrame,
    size: str = "10 seconds",
    delay: str = KEYWORD_DELAY,
    tokenizer=words,
    tz: str = "UTC",
) -> DataFrame:
    """Searched words counted per window. ``page_map`` has ``page`` (a map) and ``ts``."""
    timed = page_map.withColumn("rt", row_time("ts"))
    if timed.isStreaming:
        timed = timed.withWatermark("rt", delay)
    items = search_filter(timed).select(F.col("page")["item"].alias("item"), "rt")
    return keyword_window_count(explode_keywords(items, tokenizer=tokenizer), size, tz=tz)


def traffic_page_view_window(
    pages: DataFrame,
    visitors: DataFrame,
    jumps: DataFrame,
    size: str = "10 seconds",
    delay: str = TRAFFIC_DELAY,
    tz: str = "UTC",
) -> DataFrame:
    measures = traffic_measures(pages, visitors, jumps)
    if measures.isStreaming:
        measures = measures.withWatermark("et", delay)
    return traffic_window_sum(measures, size, tz)
