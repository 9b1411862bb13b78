"""Tumbling-window summaries. Sums and counts combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.times import window_bounds
from tidemart.operators.changes import union_streams

#: Buckets that the words of a window are dealt to in a stream: a bucket's words are one row of state.
WORD_BUCKETS = 32
#: Rows of a task that are counted together before they are dealt.
COMBINED_ROWS = 1 << 17

MEASURES = ("uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct")
TRAFFIC_KEYS = ("vc", "ch", "ar", "is_new")


def search_filter(page_map: DataFrame) -> DataFrame:
    """Page records reached from a search for a keyword; ``page`` is a map."""
    page = F.col("page")
    return page_map.where(
        (page["last_page_id"] == "search")
        & (page["item_type"] == "keyword")
        & page["item"].isNotNull()
    )


def _counted_in_chunks(words: DataFrame, schema: T.StructType) -> DataFrame:
    """``(rt, word)`` -> ``(rt, word, n)``, summed in chunks of a task: a busy word is a row of each chunk."""

    def counted(chunk: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        counts = pa.Table.from_batches(chunk).group_by(["rt", "word"]).aggregate([([], "count_all")])
        return counts.rename_columns(["rt", "word", "n"]).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= COMBINED_ROWS:
                yield from counted(held)
                held = []
        if held:
            yield from counted(held)

    return words.mapInArrow(run, T.StructType([*schema.fields, T.StructField("n", T.LongType())]))


def _window_words(keywords: DataFrame, size: str, tz: str) -> DataFrame:
    """``(stt, edt, word, keyword_count)`` of a stream.

    A word of a window would be written, looked up and removed as a row of state of its own. So words
    are counted in chunks, the state keeps the counts of a window in buckets of words, and a bucket's
    counts are summed when its window is given: they are sorted, and each word is a run of them.
    """
    # The start of a window lies in that window; the field's own metadata keeps the watermark.
    thin = keywords.select(F.window("rt", size)["start"].alias("rt"), "word")
    counts = _counted_in_chunks(thin, T.StructType([keywords.schema["rt"], keywords.schema["word"]]))
    bucket = F.pmod(F.xxhash64("word"), F.lit(WORD_BUCKETS)).cast("int").alias("bucket")
    lists = counts.groupBy(F.window("rt", size), bucket).agg(F.collect_list(F.struct("word", "n")).alias("words"))
    # Generators are evaluated once per row; a projection would be copied into each place that looks at it.
    bounds = lists.select(*window_bounds("window", tz), "words")
    in_order = bounds.select("stt", "edt", F.explode(F.array(F.sort_array("words"))).alias("words"))

    def opens(i: Column) -> Column:
        return (i == 0) | ~F.get("words", i)["word"].eqNullSafe(F.get("words", i - 1)["word"])

    starts = F.filter(F.sequence(F.lit(0), F.size("words") - 1), opens)
    runs = in_order.select("stt", "edt", "words", F.explode(F.array(starts)).alias("starts"))

    def run(start: Column, i: Column) -> Column:
        length = F.coalesce(F.get("starts", i + 1), F.size("words")) - start
        total = F.aggregate(F.slice("words", start + 1, length), F.lit(0).cast("bigint"), lambda n, w: n + w["n"])
        first = F.get("words", start)
        return F.struct(
            first["word"].alias("word"), F.when(length == 1, first["n"]).otherwise(total).alias("keyword_count")
        )

    return runs.select("stt", "edt", F.inline(F.transform("starts", run)))


def keyword_window_count(
    keywords: DataFrame,
    size: str = "10 seconds",
    source: str = "search",
    tz: str = "UTC",
) -> DataFrame:
    """Rows ``(word, rt)`` counted per word and window."""
    if keywords.isStreaming:
        counts = _window_words(keywords, size, tz)
    else:
        counts = keywords.groupBy(F.window("rt", size), "word").agg(
            F.count(F.lit(1)).alias("keyword_count")
        ).select(*window_bounds("window", tz), "word", "keyword_count")
    return counts.select(
        "stt",
        "edt",
        F.lit(source).alias("source"),
        F.col("word").alias("keyword"),
        "keyword_count",
    )


def _measures(rows: DataFrame, **given) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return rows.select(
        F.timestamp_millis("ts").alias("et"),
        *[F.col(f"common.{k}").alias(k) for k in TRAFFIC_KEYS],
        *[given.get(m, zero).cast("bigint").alias(m) for m in MEASURES],
    )


def traffic_measures(pages: DataFrame, visitors: DataFrame, jumps: DataFrame) -> DataFrame:
    """Page, daily visitor and jump records as one table of measures."""
    one = F.lit(1)
    is_start = F.col("page.last_page_id").isNull()
    return union_streams(
        _measures(visitors, uv_ct=one),
        _measures(jumps, uj_ct=one),
        _measures(
            pages,
            pv_ct=one,
            sv_ct=F.when(is_start, 1).otherwise(0),
            dur_sum=F.col("page.during_time"),
        ),
    )


def traffic_window_sum(
    measures: DataFrame, size: str = "10 seconds", tz: str = "UTC"
) -> DataFrame:
    sums = measures.groupBy(F.window("et", size), *TRAFFIC_KEYS).agg(
        *[F.sum(m).alias(m) for m in MEASURES]
    )
    return sums.select(*window_bounds("window", tz), *TRAFFIC_KEYS, *MEASURES)
