"""Joins of facts with facts, with time bounds where the inputs are streams, and lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.values import all_of, slice_start


def lookup_entries(dictionary: DataFrame) -> DataFrame:
    """The code and name of a dictionary, to be used in several lookups.

    No hint: the planner goes by the size of the stored table, and AQE by the size it meets.
    """
    return dictionary.select("dic_code", "dic_name")


def lookup_join(
    facts: DataFrame,
    entries: DataFrame,
    code: str,
    name_as: str,
    how: str = "inner",
) -> DataFrame:
    """Add the dictionary name of ``code``. Facts without an entry are dropped (inner).

    ``entries`` is a dictionary, or what ``lookup_entries`` made of it.
    """
    named = entries.select(
        F.col("dic_code").alias("_dic_code"), F.col("dic_name").alias(name_as)
    )
    return facts.join(named, F.col(code) == F.col("_dic_code"), how).drop("_dic_code")


def timed_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "inner",
    times: tuple[str, str] | None = None,
    within: str | None = None,
) -> DataFrame:
    """Equi-join on column pairs; ``within`` bounds the distance of the two event times.

    Tables need no bound. Streams need one, with watermarks on both sides, so that join state
    can be dropped. Column names of the sides must differ.
    """
    same = [left[a] == right[b] for a, b in on]
    if within is not None:
        bound = F.expr(f"INTERVAL {within}")
        lt, rt = left[times[0]], right[times[1]]
        same += [rt >= lt - bound, rt <= lt + bound]
    return left.join(right, all_of(same), how)


inner_stream_join = partial(timed_join, how="inner")
left_stream_join = partial(timed_join, how="left")
right_stream_join = partial(timed_join, how="right")
full_stream_join = partial(timed_join, how="full")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    times: tuple[str, str],
    lower_ms: int = -5000,
    upper_ms: int = 5000,
) -> DataFrame:
    """Pairs with equal key and ``right time - left time`` in [lower, upper], ends included.

    Time slices join the equality keys: a left row lies in one slice and a right row is copied
    to the one or two slices its partners can lie in. So a busy key is spread over many tasks
    and only neighbours in time are compared; every pair is found exactly once.
    """
    left_time, right_time = times
    width = max(2 * (upper_ms - lower_ms), 1000) * 1000
    left_us, right_us = F.unix_micros(F.col(left_time)), F.unix_micros(F.col(right_time))
    first = slice_start(right_us - F.lit(upper_ms * 1000), width)
    last = slice_start(right_us - F.lit(lower_ms * 1000), width)
    sliced_left = left.withColumn("_slice", slice_start(left_us, width))
    sliced_right = right.withColumnRenamed(key, "_key").withColumn(
        "_slice_r", F.explode(F.sequence(first, last, F.lit(width).cast("bigint")))
    )
    lt, rt = F.col(left_time), F.col(right_time)
    same = (
        (F.col(key) == F.col("_key"))
        & (F.col("_slice") == F.col("_slice_r"))
        & (rt >= lt + F.expr(f"INTERVAL {lower_ms / 1000:f} SECONDS"))
        & (rt <= lt + F.expr(f"INTERVAL {upper_ms / 1000:f} SECONDS"))
    )
    return sliced_left.join(sliced_right, same, "inner").drop("_slice", "_slice_r", "_key")
