"""Intermediate tables in the shared folder, and column names that cannot clash with a caller's."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import scratch_dir

#: What counts as a word in the size and fingerprint contracts.
WORD = "[^\\x20\\x09-\\x0D]+"


#: The tables written inside the innermost ``scratch`` block, of each such block.
_blocks: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that operators wrote inside the block when it ends well.

    What is read from them must have been written elsewhere by then. After a failure they stay.
    """
    _blocks.append([])
    try:
        yield
        for path in _blocks[-1]:
            remove(spark, path)
    finally:
        _blocks.pop()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it back.

    The lineage ends there, so a lost executor costs the tasks at hand and not the whole history.
    """
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    if _blocks:
        _blocks[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Removes a table that ``stored_at`` wrote and nothing reads any more."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under fixed names: ``narrow(df, doc_id="id")``.

    Everything else, whatever it is called, stays out of the way of an operator's own columns.
    """
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))


def crc_remainder(column: str, divisor: int):
    """crc32 of an id as text, modulo ``divisor``; a null id counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % divisor).cast("int")


def join_split(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Joins on whole-number ``keys`` so that AQE can split a hot one.

    After a grouping by the same keys Spark would join where the groups already lie, and such a
    partition is never split. Under another value of the key both sides are dealt out for the join.
    """
    last = keys[-1]
    mine = left.withColumn("_dealt", F.bitwise_not(last))
    other = right.withColumn("_dealt", F.bitwise_not(last)).drop(last)
    return mine.join(other, [*keys[:-1], "_dealt"], how).drop("_dealt")
