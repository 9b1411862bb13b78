"""From raw documents to a training mix: five stages, each one of the text operators.

Every stage takes and returns the columns of ``documents``; its result is written as Parquet to the
shared folder and read again by the next one. The last stage adds how many words the mix takes.
Null texts, null ids, repeated rows and empty tables are handled as the operators say; columns that
``documents`` has besides ``doc_id, text, lang, source, n_chars`` are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import leaks, mixing, quality, repeats, simhash
from tidemart.llm.tables import remove, scratch
from tidemart.session import scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are more likely than not of the lowest grade."""
    ratings = quality.grades_of(_table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, ratings, least_grade=1, least_tail=0.5)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group whose fingerprints of three-word shingles link at 3 bits."""
    return simhash.keep_one(docs, words=3, max_bits=3)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out what lies in 200-byte strings that start at two or more places.

    Whole characters only; ``n_chars`` follows the text. A document that is cut as a whole stays as
    an empty text; a null text stays null.
    """
    return repeats.replace_texts(docs, length=200)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of a benchmark item."""
    return leaks.without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``taken``, the words that the mix takes of each document, and drops those it leaves out."""
    weights = mixing.quality_weights(_table(spark, sf_dir, "labels"))
    return mixing.with_taken(docs, quality=weights).filter("taken > 0")


STAGES = [
    ("quality classifier", good),
    ("simhash near-duplicates", distinct),
    ("repeated strings", unrepeated),
    ("benchmark decontamination", clean),
    ("source mixing", mixed),
]

#: Learned scores, XXH64 fingerprints and byte strings are beyond the SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. What a stage wrote besides its result goes when the result is stored, and so does
    the result of the stage before."""
    docs, before = _table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark):
            made = stage(spark, docs, sf_dir)
            path = scratch_dir(spark, name.replace(" ", "-"))
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
