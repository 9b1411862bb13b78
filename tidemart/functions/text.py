"""Keyword splitting with built-in functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BREAK = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-case words of the whole text, in order, without empty ones."""
    return F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != "")


def explode_keywords(
    df: DataFrame,
    text: str = "item",
    word: str = "word",
    tokenizer: Callable[[Column], Column] = words,
) -> DataFrame:
    """One row per word in place of the text column.

    ``tokenizer`` maps the text column to an array column, so a segmenter for another script
    can be supplied. Where it gives NULL for a text, that text itself is the word.
    """
    rest = [c for c in df.columns if c != text]
    tokens = F.coalesce(tokenizer(F.col(text)), F.array(F.col(text)))
    return df.where(F.col(text).isNotNull()).select(*rest, F.explode(tokens).alias(word))
