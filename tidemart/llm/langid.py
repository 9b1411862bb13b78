"""Language of a text by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.features import LETTERS, code_points, gram_buckets, map_rows
from tidemart.llm.tables import narrow

#: Buckets of each n-gram length, as a power of two.
BITS = 14
GRAMS = (1, 2, 3)
WIDTH = len(GRAMS) << BITS
#: Code points whose n-grams are looked up at once.
CHUNK = 1 << 18
UNKNOWN = "und"


def buckets(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of the whole text in lower case, in pieces of bounded size."""
    points = code_points((text or "").lower())
    for at in range(0, len(points), CHUNK):
        for k, n in enumerate(GRAMS):
            # The piece's last n-grams reach into the next one.
            yield gram_buckets(points[at : at + CHUNK + n - 1], n, BITS) + (k << BITS)


def gram_counts(docs: DataFrame) -> DataFrame:
    """``(lang, text)`` -> ``(lang, bucket, n)``; bucket -1 counts the texts.

    Each task adds up its rows before anything is shuffled: a language that most rows have costs no
    more than a rare one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                own = sums.setdefault(lang.as_py(), np.zeros(WIDTH + 1, dtype=np.int64))
                own[WIDTH] += 1
                for part in buckets(text.as_py()):
                    own[:WIDTH] += np.bincount(part, minlength=WIDTH)
        for lang, own in sums.items():
            used = np.flatnonzero(own)
            place = np.where(used == WIDTH, -1, used).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used)), pa.array(place), pa.array(own[used])],
                names=["lang", "bucket", "n"],
            )

    parts = docs.select("lang", "text").mapInArrow(run, "lang string, bucket int, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, smoothing: float = 0.5) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log priors, and log-probabilities (bucket, language) of ``(lang, text)`` rows.

    All rows count. What comes to the driver is one number for each bucket and language:
    ``WIDTH`` times the number of languages at most, however many rows there are.
    """
    counts = gram_counts(docs.filter("lang IS NOT NULL AND text IS NOT NULL")).toPandas()
    langs = sorted(counts["lang"].unique().tolist())
    table = np.zeros((WIDTH + 1, max(1, len(langs))))
    place = {lang: i for i, lang in enumerate(langs)}
    if langs:
        table[counts["bucket"].to_numpy(), counts["lang"].map(place).to_numpy()] = counts["n"]
    prior = np.log(np.maximum(table[WIDTH], 1) / max(1, table[WIDTH].sum()))
    table = table[:WIDTH] + smoothing
    for k in range(len(GRAMS)):
        block = table[k << BITS : (k + 1) << BITS]
        block /= block.sum(axis=0)
    return langs, prior, np.log(table).astype(np.float32)


def identify(
    docs: DataFrame,
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for each row.

    Learns from all rows where ``learn`` holds (all rows by default; an expression over the id under
    the name ``doc_id``) that have a text and a language. The log-probabilities, one float for each
    bucket and language, are broadcast; a batch is scored by gathering the rows of its n-grams.
    ``score`` is the posterior probability of ``lang_pred``. Ties go to the language first by code
    point. ``lang_pred`` is ``und`` with score 0 where the text is null, empty or without a letter,
    and everywhere if there is nothing to learn from. Repeated rows count as often as they occur;
    null ids are kept. An empty table gives an empty result; other columns are left out.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col, lang=lang_col)
    langs, prior, table = train(rows if learn is None else rows.filter(learn))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def make():
        logs = shared.value

        def score(texts: list) -> list[pa.Array]:
            best, sure = [], []
            for text in texts:
                if not langs or text is None or not LETTERS.search(text):
                    best.append(UNKNOWN)
                    sure.append(0.0)
                    continue
                sums = prior.copy()
                for part in buckets(text):
                    sums += logs[part].sum(axis=0, dtype=np.float64)
                odds = np.exp(sums - sums.max())
                k = int(np.argmax(odds))
                best.append(langs[k])
                sure.append(float(odds[k] / odds.sum()))
            return [pa.array(best, pa.string()), pa.array(sure, pa.float64())]

        return score

    return map_rows(rows, make, "lang_pred string, score double", "doc_id")
