"""Graded text quality by ordinal regression on hashed text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.features import (
    Adam,
    SparseRows,
    code_points,
    gram_buckets,
    map_rows,
    packed,
    sampled,
    sigmoid,
    unpacked,
)
from tidemart.llm.tables import narrow

#: Buckets of each n-gram length, as a power of two.
BITS = 12
GRAMS = (1, 2, 3)
#: Features of repetition come after those of the n-grams.
SHARES = 10
WIDTH = (len(GRAMS) << BITS) + SHARES + 1
CHUNK = 1 << 18


def _classes() -> np.ndarray:
    """ASCII letters by case and digits as one symbol each; other ASCII as it is; the rest as one."""
    table = np.arange(129, dtype=np.uint32)
    for first, last in ("az", "AZ", "09"):
        table[ord(first) : ord(last) + 1] = ord(first)
    table[128] = ord("a")
    return table


CLASSES = _classes()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of the whole text: shares of the n-grams of character classes, which tenth
    the share of different words lies in, and the share of words that repeat the one before.

    Each length's values are square roots of shares, so they have length 1 for a text of any size.
    """
    symbols = CLASSES[np.minimum(code_points(text), 128)]
    counts = np.zeros(len(GRAMS) << BITS)
    for at in range(0, len(symbols), CHUNK):
        for k, n in enumerate(GRAMS):
            found = gram_buckets(symbols[at : at + CHUNK + n - 1], n, BITS)
            counts[k << BITS : (k + 1) << BITS] += np.bincount(found, minlength=1 << BITS)
    used = np.flatnonzero(counts)
    totals = np.maximum(counts.reshape(len(GRAMS), -1).sum(axis=1), 1)
    values = np.sqrt(counts[used] / totals[used >> BITS])
    words = (text or "").lower().split()
    if not words:
        return used, values
    tenth = min(SHARES - 1, len(set(words)) * SHARES // len(words))
    again = sum(map(str.__eq__, words, words[1:])) / len(words)
    more = [len(counts) + tenth, len(counts) + SHARES]
    return np.append(used, more), np.append(values, [1.0, np.sqrt(again)])


def fit(
    rows: SparseRows,
    grades: np.ndarray,
    levels: int,
    epochs: int = 30,
    batch: int = 256,
    rate: float = 0.02,
    decay: float = 1e-5,
    seed: int = 42,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ``levels - 1`` rising thresholds: P(grade >= k) = sigmoid(w * x - threshold_k).

    Maximum likelihood of the grades; the thresholds are a first one and the logs of their gaps, so
    they cannot cross.
    """
    random = np.random.default_rng(seed)
    cuts = levels - 1
    free = np.zeros(WIDTH + cuts)
    shares = [np.clip((grades >= k).mean(), 0.01, 0.99) for k in range(1, levels)]
    start = np.maximum.accumulate(np.array([np.log((1 - s) / s) for s in shares]) + 0.01 * np.arange(cuts))
    free[WIDTH] = start[0]
    free[WIDTH + 1 :] = np.log(np.maximum(np.diff(start), 0.01))
    adam = Adam(len(free), rate)

    def thresholds() -> np.ndarray:
        return free[WIDTH] + np.concatenate([[0], np.cumsum(np.exp(free[WIDTH + 1 :]))])

    for _ in range(epochs):
        order = random.permutation(len(rows))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            place, ids, values = rows.take(chosen)
            margin = np.bincount(place, free[ids] * values, minlength=len(chosen))
            edge = np.concatenate([[-np.inf], thresholds(), [np.inf]])
            y = grades[chosen]
            # P(grade) is the difference of two tails; its slope is that of each tail over it.
            above, beyond = sigmoid(margin - edge[y]), sigmoid(margin - edge[y + 1])
            own = np.maximum(above - beyond, 1e-9)
            lower, upper = above * (1 - above) / own, beyond * (1 - beyond) / own
            gradient = np.zeros(len(free))
            slope = -(lower - upper)
            gradient[:WIDTH] = np.bincount(ids, slope[place] * values, minlength=WIDTH)
            by_cut = np.bincount(y, lower, minlength=levels)[1:] - np.bincount(y, upper, minlength=levels)[:cuts]
            gradient[WIDTH] = by_cut.sum()
            later = by_cut[::-1].cumsum()[::-1]
            gradient[WIDTH + 1 :] = later[1:] * np.exp(free[WIDTH + 1 :])
            gradient /= len(chosen)
            gradient[:WIDTH] += decay * free[:WIDTH]
            adam.step(free, gradient)
    return free[:WIDTH].copy(), thresholds()


def grades_of(labels: DataFrame) -> DataFrame:
    """``(doc_id, grade)``: 0 for bad rows, 1 for good but toxic ones, 2 for good ones."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2))
    return labels.select("doc_id", grade.alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, most: int = 8000) -> tuple[np.ndarray, np.ndarray]:
    """Fits ``(doc_id, text)`` and ``(doc_id, grade)``, grades from 0 up, on at most ``most`` rows.

    The rows are the first by a hash of the id. Of several grades of one id the lowest counts.
    """
    rated = ratings.filter("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(
        F.min("grade").cast("int").alias("grade")
    )
    ids = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id").distinct()
    # At most ``most`` ids.
    chosen = F.broadcast(sampled(rated.join(ids, "doc_id", "left_semi"), most))

    texts = docs.join(chosen, "doc_id").select("grade", "text")
    rows = map_rows(
        texts, lambda: lambda found: packed([features(t) for t in found]), "ids binary, vals binary", "grade"
    ).collect()
    # Rows come in the order of tasks; in an order of their own reruns fit the same model.
    rows.sort(key=lambda r: (r["grade"], bytes(r["ids"]), bytes(r["vals"])))
    grades = np.array([r["grade"] for r in rows], dtype=np.int64)
    levels = int(grades.max()) + 1 if len(grades) else 1
    if levels < 2:
        return np.zeros(WIDTH), np.zeros(1)
    return fit(unpacked(rows), grades, levels)


def _tails(texts: list, weights: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade >= k) for each text and each k from 1."""
    margins = np.zeros(len(texts))
    for i, text in enumerate(texts):
        ids, values = features(text)
        margins[i] = weights[ids] @ values
    return sigmoid(margins[:, None] - thresholds[None, :])


def _model(docs: DataFrame, ratings: DataFrame, least_grade: int):
    rows, grades = narrow(docs, doc_id="doc_id", text="text"), narrow(ratings, doc_id="doc_id", grade="grade")
    weights, thresholds = train(rows, grades)
    cut = min(max(least_grade, 1), len(thresholds)) - 1
    return docs.sparkSession.sparkContext.broadcast((weights, thresholds)), cut


def rate(
    docs: DataFrame,
    ratings: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_grade: int = 1,
) -> DataFrame:
    """``(doc_id, expected_grade, tail)`` for each row.

    ``expected_grade`` is the mean of the predicted grades, ``tail`` the probability of at least
    ``least_grade``: select by it. Null and empty texts have no features and get what the thresholds
    alone say. Without rated texts, or with one grade only, tails are 0.5. Repeated rows are rated as
    often as they occur; rows with a null id are rated but not learnt from. An empty table gives an
    empty result; other columns are left out.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col)
    shared, cut = _model(rows, ratings, least_grade)

    def make():
        weights, thresholds = shared.value

        def run(texts: list) -> list[pa.Array]:
            tails = _tails(texts, weights, thresholds)
            return [pa.array(tails.sum(axis=1)), pa.array(tails[:, cut].copy())]

        return run

    return map_rows(rows, make, "expected_grade double, tail double", "doc_id")


def keep_good(
    docs: DataFrame, ratings: DataFrame, least_grade: int = 1, least_tail: float = 0.5
) -> DataFrame:
    """The rows of ``docs`` whose tail probability, as in ``rate``, is at least ``least_tail``.

    Columns stay as they are; rows are judged one by one, also where they share an id.
    """
    shared, cut = _model(docs, ratings, least_grade)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, thresholds = shared.value
        for batch in batches:
            tails = _tails(batch.column("text").to_pylist(), weights, thresholds)
            yield batch.filter(pa.array(tails[:, cut] >= least_tail))

    return docs.mapInArrow(run, docs.schema)
