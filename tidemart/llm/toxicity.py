"""Toxicity by non-negative positive-unlabelled learning on hashed words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.features import (
    Adam,
    SparseRows,
    WordBuckets,
    map_rows,
    packed,
    sampled,
    sigmoid,
    unpacked,
)
from tidemart.llm.tables import narrow

BITS = 18


def _loss_slope(margin: np.ndarray) -> np.ndarray:
    """Slope of the logistic loss log(1 + exp(-margin))."""
    return -sigmoid(-margin)


def fit(
    positive: SparseRows,
    unlabelled: SparseRows,
    prior: float,
    size: int,
    steps: int = 4000,
    batch: int = 512,
    rate: float = 0.05,
    decay: float = 1e-4,
    seed: int = 42,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier from positive and unlabelled rows.

    The risk is ``prior * loss(positive as 1) + max(0, loss(unlabelled as 0) - prior * loss(positive
    as 0))``: the unlabelled rows stand for all texts, and the share of positives among them is taken
    off. Where a batch's bracket falls below 0 the model has begun to learn the unlabelled positives
    as negatives, and the step goes the other way.
    """
    random = np.random.default_rng(seed)
    # The bias comes last. It starts at the prior's log-odds, so no evidence gives the prior.
    weights = np.zeros(size + 1)
    weights[size] = np.log(prior / (1 - prior))
    adam = Adam(size + 1, rate)

    def slopes(rows: SparseRows, chosen: np.ndarray):
        place, ids, values = rows.take(chosen)
        margin = np.bincount(place, weights[ids] * values, minlength=len(chosen)) + weights[size]

        def spread(per_row: np.ndarray) -> np.ndarray:
            out = np.bincount(ids, per_row[place] * values, minlength=size + 1)
            out[size] = per_row.sum()
            return out / len(chosen)

        return margin, spread

    for _ in range(steps):
        p_margin, p_spread = slopes(positive, random.integers(len(positive), size=batch))
        u_margin, u_spread = slopes(unlabelled, random.integers(len(unlabelled), size=batch))
        negative_risk = np.logaddexp(0, u_margin).mean() - prior * np.logaddexp(0, p_margin).mean()
        negative = u_spread(-_loss_slope(-u_margin)) - prior * p_spread(-_loss_slope(-p_margin))
        if negative_risk >= 0:
            gradient = prior * p_spread(_loss_slope(p_margin)) + negative
        else:
            gradient = -negative
        gradient[:size] += decay * weights[:size]
        adam.step(weights, gradient)
    return weights[:size], float(weights[size])


def cut_off(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """The margin from which on a text should count as toxic, from margins of rows that were not
    fitted.

    With p and u the shares of the positive and unlabelled rows above a margin, recall is p and
    precision ``prior * p / u``; the margin with the best harmonic mean of the two is taken, in the
    middle of its gap.
    """
    order = np.unique(positive)
    recall = 1 - np.searchsorted(np.sort(positive), order) / len(positive)
    above = 1 - np.searchsorted(np.sort(unlabelled), order) / len(unlabelled)
    best = order[np.argmax(2 * prior * recall / (prior + above))]
    below = np.concatenate([positive[positive < best], unlabelled[unlabelled < best], [best - 1]])
    return float((best + below.max()) / 2)


def train(
    docs: DataFrame,
    labels: DataFrame,
    most_positive: int = 2500,
    most_unlabelled: int = 5000,
    least_lift: float = 4.0,
    prior: float | None = None,
    threshold: float = 0.7,
) -> tuple[np.ndarray, float]:
    """Weights and bias from ``(doc_id, text)`` and ``(doc_id, toxic)``.

    Positives are texts marked toxic; the unlabelled rows are drawn from all texts, whatever their
    mark says. Of each at most so many are taken, first by a hash of the id: this bounds what the
    driver gets. One row in four sets the cut-off (see ``cut_off``), the others are fitted. The
    prior is the share of toxic among the marked rows, or 0.1 if no row is marked as clean. Weights
    belong to words that are in more positives than their share of the unlabelled texts lets expect,
    by at least ``least_lift`` standard deviations: a word that does not say "toxic" says nothing.
    """
    marked = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")
    )
    if prior is None:
        shares = marked.agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).first()
        share = (shares["toxic"] or 0) / max(1, shares["n"])
        prior = share if 0 < share < 1 else 0.1
    positive_ids = marked.filter("toxic = 1").select("doc_id")
    ids = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id").distinct()
    chosen = sampled(ids.join(positive_ids, "doc_id", "left_semi"), most_positive).withColumn(
        "positive", F.lit(True)
    ).union(
        sampled(ids, most_unlabelled).withColumn("positive", F.lit(False))
    )
    # At most most_positive + most_unlabelled ids.
    texts = docs.join(F.broadcast(chosen), "doc_id").select("positive", "text")

    def make():
        words = WordBuckets(BITS)

        return lambda found: packed([words(t) for t in found])

    rows = map_rows(texts, make, "ids binary, vals binary", "positive").collect()
    groups = [unpacked([r for r in rows if r["positive"] == own]) for own in (True, False)]
    nothing = np.zeros(1 << BITS), float(np.log(prior / (1 - prior)))
    fitted = [g.rows(np.flatnonzero(np.arange(len(g)) % 4 > 0)) for g in groups]
    if not all(map(len, fitted)):
        return nothing
    seen, usual = (np.bincount(g.ids, minlength=1 << BITS) for g in fitted)
    expected = (usual + 1) / (len(fitted[1]) + 1) * len(fitted[0])
    wanted = seen >= expected + least_lift * np.sqrt(expected)
    weights = np.zeros(1 << BITS)
    used = [g.only(wanted) for g in fitted]
    weights[wanted], bias = fit(*used, prior, int(wanted.sum()))
    margins = []
    for group in groups:
        place, ids, values = group.take(np.arange(0, len(group), 4))
        margins.append(bias + np.bincount(place, weights[ids] * values, minlength=-(-len(group) // 4)))
    return weights, bias - cut_off(*margins, prior) + float(np.log(threshold / (1 - threshold)))


def score(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.7,
) -> DataFrame:
    """``(doc_id, score, predicted)`` for each row: the probability that the whole text is toxic.

    Learns from the rows where ``learn`` holds (all by default; an expression over ``doc_id``), of
    ``docs`` as well as of ``labels``. The score depends on the share that each word has in the text. Null and
    empty texts score the bias alone. Without positives, or without other texts, every row scores the
    prior. Repeated rows are scored as often as they occur; rows with a null id are scored but not
    learnt from; a score of ``threshold`` is the cut-off. Of several marks of one id the highest counts. An empty table gives an empty result;
    other columns are left out.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col)
    marks = narrow(labels, doc_id="doc_id", toxic="toxic")
    if learn is not None:
        weights, bias = train(rows.filter(learn), marks.filter(learn), threshold=threshold)
    else:
        weights, bias = train(rows, marks, threshold=threshold)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        words, own = WordBuckets(BITS), shared.value

        def run(texts: list) -> list[pa.Array]:
            sums = np.full(len(texts), bias)
            for i, text in enumerate(texts):
                ids, shares = words(text)
                sums[i] += own[ids] @ shares
            scores = sigmoid(sums)
            return [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]

        return run

    return map_rows(rows, make, "score double, predicted int", "doc_id")
