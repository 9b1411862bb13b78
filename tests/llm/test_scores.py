"""Learned scores: held-out accuracy, the estimators themselves, and odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.llm import langid, quality, toxicity
from tidemart.llm.features import Adam, SparseRows, WordBuckets, held_out, packed, unpacked

SYLLABLES = {"aa": "ka lo mi ru", "bb": "xen tor vik sul", "cc": "éa öu ñi çe"}


def texts(seed=1, count=240):
    """(doc_id, text, lang, toxic, quality): bad words, and shouting as bad quality."""
    rng = random.Random(seed)
    out = []
    for i in range(count):
        lang = rng.choice(sorted(SYLLABLES))
        parts = SYLLABLES[lang].split()
        words = ["".join(rng.choices(parts, k=3)) for _ in range(rng.randint(15, 60))]
        toxic, bad = rng.random() < 0.25, rng.random() < 0.25
        if toxic:
            for at in range(0, len(words), 8):
                words[at] = rng.choice(["vilething", "badthing"])
        text = " ".join(words)
        out.append((i, "!! ".join(text.upper().split()) if bad else text, lang, int(toxic), int(not bad)))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    data = texts()
    odd = [(9001, None, "aa"), (9002, "", "bb"), (None, data[0][1], "aa"), (9003, "12 34 !", None), data[1][:3]]
    docs = spark.createDataFrame([(*r[:3], "x") for r in data] + [(*r, "y") for r in odd], "doc_id long, text string, lang string, score string")
    labels = spark.createDataFrame([(r[0], r[4], r[3]) for r in data[:180]] + [(None, 1, 1), (5000, 1, 1)], "doc_id long, quality int, toxic int")
    return data, docs, labels


def test_toxicity(spark, tables):
    data, docs, labels = tables
    apart = held_out("doc_id", 3, 1)
    made = toxicity.score(docs, labels, learn=~apart).select("doc_id", "score", "predicted", apart.alias("apart")).collect()
    assert len(made) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in made)
    truth = {r[0]: r[3] for r in data}
    rest = [(truth[r["doc_id"]], r["predicted"]) for r in made if r["apart"] and r["doc_id"] in truth]
    assert sum(a == b for a, b in rest) >= 0.9 * len(rest) > 0
    empty = {r["doc_id"]: r["predicted"] for r in made if r["doc_id"] in (9001, 9002)}
    assert empty == {9001: 0, 9002: 0}


def test_toxicity_learns_only_from_its_rows(spark, tables):
    """Labels of held-out rows change nothing."""
    _, docs, labels = tables
    apart = held_out("doc_id", 3, 1)
    turned = labels.withColumn("toxic", (1 - labels.toxic * apart.cast("int")) * labels.toxic)
    one = toxicity.score(docs, labels, learn=~apart).select("score").toPandas()["score"]
    two = toxicity.score(docs, turned, learn=~apart).select("score").toPandas()["score"]
    assert sorted(one) == sorted(two)


def test_toxicity_without_labels(spark, tables):
    _, docs, labels = tables
    made = toxicity.score(docs, labels.limit(0)).collect()
    assert {round(r["score"], 6) for r in made} == {0.1}
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_positive_unlabelled_risk_finds_hidden_positives():
    """Positives hidden among the unlabelled rows are scored as positives."""
    rng = np.random.default_rng(3)
    sign = lambda k: np.array([k], dtype=np.int64)
    positive = SparseRows([sign(0)] * 300)
    hidden = rng.random(1000) < 0.3
    unlabelled = SparseRows([sign(0) if h else sign(1) for h in hidden])
    weights, bias = toxicity.fit(positive, unlabelled, 0.3, 2, steps=1500)
    assert weights[0] + bias > 0 > weights[1] + bias


def plain_adam(size, rate):
    mean, square, time = [0.0] * size, [0.0] * size, [0]

    def step(weights, gradient):
        time[0] += 1
        for k, g in enumerate(gradient):
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.999 * square[k] + 0.001 * g * g
            first, second = mean[k] / (1 - 0.9 ** time[0]), square[k] / (1 - 0.999 ** time[0])
            weights[k] -= rate * first / (math.sqrt(second) + 1e-8)

    return step


def loss(margin):
    return math.log1p(math.exp(-margin))


def test_non_negative_risk_is_brute_force():
    """Risk, clipping and gradient by plain loops and by differences, over the same draws."""
    rng = np.random.default_rng(8)
    size, prior, batch, steps, decay = 6, 0.4, 12, 60, 1e-4

    def drawn(count, heavy):
        ids = [rng.choice(size, size=3, replace=False, p=heavy) for _ in range(count)]
        return SparseRows(ids, [rng.random(3) + 0.5 for _ in ids])

    positive = drawn(9, [0.4, 0.3, 0.1, 0.1, 0.05, 0.05])
    unlabelled = drawn(30, [0.2, 0.2, 0.15, 0.15, 0.15, 0.15])
    weights, bias = toxicity.fit(positive, unlabelled, prior, size, steps=steps, batch=batch, decay=decay)

    random_, plain = np.random.default_rng(42), [0.0] * size + [math.log(prior / (1 - prior))]
    step, branches = plain_adam(size + 1, 0.05), set()

    def row(rows, i):
        a, b = rows.starts[i], rows.starts[i + 1]
        return list(zip(rows.ids[a:b].tolist(), rows.values[a:b].tolist(), strict=True)) + [(size, 1.0)]

    def risks(w, p, u):
        margin = lambda r: sum(w[k] * v for k, v in r)
        as_one = sum(loss(margin(r)) for r in p) / len(p)
        as_zero = sum(loss(-margin(r)) for r in p) / len(p)
        rest = sum(loss(-margin(r)) for r in u) / len(u)
        return prior * as_one, rest - prior * as_zero

    for n in range(steps):
        p = [row(positive, i) for i in random_.integers(len(positive), size=batch)]
        u = [row(unlabelled, i) for i in random_.integers(len(unlabelled), size=batch)]
        gain, bracket = risks(plain, p, u)
        branches.add(bracket >= 0)
        objective = (lambda w, p=p, u=u: sum(risks(w, p, u))) if bracket >= 0 else (lambda w, p=p, u=u: -risks(w, p, u)[1])
        gradient = []
        for k in range(size + 1):
            up, down = list(plain), list(plain)
            up[k] += 1e-5
            down[k] -= 1e-5
            gradient.append((objective(up) - objective(down)) / 2e-5 + (decay * plain[k] if k < size else 0))
        step(plain, gradient)
    assert branches == {True, False}
    assert np.allclose([*weights, bias], plain, atol=2e-4)


def test_a_very_long_text_is_scored_as_a_whole(spark, tables):
    """What counts is the share of words in all of the text, its end included."""
    _, docs, labels = tables
    calm = "kalomi lokaru miruka " * 40_000
    more = spark.createDataFrame([(1, calm), (2, calm + "vilething badthing " * 40_000)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(more.selectExpr("doc_id + 70000 AS doc_id", "text"))
    apart = F.col("doc_id") > 70_000
    made = toxicity.score(both, labels, learn=~apart).filter(apart).collect()
    assert {r["doc_id"] - 70_000: r["predicted"] for r in made} == {1: 0, 2: 1}


def test_quality(spark, tables):
    data, docs, labels = tables
    ratings = quality.grades_of(labels)
    made = quality.rate(docs, ratings).collect()
    assert len(made) == docs.count()
    truth = {r[0]: r[4] for r in data[180:]}
    rest = [(truth[r["doc_id"]], r["tail"] >= 0.5) for r in made if r["doc_id"] in truth]
    assert all(a == b for a, b in rest) and len(rest) == 60
    assert all(0 <= r["tail"] <= r["expected_grade"] + 1e-9 <= 2 for r in made)
    kept = quality.keep_good(docs, ratings)
    assert kept.columns == docs.columns
    wanted = sorted(str(r["doc_id"]) for r in made if r["tail"] >= 0.5)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == wanted
    assert {r["tail"] for r in quality.rate(docs, ratings.limit(0)).collect()} == {0.5}
    assert quality.rate(docs.limit(0), ratings).count() == 0


def test_ordinal_regression_recovers_thresholds():
    """Grades drawn from the model itself, from one feature."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=6000)
    cuts = np.array([-1.0, 0.5, 2.0])
    tails = 1 / (1 + np.exp(-(1.5 * x[:, None] - cuts)))
    grades = (rng.random(6000)[:, None] < tails).sum(axis=1)
    rows = SparseRows([np.array([7])] * 6000, [np.array([v]) for v in x])
    weights, found = quality.fit(rows, grades, 4, epochs=20)
    assert abs(weights[7] - 1.5) < 0.15 and np.abs(found - cuts).max() < 0.2
    assert (np.diff(found) > 0).all()


def test_grades_are_brute_force(spark, tables):
    """Tails and expected grades by the plain formula from the fitted weights and thresholds, and the
    fit's likelihood is at a maximum in every threshold."""
    _, docs, labels = tables
    ratings = quality.grades_of(labels)
    weights, thresholds = quality.train(docs.select("doc_id", "text"), ratings)
    for least in (1, 2):
        made = quality.rate(docs, ratings, least_grade=least).collect()
        texts_of = {}
        for r in docs.select("doc_id", "text").collect():
            texts_of.setdefault(r["doc_id"], []).append(r["text"])
        for r in made:
            wanted = []
            for text in texts_of[r["doc_id"]]:
                ids, values = quality.features(text)
                margin = sum(float(weights[i]) * float(v) for i, v in zip(ids, values, strict=True))
                tails = [1 / (1 + math.exp(t - margin)) for t in thresholds]
                shares = [a - b for a, b in zip([1.0, *tails], [*tails, 0.0], strict=True)]
                wanted.append((sum(g * p for g, p in enumerate(shares)), sum(shares[least:])))
            assert any(
                math.isclose(r["expected_grade"], e, abs_tol=1e-9) and math.isclose(r["tail"], t, abs_tol=1e-9)
                for e, t in wanted
            )


def test_ordinal_gradient_is_brute_force():
    """One step of the fit goes where differences of the plain likelihood point."""
    rng = np.random.default_rng(6)
    x, grades = rng.normal(size=40), rng.integers(0, 4, size=40)
    rows = SparseRows([np.array([7])] * 40, [np.array([v]) for v in x])
    rate, shares = 0.02, [np.clip((grades >= k).mean(), 0.01, 0.99) for k in (1, 2, 3)]
    start = [math.log((1 - s) / s) for s in shares]
    start = [v + 0.01 * k for k, v in enumerate(start)]
    free = [0.0, start[0], *(math.log(max(b - a, 0.01)) for a, b in zip(start, start[1:], strict=False))]

    def cost(free):
        edges = [free[1]]
        for gap in free[2:]:
            edges.append(edges[-1] + math.exp(gap))
        out = 0.0
        for v, y in zip(rows.values.tolist(), grades, strict=True):
            tails = [1.0, *(1 / (1 + math.exp(e - free[0] * v)) for e in edges), 0.0]
            out -= math.log(tails[y] - tails[y + 1])
        return out / len(grades)

    slope = []
    for k in range(len(free)):
        up, down = list(free), list(free)
        up[k] += 1e-6
        down[k] -= 1e-6
        slope.append((cost(up) - cost(down)) / 2e-6)
    plain_adam(len(free), rate)(free, slope)
    edges = np.cumsum([free[1], *map(math.exp, free[2:])])
    weights, found = quality.fit(rows, grades, 4, epochs=1, batch=40, rate=rate, decay=0.0)
    assert math.isclose(weights[7], free[0], abs_tol=1e-5) and np.allclose(found, edges, atol=1e-5)


def test_language(spark, tables):
    data, docs, _ = tables
    apart = held_out("doc_id", 4, 2)
    made = langid.identify(docs, learn=~apart).select("doc_id", "lang_pred", "score", apart.alias("apart")).collect()
    assert len(made) == docs.count()
    truth = {r[0]: r[2] for r in data}
    rest = [(truth[r["doc_id"]], r["lang_pred"]) for r in made if r["apart"] and r["doc_id"] in truth]
    assert all(a == b for a, b in rest) and rest
    odd = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in made if r["doc_id"] in (9001, 9002, 9003)}
    assert set(odd.values()) == {("und", 0.0)}
    nothing = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}
    assert langid.identify(docs.limit(0)).count() == 0


def test_language_model_is_naive_bayes(spark):
    """Posterior of a short text, counted by hand."""
    docs = spark.createDataFrame([(1, "ab", "x"), (2, "ba", "y"), (3, "bb", "y")], "doc_id long, text string, lang string")
    langs, prior, table = langid.train(docs)
    assert langs == ["x", "y"] and np.allclose(np.exp(prior), [1 / 3, 2 / 3])
    parts = np.concatenate(list(langid.buckets("ab")))
    sums = prior + table[parts].sum(axis=0)
    size = 1 << langid.BITS
    one = {"x": [1.5 * 1.5, 2], "y": [1.5 * 3.5, 4]}
    by_hand = []
    for i, lang in enumerate(langs):
        p = (1 / 3 if lang == "x" else 2 / 3) * one[lang][0] / (one[lang][1] + size / 2) ** 2
        by_hand.append(math.log(p * (1.5 if lang == "x" else 0.5) / ((1 if lang == "x" else 2) + size / 2)))
    assert np.allclose(np.diff(sums), np.diff(by_hand), atol=1e-4)


def test_texts_in_pieces(monkeypatch):
    text = "".join(random.Random(4).choices("abcdé ", k=1000))
    whole = np.sort(np.concatenate(list(langid.buckets(text))))
    features = quality.features(text)
    monkeypatch.setattr(langid, "CHUNK", 64)
    monkeypatch.setattr(quality, "CHUNK", 64)
    assert (np.sort(np.concatenate(list(langid.buckets(text)))) == whole).all()
    assert all(np.allclose(a, b) for a, b in zip(quality.features(text), features, strict=True))


def test_sparse_rows():
    rows = SparseRows([np.array([3, 5]), np.array([], dtype=int), np.array([5])])
    kept = rows.only(np.array([False] * 5 + [True]))
    assert kept.lengths.tolist() == [1, 0, 1] and kept.ids.tolist() == [0, 0]
    place, ids, _ = rows.take(np.array([2, 0]))
    assert place.tolist() == [0, 1, 1] and ids.tolist() == [5, 3, 5]
    ids, shares = WordBuckets(18)("One one TWO")
    sums = packed([(np.array([4, 2, 4]), np.array([1.0, 2.0, 3.0]))])
    back = unpacked([{"ids": sums[0][0].as_py(), "vals": sums[1][0].as_py()}])
    assert back.ids.tolist() == [2, 4] and back.values.tolist() == [2.0, 4.0]
    assert len(ids) == 2 and math.isclose(shares.sum(), 100)
    weights = np.ones(2)
    Adam(2, 0.1).step(weights, np.array([1.0, -1.0]))
    assert np.allclose(weights, [0.9, 1.1])
