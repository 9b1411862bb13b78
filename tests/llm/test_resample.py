"""Weights, draw and ranks against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from conftest import rows

from tidemart.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def feats(text, longest):
    lower = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lower)
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, targets, longest=1, buckets=10_000, seed=2024, least=20, percent=10):
    """``(id, features, weight, score, rank)`` of each (id, text)."""
    bucket = lambda f: crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in feats(t, longest)[1])
    t = Counter(bucket(f) for x in targets for f in feats(x, longest)[1])
    every, wanted = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * float(every + buckets) / ((s[b] + 1) * float(wanted + buckets))))

    out = []
    for doc_id, text in docs:
        words, found = feats(text, longest)
        weight = sum(gain(bucket(f)) for f in found)
        name = f"{seed}:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, len(words)])
    enough = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0], r[1], r[2]))
    for rank, r in enumerate(enough[: len(enough) * percent // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


def sample(count, seed=1, ids=lambda i: i):
    rng = random.Random(seed)
    words = "Alpha beta GAMMA délta e1 f-g日本 über x_y 0 9z the of and".split()
    docs = [(ids(i), " ".join(rng.choices(words, k=rng.choice([0, 3, 19, 20, 25, 60])))) for i in range(count)]
    return docs, [" ".join(rng.choices(words[:4], k=30)) for _ in range(20)]


def run(spark, docs, targets, kind="long", **options):
    made = spark.createDataFrame(docs, f"doc_id {kind}, text string").repartition(5)
    aims = spark.createDataFrame([(t,) for t in targets], "text string")
    return rows(resample.resample(made, aims, **options).select("doc_id", "n_features", "weight", "score", "rank"))


@pytest.mark.parametrize("rows_a_segment", [resample.SEGMENT_ROWS, 7])
@pytest.mark.parametrize("longest", [1, 3])
def test_against_plain_python(spark, monkeypatch, rows_a_segment, longest):
    monkeypatch.setattr(resample, "SEGMENT_ROWS", rows_a_segment)
    docs, targets = sample(400)
    docs += [(1000, None), (1001, ""), (1002, "A" * 100_000 + " b" * 30_000), (None, "the " * 25), (3, "of " * 25)]
    got = run(spark, docs, targets, longest=longest, percent=60)
    assert got == brute(docs, targets, longest=longest, percent=60)


def test_a_crowd_of_equal_rows(spark, monkeypatch):
    """Rows that agree in everything, null ids among them, are dealt over segments like others."""
    monkeypatch.setattr(resample, "SEGMENT_ROWS", 20)
    docs, targets = sample(100)
    docs += [(7, "the of " * 20)] * 200 + [(None, "the of " * 20)] * 200
    assert run(spark, docs, targets, percent=75) == brute(docs, targets, percent=75)


def test_text_ids_and_few_segments(spark, monkeypatch):
    monkeypatch.setattr(resample, "SEGMENT_ROWS", 10)
    monkeypatch.setattr(resample, "SEGMENTS", 3)
    monkeypatch.setattr(resample, "RUNS", 2)
    docs, targets = sample(200, ids=lambda i: f"é{i % 90}")
    assert run(spark, docs, targets, kind="string", percent=50) == brute(docs, targets, percent=50)


def test_segments_are_of_like_size(spark, monkeypatch):
    docs = spark.range(4000).selectExpr(
        "id AS doc_id", "30L AS n_features", "0L AS weight", "(id * 7919) % 1000 AS score"
    )
    runs = resample.sorted_runs(docs.repartition(6))
    sizes = dict(runs.groupBy("place").count().selectExpr("shiftright(place, 33)", "count").groupBy(
        "shiftright(place, 33)").count().collect())
    dealt = resample.segmented(runs, resample.splitters(runs, sizes, 20))
    held = [n for _, n in dealt.groupBy("segment").count().collect()]
    assert sum(held) == 4000 and len(held) == 20 and max(held) <= 600


@pytest.mark.parametrize("docs", [[], [(1, "a b c")], [(None, None)]])
def test_nothing_to_draw(spark, docs):
    assert run(spark, docs, ["a b"]) == brute(docs, ["a b"])
    assert run(spark, docs, []) == brute(docs, [])


def test_other_columns_do_not_clash(spark):
    docs = spark.createDataFrame(
        [(i, "the of " * (i + 5), 1, 2, 3, 4, 5) for i in range(20)],
        "id long, body string, score long, rank long, place long, segment long, doc_id long",
    )
    aims = spark.createDataFrame([("the", 1)], "aim string, text int")
    got = resample.resample(docs, aims, "id", "body", "aim", percent=50)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = brute([(i, "the of " * (i + 5)) for i in range(20)], ["the"], percent=50)
    assert rows(got) == want
