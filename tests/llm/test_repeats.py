"""Repeated byte strings against a count of every window."""

import random
from collections import Counter

import numpy as np
import pytest

from tidemart.llm import repeats


def brute(data, length):
    texts = [(i, (t or "").encode()) for i, t in data]
    count = Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, raw in texts:
        gone = np.zeros(len(raw), dtype=bool)
        for k in range(len(raw) - length + 1):
            if count[raw[k : k + length]] > 1:
                gone[k : k + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]).astype(int)))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        out.append((i, spans, bytes(np.frombuffer(raw, np.uint8)[~gone])))
    return sorted(out, key=repr)


def found(df, **options):
    made = repeats.remove_repeats(df, **options).collect()
    return sorted(
        ((r["doc_id"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in made),
        key=repr,
    )


def documents(seed):
    rng = random.Random(seed)
    words = ["the", "of", "é", "abc", "hello", "wörld", "foo", "ab"]

    def text(n):
        return " ".join(rng.choice(words) + rng.choice("xyz") for _ in range(n))

    base = [text(60) for _ in range(10)]
    data = []
    for i in range(100):
        parts = [rng.choice(base) if rng.random() < 0.4 else text(rng.randint(1, 60)) for _ in range(3)]
        joined = " ".join(parts[: rng.randint(0, 3)])
        if rng.random() < 0.3 and joined:
            at = rng.randrange(len(joined))
            joined = joined[:at] + "Q" + joined[at + 1 :]
        data.append((i, joined))
    data += [(1000, None), (None, base[0]), (1001, "a" * 1000), (1002, "a" * 150), data[5]]
    return data + [(5, base[3] + " x " + base[4]), (1003, base[1] * 3), (1004, "b" * 199), (1005, "")]


@pytest.mark.parametrize("block", [repeats.BLOCK, 8])
def test_against_every_window(spark, monkeypatch, block):
    """Blocks of 8 make anchors with more pieces than a block, whose classes meet by digest."""
    monkeypatch.setattr(repeats, "BLOCK", block)
    data = documents(block)
    df = spark.createDataFrame([(*r, "s") for r in data], "doc_id long, text string, th string")
    assert found(df) == brute(data, 200)


def test_a_text_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 1000)
    rng = random.Random(7)
    long = "".join(rng.choice("abcdef ") for _ in range(5000))
    data = [(1, long + "|" + long[1500:2500]), (2, "zz" + long[900:1300])]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert found(df) == brute(data, 200)


@pytest.mark.parametrize("length", [20, 50])
def test_other_lengths(spark, length):
    data = documents(length)[:40]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert found(df, length=length) == brute(data, length)


def test_whole_characters():
    raw = "aé€b".encode()
    assert repeats.whole_characters(raw, [(0, 2)]) == [(0, 1)]
    assert repeats.whole_characters(raw, [(1, 6)]) == [(1, 6)]
    for a in range(len(raw) + 1):
        for b in range(a, len(raw) + 1):
            for s, e in repeats.whole_characters(raw, [(a, b)]):
                assert a <= s < e <= b
                (raw[:s] + raw[e:]).decode()


def test_replaced_texts(spark):
    shared = "é" * 150
    data = [(1, "a" + shared + "b", 9), (2, "c" + shared + "d", 9), (3, None, None), (4, "plain", 5)]
    df = spark.createDataFrame(data, "doc_id long, text string, n_chars long")
    made = {r["doc_id"]: (r["text"], r["n_chars"]) for r in repeats.replace_texts(df).collect()}
    assert made == {1: ("ab", 2), 2: ("cd", 2), 3: (None, None), 4: ("plain", 5)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    assert repeats.remove_repeats(empty).count() == 0
    assert repeats.replace_texts(empty).count() == 0
