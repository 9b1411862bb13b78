"""Cuts, orders and frames against plain strings, and the way back."""

import hashlib
import random

import pytest
from conftest import rows

from tidemart.llm import infill


def brute(doc_id, text, seed=1, percent=90, spm=20):
    text = text or ""
    n = len(text)
    code = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(code[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return doc_id, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def sample():
    rng = random.Random(5)
    symbols = ["a", "é", "日", "😀", "<", ">", "P", "S", "M", "<P", "S>", "\n", " "]
    texts = ["".join(rng.choices(symbols, k=rng.choice([1, 2, 5, 40, 200]))) for _ in range(300)]
    return [None, "", "x", "<", "<<", "a<P>b", "<M>", "<S", "日本" * 20_000, "<P" * 9_000, *texts]


@pytest.mark.parametrize("size", [infill.FRAME, 7, 1])
def test_against_plain_strings(spark, size):
    texts = sample() if size > 1 else [t and t[:300] for t in sample()]
    docs = [(i if i % 11 else None, t, 0, 1, "f", "x") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, "id long, body string, n int, form int, frames string, text string")
    changed = infill.transform(frame.repartition(3), "id", "body", size=size)
    want = [brute(d[0], d[1]) for d in docs]
    assert rows(infill.texts(changed).drop("frames")) == sorted(want, key=repr)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    back = infill.texts(infill.restore(changed)).select("doc_id", "text")
    assert rows(back) == sorted(((d[0], d[1] or "") for d in docs), key=repr)
    codes = infill.with_digests(changed).select("doc_id", "output_sha256", "restored_sha256")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert rows(codes) == sorted(
        ((w[0], sha(w[5]), sha(d[1] or "")) for w, d in zip(want, docs, strict=True)), key=repr
    )


def test_text_ids_repeated_rows_and_other_shares(spark):
    docs = [("a", "one two three"), ("a", "one two three"), ("b", "four"), ("日", "five")]
    frame = spark.createDataFrame(docs, "doc_id string, text string")
    got = infill.texts(infill.transform(frame, seed=9, percent=100, spm_percent=100)).drop("frames")
    assert rows(got) == sorted((brute(*d, seed=9, percent=100, spm=100) for d in docs), key=repr)


def test_no_rows(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    changed = infill.transform(frame)
    assert infill.with_digests(changed).collect() == [] and infill.restore(changed).collect() == []


def test_a_cut_opens_one_frame(monkeypatch):
    opened = []
    frames = infill.frames_of("0123456789" * 10, 10)
    real = infill.opened
    monkeypatch.setattr(infill, "opened", lambda f: opened.append(f["start"]) or real(f))
    parts = infill.section(frames, 25, 78)
    assert [n for n, _ in parts] == [5, 10, 10, 10, 10, 8] and opened == [20, 70]
    assert "".join(map(real, infill.placed(parts))) == ("0123456789" * 10)[25:78]
