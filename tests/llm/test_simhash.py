"""Fingerprints and groups against plain Python."""

import random

import numpy as np
import pytest
import xxhash
from conftest import rows

from tidemart.llm import components, simhash


def plain(text, words=3):
    found = (text or "").lower().split()
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)]
    shingles = shingles or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(values, max_bits):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("text", [None, "", "  \t\n", "one", "One TWO", "a b c", "a b c a b c a", "x " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain(text)


def test_fingerprint_of_a_long_text():
    text = " ".join(random.Random(1).choices("the of and thé word".split(), k=70_000))
    assert simhash.fingerprint(text) == plain(text)


@pytest.mark.parametrize("dense", [simhash.DENSE, 4])
def test_link_group_joins_what_pairs_join(monkeypatch, dense):
    monkeypatch.setattr(simhash, "DENSE", dense)
    rng = random.Random(dense)
    mask = (1 << 64) - 1 ^ 0x3FFFF
    values = sorted({rng.getrandbits(64) & mask | rng.getrandbits(18) for _ in range(300)})
    values = sorted({(values[0] & mask) | (v & 0x3FFFF) for v in values})
    a, b = simhash.link_group(np.array(values, dtype=np.uint64), mask, 3)
    root = dict(zip(a.tolist(), b.tolist(), strict=True))
    assert [root.get(v, v) for v in values] == [values[i] for i in groups_of(values, 3)]


def test_masks_leave_no_close_pair_apart():
    rng = random.Random(2)
    masks = simhash.block_masks((1 << 64) - 1, 3)
    for _ in range(500):
        flips = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not flips & m for m in masks)


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    found = dict(rows(components.components(spark.createDataFrame(links, "a long, b long"))))
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}
    empty = spark.createDataFrame([], "a long, b long")
    assert components.components(empty).count() == 0


def documents(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(words, k=300)) for _ in range(12)]
    texts = []
    for text in base:
        texts += [text, text.upper()]
        for _ in range(4):
            changed = text.split()
            changed[rng.randrange(300)] = "new"
            texts.append(" ".join(changed))
    texts += ["", "   ", None, "tiny", "Tiny", "two words"]
    data = [(i * 7 % 1000, t, "x") for i, t in enumerate(texts)]
    data += [(None, base[0], "x"), data[3], (data[5][0], "another text under that id", "y")]
    return spark.createDataFrame(data, "doc_id long, text string, fp string")


def test_near_duplicates(spark):
    df = documents(spark)
    data = df.collect()
    values = [plain(r["text"]) for r in data]
    root = groups_of(values, 3)
    least = {}
    for r, k in zip(data, root, strict=True):
        if r["doc_id"] is not None:
            least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    expected = [
        (r["doc_id"], f"{v:016x}", least.get(k)) for r, v, k in zip(data, values, root, strict=True)
    ]
    found = simhash.near_duplicates(df)
    found = found.select("doc_id", simhash.hexadecimal(found.fp), "component_id")
    assert rows(found) == sorted(expected, key=repr)


def test_a_crowd_of_close_fingerprints(spark, monkeypatch):
    """More than DENSE values in one bucket go the second way, with the same links."""
    monkeypatch.setattr(simhash, "DENSE", 8)
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    values = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(150)}
    values |= {rng.getrandbits(64) for _ in range(100)}
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.close_links(spark.createDataFrame(signed, "fp long"))
    found = dict(rows(components.components(links)))
    got = [found.get(v, v) for (v,) in signed]
    expected = groups_of(values, 3)
    assert len(set(zip(got, expected, strict=True))) == len(set(got)) == len(set(expected))


def test_keep_one_and_empty_tables(spark):
    df = documents(spark)
    kept = simhash.keep_one(df, words=3)
    assert kept.columns == df.columns
    groups = simhash.near_duplicates(df.filter("doc_id IS NOT NULL"))
    assert kept.filter("doc_id IS NOT NULL").count() == groups.select("component_id").distinct().count()
    assert kept.filter("doc_id IS NULL").count() == 1
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    assert simhash.keep_one(df.limit(0)).count() == 0
