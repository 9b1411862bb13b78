"""Leaks, neighbours, units, URLs and mixing against plain Python, with odd rows."""

import math
import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemart.llm import leaks, mixing, neighbours, units, urls

# Leaks


def leak_tables(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(3000)]

    def text(n):
        return rng.choices(vocabulary, k=n)

    items = [(i, " ".join(text(30))) for i in range(8)] + [(8, "only five words are here"), (9, None), (10, "")]
    docs, planted = [], set()
    for i in range(60):
        words = text(rng.randint(0, 120))
        kind = i % 4
        if kind < 3:
            item = i % 8
            passage = items[item][1].split()
            if kind == 1:  # every eighth word replaced
                passage = [f"new{k}" if k % 8 == 3 else w for k, w in enumerate(passage)]
            if kind == 2:  # a part that is too short
                passage = passage[:10]
            at = rng.randint(0, len(words))
            words = words[:at] + [w.upper() + "," for w in passage] + words[at:]
            if kind < 2:
                planted.add((i, item))
        docs.append((i, " ".join(words), "x"))
    docs += [(100, None, "x"), (101, "", "x"), (None, items[0][1], "x"), docs[0]]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, item_id string"),
        spark.createDataFrame(items, "item_id long, text string"),
        planted | {(None, 0)},
    )


@pytest.mark.parametrize("sieve", [leaks.SIEVE, 8])
def test_leaks(spark, monkeypatch, sieve):
    """Also with a sieve that lets nearly everything pass."""
    monkeypatch.setattr(leaks, "SIEVE", sieve)
    docs, items, planted = leak_tables(spark)
    found = leaks.find_leaks(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == planted
    assert all(r["share"] >= 0.8 and r["matches"] <= r["end_word"] - r["first_word"] for r in found)
    assert sum((r["doc_id"], r["item_id"]) == (0, 0) for r in found) == 2  # the row is there twice
    kept = leaks.without_leaks(docs, items)
    assert kept.columns == docs.columns
    left = [r["doc_id"] for r in kept.collect()]
    bad = {d for d, _ in planted}
    assert sorted(left) == sorted(r["doc_id"] for r in docs.collect() if r["doc_id"] not in bad)


def test_leaks_of_empty_tables(spark):
    docs, items, _ = leak_tables(spark)
    assert leaks.find_leaks(docs.limit(0), items).count() == 0
    assert leaks.find_leaks(docs, items.limit(0)).count() == 0
    assert leaks.without_leaks(docs, items.limit(0)).count() == docs.count()


def plain_leaks(docs, items):
    """Over all pairs and all diagonals; an overlap has 13 words, four fifths of them equal, or is the item."""
    out = set()
    for d, text in docs:
        words = (text or "").lower().split()
        for i, other in items:
            item = (other or "").lower().split()
            for diagonal in range(-len(item) + 1, len(words)):
                same = [0 <= k + diagonal < len(words) and words[k + diagonal] == item[k] for k in range(len(item))]
                total = [0, *np.cumsum(same).tolist()]
                inside = range(max(0, -diagonal), min(len(item), len(words) - diagonal) + 1)
                if all(same) or any(
                    b - a >= 13 and 5 * (total[b] - total[a]) >= 4 * (b - a) for a in inside for b in inside
                ):
                    out.add((d, i))
                    break
    return out


def test_items_of_any_length_against_all_pairs(spark):
    """Items of 1 to 30 words, whole, cut or with words replaced, ids of both kinds, a very long text."""
    rng = random.Random(12)
    vocabulary = [f"v{i}" for i in range(60)]
    items = [(f"i{n}-{k}", " ".join(rng.choices(vocabulary, k=n))) for n in range(1, 31) for k in range(2)]
    docs = []
    for d in range(90):
        words = rng.choices(vocabulary, k=rng.randint(0, 40))
        passage = items[rng.randrange(len(items))][1].split()
        kind = d % 3
        if kind == 1:
            passage = [f"new{k}" if rng.random() < 0.2 else w for k, w in enumerate(passage)]
        if kind == 2:
            passage = passage[rng.randint(0, 3) :]
        at = rng.randint(0, len(words))
        docs.append((f"d{d}", " ".join(words[:at] + passage + words[at:])))
    found = leaks.find_leaks(
        spark.createDataFrame([(*d, 1) for d in docs], "id string, body string, item int").repartition(3),
        spark.createDataFrame([(*i, 2) for i in items], "name string, words string, hash int"),
        "id", "body", "name", "words",
    )
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == plain_leaks(docs, items)
    long = " ".join(f"x{i}" for i in range(60_000)) + " " + items[-1][1]
    one = spark.createDataFrame([(1, long)], "doc_id long, text string")
    named = spark.createDataFrame(items, "item_id string, text string")
    [row] = leaks.find_leaks(one, named.filter("item_id = 'i30-1'")).collect()
    assert (row["first_word"], row["end_word"], row["matches"]) == (60_000, 60_030, 30)


def test_best_run_is_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        same = np.array([rng.random() < 0.6 for _ in range(rng.randint(1, 25))])
        first, end, matches = leaks.best_run(same, 4.0)
        gains = np.where(same, 1.0, -4.0)
        best = max([0.0] + [gains[a:b].sum() for a in range(len(same)) for b in range(a + 1, len(same) + 1)])
        assert math.isclose(gains[first:end].sum(), best) and matches == same[first:end].sum()


def test_every_run_that_meets_the_rule_is_found():
    rng = random.Random(3)
    for trial in range(600):
        n = rng.randint(13, 30)
        same = np.array([rng.random() < rng.choice([0.7, 0.8, 0.9]) for _ in range(n)])
        runs = [(b - a, a, b) for a in range(n) for b in range(a + 1, n + 1) if 5 * same[a:b].sum() >= 4 * (b - a)]
        longest = max([r[0] for r in runs], default=0)
        first, end, matches = leaks.longest_run(same, 0.8)
        assert end - first == longest and matches == same[first:end].sum()


@pytest.mark.parametrize("equal", [(10, 1, 2), (12, 3, 12)])
def test_overlaps_with_a_short_best_stretch(equal):
    """13 words or more, 80 % equal, although the stretch before the replaced words is shorter."""
    before, new, after = equal
    item = [f"w{i}" for i in range(before + new + after)]
    text = ["x"] * 5 + item[:before] + ["new"] * new + item[before + new :] + ["y"] * 5
    hashes = leaks.WordHashes()
    words, other = hashes(" ".join(text)), hashes(" ".join(item))
    first, end, matches = leaks.overlap(words, other, [-3, 5, 9], 13, 0.8)
    assert end - first >= 13 and 5 * matches >= 4 * (end - first)


def test_two_words_apart_share_a_seed():
    """Two replaced words in a passage of thirty leave a seed that looks at neither."""
    rng = np.random.default_rng(1)
    words = rng.integers(1, 1 << 62, size=30, dtype=np.uint64)
    for a in range(30):
        for b in range(a):
            other = words.copy()
            other[[a, b]] += np.uint64(1)
            assert any((leaks.seed_hashes(words, s) == leaks.seed_hashes(other, s)).any() for s in leaks.SEEDS)


@pytest.mark.parametrize("n", range(13, 26))
def test_a_fifth_of_the_words_apart_share_a_seed(n):
    """Whichever fifth of 13 to 25 words is replaced, a seed looks at none of them."""
    missed = np.array([sum(1 << i for i in c) for c in combinations(range(n), n // 5)])
    for seed in leaks.SEEDS:
        for at in range(n - len(seed) + 1):
            missed = missed[(missed & int(seed, 2) << at) != 0]
    assert not len(missed)


# Neighbours


def vectors(spark, count=600, dims=24):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, dims))
    made = [(i, (centres[i % 12] + 0.3 * rng.normal(size=dims)).astype(np.float32).tolist()) for i in range(count)]
    made += [(count + i, made[7][1]) for i in range(60)]  # equal vectors
    bad = [(2000, None), (2100, [0.0] * dims), (2200, [float("nan")] + [1.0] * (dims - 1)),
           (2300, [1.0] * (dims - 1) + [None]), (2400, [float("inf")] * dims), (None, made[3][1]), (2500, [1.0])]
    return made, spark.createDataFrame([(*r, 1) for r in made + bad + [made[5]]], "vec_id long, embedding array<float>, rank int")


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CHUNK", 40)
    monkeypatch.setattr(neighbours, "ASKING", 5)
    made, df = vectors(spark)
    found = neighbours.search(df, F.col("vec_id") % 20 == 0, k=10, probes=8, per_list=40).collect()
    table = np.array([v for _, v in made], dtype=np.float64)
    ids = np.array([i for i, _ in made])
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    for query, mine in got.items():
        distance = np.sqrt(((table - table[ids.tolist().index(query)]) ** 2).sum(axis=1))
        order = [k for k in np.lexsort((ids, distance)) if ids[k] != query][:10]
        assert [r for r, _, _ in mine] == list(range(1, 11)) and query not in [v for _, v, _ in mine]
        assert [(s, v) for _, v, s in mine] == sorted((s, v) for _, v, s in mine)
        assert all(math.isclose(s, distance[ids.tolist().index(v)], rel_tol=1e-12) for _, v, s in mine)
        hits += len({v for _, v, _ in mine} & {int(ids[k]) for k in order})
        total += 10
    assert hits >= 0.9 * total


def test_neighbours_in_many_lists(spark):
    """Vectors without clusters, over 200 lists, with the default number of probes."""
    rng = np.random.default_rng(5)
    table = rng.normal(size=(8400, 32))
    df = spark.createDataFrame(pd.DataFrame({"vec_id": range(len(table)), "embedding": table.tolist()}))
    found = neighbours.search(df, F.col("vec_id") % 60 == 0, k=10, per_list=40).collect()
    got = defaultdict(set)
    for r in found:
        got[r["query_id"]].add(r["vec_id"])
    hits = 0
    for query in range(0, len(table), 60):
        distance = ((table - table[query]) ** 2).sum(axis=1)
        distance[query] = np.inf
        hits += len(got[query] & set(np.argsort(distance)[:10].tolist()))
    assert hits >= 0.97 * 10 * len(got) and len(got) == 140


def test_few_and_no_vectors(spark):
    made, df = vectors(spark, 30)
    few = df.filter("vec_id < 4")
    found = neighbours.search(few, F.lit(True), k=10)
    assert rows(found.groupBy("query_id").count()) == [(i, 3) for i in range(4)]
    assert neighbours.search(df.limit(0), F.lit(True)).count() == 0
    assert neighbours.search(df.filter("vec_id >= 2000"), F.lit(True)).count() == 0


def test_odd_lengths_do_not_take_the_table_over(spark):
    """Vectors of another length than most take no part, whichever comes first by hash."""
    made, df = vectors(spark, 60)
    odd = [(3000 + i, [float(i + 1)] * (1 + i % 3), 1) for i in range(40)]
    both = df.union(spark.createDataFrame(odd, df.schema))
    want = rows(neighbours.search(df, F.col("vec_id") % 20 == 0, k=5))
    assert rows(neighbours.search(both, F.col("vec_id") % 20 == 0, k=5)) == want and len(want) == 5 * 6


def test_scan_keeps_to_a_bound():
    rng = np.random.default_rng(9)
    table, query = rng.normal(size=(500, 16)), rng.normal(size=16)
    far = ((table - query) ** 2).sum(1)
    bound = np.sort(far)[6]
    found = neighbours.scan(query, table, 10, 50.0, bound)
    assert sorted(found.tolist()) == sorted(np.flatnonzero(far <= bound).tolist())
    assert neighbours.scan(query, table[:20], 10, 2.1, 0.0).tolist() == []


# Units


@pytest.mark.parametrize("least", [1, 5])
def test_units_against_a_walk(spark, least):
    rng = random.Random(6)
    lines = [" ".join(rng.choices("aa bb cc dd ee".split(), k=rng.randint(1, 9))) for _ in range(40)]
    data = [(i, "\n".join(rng.choice([rng.choice(lines), rng.choice(lines).upper() + "  "]) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    data += [(70, None), (71, ""), (72, "\n\n")]
    df = spark.createDataFrame([(*r, 0) for r in data], "doc_id long, text string, unit int")
    seen, expected = {}, []
    for i, text in data:
        spans, kept, at = [], [], 0
        parts = (text or "").split("\n")
        for k, line in enumerate(parts):
            key = " ".join(line.lower().split())
            gone = key and len(key.split()) >= least and key in seen
            if gone:
                spans.append((k, at, at + len(line), seen[key]))
            else:
                kept.append(line)
                seen.setdefault(key, i)
            at += len(line) + 1
        expected.append((i, len(parts), spans, "\n".join(kept)))
    made = [(r["doc_id"], r["n_units"], [tuple(s) for s in r["spans"]], r["kept"]) for r in units.remove_units(df, least_words=least).collect()]
    assert sorted(made) == sorted(expected)
    assert units.remove_units(df.limit(0)).count() == 0


def test_units_of_text_ids_and_a_long_text(spark):
    """Ids of any type rank as they sort, a null one last; a text of many lines is one row."""
    long = "\n".join(f"line {i}" for i in range(30_000))
    df = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y\nline 7"), ("c", long)], "doc_id string, text string")
    made = {r["doc_id"]: ([(s["unit"], s["first_id"]) for s in r["spans"]], r["kept"]) for r in units.remove_units(df).collect()}
    assert made == {"a": ([], "x y"), "b": ([(0, "a")], ""), None: ([(0, "a"), (1, "c")], ""), "c": ([], long)}


def test_units_of_repeated_and_null_ids(spark):
    line = "one two three four five"
    df = spark.createDataFrame([(2, line), (None, line), (1, line + "\n" + line), (1, "other\n" + line)], "doc_id long, text string")
    made = units.remove_units(df).collect()
    assert sum(line in r["kept"] for r in made if r["doc_id"] in (2, None)) == 0
    assert any(r["kept"] == line for r in made if r["doc_id"] == 1)


@pytest.mark.parametrize("name", [None, 3])
def test_units_at_the_same_place_of_rows_that_share_an_id(spark, name):
    line = "one two three four five"
    df = spark.createDataFrame([(name, line), (name, line + "\nx"), (name, line + "\ny")], "doc_id long, text string")
    assert sum(line in r["kept"] for r in units.remove_units(df).collect()) == 1


# URLs


def test_rules_and_parts(spark):
    cases = [
        ("https://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
        ("http://example.net/EN/x", "example.net", "/EN/x", "net/", "block"),
        ("http://net/", "net", "/", "net/", "block"),
        ("http://bignet.com/de/", "bignet.com", "/de/", None, None),
        ("http://www.example.com/de/1", "www.example.com", "/de/1", "example.com/de/", "block"),
        ("x://w.org/fr/?a", "w.org", "/fr/", "org/fr/", "allow"),
        ("http://a.net", "a.net", "", None, None),
        ("http://a.net?x=/en/", "a.net", "", None, None),
        ("a/b://c.org/fr/", "c.org", "/fr/", "org/fr/", "allow"),
        ("no scheme", "", "", None, None),
        ("", "", "", None, None),
        (None, "", "", None, None),
    ]
    df = spark.createDataFrame([(i, c[0], "?") for i, c in enumerate(cases)], "page_id long, url string, host string")
    made = {r["page_id"]: r for r in urls.judge(df).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        r = made[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block")


def test_url_model(spark):
    """Weights add up to the log-probabilities of an interpolated model, and tell the classes apart."""
    rng = random.Random(8)
    good = [f"http://a.org/fr/{''.join(rng.choices('abc', k=6))}" for _ in range(150)]
    bad = [f"http://b.net/{''.join(rng.choices('xyz', k=6))}" for _ in range(150)]
    new = [f"http://q.com/{''.join(rng.choices(s, k=6))}" for s in ("abc", "xyz") for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(good + bad + new)), "page_id long, url string")
    made = {r["page_id"]: r["verdict"] for r in urls.judge(df).collect()}
    assert all(made[300 + i] == ("allow" if i < 20 else "block") for i in range(40))

    known = [("allow", "ab$"), ("allow", "aab$"), ("block", "b$")]
    weights = {r["gram"]: r["weight"] / urls.UNIT for r in urls.model(spark.createDataFrame(known, "said string, text string")).collect()}

    def probability(said, context, symbol):
        if context is None:
            return 1 / 32
        follow = [t[i + len(context)] for s, t in known if s == said for i in range(len(t) - len(context)) if t[i : i + len(context)] == context]
        lower = probability(said, context[1:] if context else None, symbol)
        kinds = len(set(follow))
        return (follow.count(symbol) + kinds * lower) / (len(follow) + kinds) if follow else lower

    for text in ("ab$", "ba$", "zaab$"):
        by_hand = sum(
            math.log(probability("allow", text[max(0, i - 3) : i], text[i]) / probability("block", text[max(0, i - 3) : i], text[i]))
            for i in range(len(text))
        )
        grams = [text[i : i + k] for i in range(len(text)) for k in range(1, 5) if i + k <= len(text)]
        added = sum(weights.get(g, 0) for g in grams) + len(text) * weights[""]
        assert math.isclose(added, by_hand, abs_tol=1e-4)


def test_urls_of_an_empty_table(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


# Mixing


def test_mix(spark):
    rng = random.Random(9)
    sources = ["s1", "s2", "S3", "é", None]
    data = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(sources)) for i in range(400)]
    data += [(900, None, "s1"), (901, "", None), (None, "a b c", "s2"), data[3]]
    df = spark.createDataFrame([(*r, 1) for r in data], "doc_id long, text string, source string, size int")
    made = mixing.mix(df).collect()
    assert len(made) == len(data)
    sizes = defaultdict(int)
    for _, text, source in data:
        sizes[source] += len((text or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, free, target = 1.5 * sum(sizes.values()), set(sizes), {}
    while True:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            free.remove(s)
    target |= {s: level * weight[s] for s in free}
    taken = defaultdict(int)
    for r in made:
        assert r["taken"] <= 2 * r["size"]
        taken[(r["source_size"], r["target"])] += r["taken"]
    for s in sizes:
        assert any(n == sizes[s] and math.isclose(t, target[s]) and math.floor(t) == taken[n, t] for n, t in taken)
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(str, made)) == sorted(map(str, again))


def test_epochs_come_before_the_rest(spark):
    """A document is left out only if its source is taken less than once."""
    df = spark.createDataFrame([(i, "a b c d", "big" if i < 90 else "tiny") for i in range(100)], "doc_id long, text string, source string")
    made = mixing.mix(df).collect()
    for r in made:
        epochs = int(r["target"] // r["source_size"])
        assert epochs * r["size"] <= r["taken"] <= (epochs + 1) * r["size"]


def test_weights_come_first(spark):
    df = spark.createDataFrame([(i, "w " * 10, f"s{i % 3}") for i in range(600)], "doc_id long, text string, source string")
    quality = df.select("doc_id", F.when(F.col("doc_id") < 300, 20.0).otherwise(0.05).alias("weight"))
    made = mixing.mix(df, quality=quality, share=0.3).collect()
    good = sum(r["taken"] for r in made if r["doc_id"] < 300)
    assert good > 0.9 * sum(r["taken"] for r in made)
    assert mixing.mix(df.limit(0), quality=quality).count() == 0
    assert mixing.with_taken(df).columns == [*df.columns, "taken"]
