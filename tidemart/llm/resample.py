"""Importance resampling of documents towards a target collection, with exact ranks.

Weights: hashed word runs are counted over both collections; a document's weight is the sum of its
features' log ratios, looked up in an array. Draw: Gumbel noise by id, then the highest scores.
Ranks: parallel sorting by regular sampling. Locally sorted runs give regular samples, these the
splitters; each segment between two splitters is exchanged to one task, merged there, and the sizes
of the segments before it make its ranks exact.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.tables import narrow, stored

#: Everything but digits, letters and bytes of characters beyond ASCII becomes a space; A-Z lower case.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: Different features remembered in a task before it starts over.
REMEMBERED = 1 << 19
#: At most so many sorted runs, and so many segments, each of which takes a sample from each run: the
#: driver holds RUNS x SEGMENTS short rows at most, whatever the number of documents.
RUNS, SEGMENTS = 512, 512
#: Rows of a segment while there are fewer than SEGMENTS of them.
SEGMENT_ROWS = 4096


def features(raw: bytes, longest: int) -> tuple[list[bytes], int]:
    """All runs of 1 to ``longest`` consecutive words, joined by a space, and the number of words."""
    words = raw.translate(_PLAIN).split()
    found = words
    for n in range(2, longest + 1):
        found = found + [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    return found, len(words)


def counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket.

    Every task adds up an array of its own, so at most ``buckets`` rows leave it, and as many reach
    the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        seen: Counter[bytes] = Counter()

        def add() -> None:
            at = np.fromiter((crc32(f) % buckets for f in seen), dtype=np.int64, count=len(seen))
            np.add.at(total, at, np.fromiter(seen.values(), dtype=np.int64, count=len(seen)))
            seen.clear()

        for batch in batches:
            for text in batch.column("text").cast(pa.binary()):
                seen.update(features(text.as_py() or b"", longest)[0])
                if len(seen) > REMEMBERED:
                    add()
        add()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    made = texts.select("text").mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in made.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares in target and source, rounded down."""
    buckets = len(source)
    over, under = float(source.sum() + buckets), float(target.sum() + buckets)
    ratios = zip(target.tolist(), source.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1) * over / ((s + 1) * under))) for t, s in ratios])


class Gains(dict):
    """Feature -> gain, looked up in the array when it comes first."""

    def __init__(self, table: np.ndarray):
        super().__init__()
        self.table = table.tolist()

    def __missing__(self, feature: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[feature] = self.table[crc32(feature) % len(self.table)]
        return value


def weighed(texts: DataFrame, table: np.ndarray, longest: int) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, n_words, n_features, weight)``."""
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Gains(shared.value)
        for batch in batches:
            rows = []
            for text in batch.column("text").cast(pa.binary()):
                found, words = features(text.as_py() or b"", longest)
                rows.append((words, len(found), sum(map(known.__getitem__, found))))
            cells = zip(*rows, strict=True) if rows else ([], [], [])
            arrays = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cells)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_features", "weight"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_features long, weight long"
    )


def noise(seed: int):
    """Gumbel noise in thousandths, from the id's hash."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


#: The order of the draw; ``place`` makes equal rows differ, so that a crowd of them is cut as well.
KEY = ("score", "doc_id", "n_features", "weight", "place")


def _key(row) -> tuple:
    score, doc_id, n, weight, place = row
    return -score, doc_id is None, doc_id, n, weight, place


def _order() -> list[Column]:
    """``_key`` as Spark sorts."""
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]


def sorted_runs(rows: DataFrame) -> DataFrame:
    """Each partition sorted, and written so; ``place`` is its number and the row's place in it."""
    runs = rows.coalesce(RUNS).sortWithinPartitions(*_order())
    return stored(runs.withColumn("place", F.monotonically_increasing_id()), "runs")


def splitters(runs: DataFrame, sizes: dict[int, int], segments: int) -> list[tuple]:
    """The keys that part the rows into ``segments`` of about the same size.

    Each run gives up to ``segments`` regular samples. A sample stands for the rows between it and the
    next one; so a segment has at most the rows it should have and two sample steps of each run.
    """
    steps = {run: max(1, size // segments) for run, size in sizes.items()}
    spark = runs.sparkSession
    frame = spark.createDataFrame(list(steps.items()), "run long, step long")
    run, at = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    found = (
        runs.withColumns({"run": run, "at": at})
        .join(F.broadcast(frame), "run")
        .filter("at % step = step div 2")
        .select(*KEY, "step")
        .collect()
    )
    sample = sorted((_key(row[:-1]), row[-1]) for row in found)
    whole = sum(step for _, step in sample)
    out, passed = [], 0
    for key, step in sample:
        passed += step
        if passed * segments >= (len(out) + 1) * whole and len(out) < segments - 1:
            out.append(key)
    return out


def segmented(runs: DataFrame, cuts: list[tuple]) -> DataFrame:
    """Adds ``segment``: how many splitters lie before the row."""
    shared = runs.sparkSession.sparkContext.broadcast(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in KEY), strict=True)
            found = [bisect_right(shared.value, _key(key)) for key in keys]
            arrays = [*batch.columns, pa.array(found, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "segment"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema.fields)
    return runs.mapInArrow(run, f"{fields}, segment int")


def merged(dealt: DataFrame, before: list[int], drawn: int) -> DataFrame:
    """Rows of a segment come to one task, are merged there and take the ranks behind ``before``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken: dict[int, int] = {}
        for batch in batches:
            ranks = []
            for segment in batch.column("segment").to_pylist():
                taken[segment] = taken.get(segment, before[segment]) + 1
                ranks.append(taken[segment] if taken[segment] <= drawn else None)
            arrays = [*batch.columns, pa.array(ranks, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "rank"])

    together = dealt.repartitionById(len(before), F.col("segment"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)
    return together.sortWithinPartitions("segment", *_order(), "place").mapInArrow(run, f"{fields}, rank long")


def resample(
    docs: DataFrame,
    targets: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    longest: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    least_words: int = 20,
    percent: int = 10,
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` for each row.

    Texts are cut into words of ASCII letters and digits and of any characters beyond ASCII, A-Z in
    lower case; features are all runs of 1 to ``longest`` words, repeats counted, in ``buckets``
    buckets by crc32. ``weight`` sums the gains of a row's features (see ``gains``), ``score`` adds
    Gumbel noise. Of the rows with ``least_words`` words, ``percent`` in a hundred (rounded down) with
    the highest scores are drawn; ``rank`` counts them from 1, ties by smaller id, and is null for all
    others.

    Counts cover all rows of both tables. The driver holds two arrays of ``buckets`` numbers, the
    samples (RUNS x SEGMENTS at most) and the sizes of the segments. Only segments that hold drawn
    rows are exchanged. A null text has no features, weight 0, and is not drawn; so is an empty one.
    A null id draws its noise as an empty one and comes after all others at the same score. Rows that
    repeat an id all count and can all be drawn; among equal scores and ids the one with fewer features,
    then the smaller weight, comes first. Empty tables: without documents an empty result, without
    targets all shares are those of the smoothing. Other columns are left out.
    """
    texts = narrow(docs, doc_id=id_col, text=text_col)
    source, target = (counts(t, longest, buckets) for t in (texts, narrow(targets, text=target_col)))
    rows = weighed(texts, gains(source, target), longest).withColumn("score", F.col("weight") + noise(seed))
    scored = stored(rows, "scored")
    columns = ["doc_id", "n_features", "weight", "score"]
    enough = F.col("n_words") >= least_words
    runs = sorted_runs(scored.filter(enough).select(*columns))
    sizes = dict(runs.groupBy(F.shiftright("place", 33)).count().collect())
    total = sum(sizes.values())
    drawn = total * percent // 100
    unranked = F.lit(None).cast("long").alias("rank")
    if not drawn:
        return scored.select(*columns, unranked)
    segments = min(SEGMENTS, -(-total // SEGMENT_ROWS))
    dealt = stored(segmented(runs, splitters(runs, sizes, segments)), "segments")
    held = dict(dealt.groupBy("segment").count().collect())
    before = [0, *accumulate(held.get(s, 0) for s in range(segments))][:-1]
    last = max(s for s in range(segments) if before[s] < drawn)
    top = merged(dealt.filter(F.col("segment") <= last), before[: last + 1], drawn)
    return (
        top.select(*columns, "rank")
        .unionByName(dealt.filter(F.col("segment") > last).select(*columns, unranked))
        .unionByName(scored.filter(~enough).select(*columns, unranked))
    )


#: crc32 is built from its rule: eight shifts for each of the 256 bytes, then one look-up a byte.
SQL = r"""
WITH tab AS (SELECT list(v ORDER BY i) AS crc FROM (SELECT i, list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(256) r(i))),
w AS (SELECT doc_id, 0 AS side, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
  UNION ALL SELECT NULL, 1, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
k AS (SELECT side, doc_id, unnest(words) AS word FROM w),
f AS (SELECT side, doc_id, word, count(*) AS times FROM k GROUP BY ALL),
d AS (SELECT word, xor(list_reduce([('0x' || substr(hex(encode(word)), 2 * j + 1, 2))::BIGINT FOR j IN range(strlen(word))],
    lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM f), tab),
b AS (SELECT bucket, sum(times) FILTER (side = 0) AS s, sum(times) FILTER (side = 1) AS t FROM f JOIN d USING (word) GROUP BY bucket),
a AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM b),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (coalesce(s_all, 0) + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce(t_all, 0) + 10000)::DOUBLE)))::BIGINT AS gain FROM b, a),
v AS (SELECT doc_id, sum(times * gain) AS weight FROM f JOIN d USING (word) JOIN g USING (bucket) WHERE side = 0 GROUP BY doc_id),
e AS (SELECT w.doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    ('0x' || substr(sha256('2024:' || coalesce(w.doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM w LEFT JOIN v ON w.doc_id = v.doc_id WHERE side = 0),
o AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM e),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM o WHERE n_features >= 20)
SELECT o.doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
FROM o LEFT JOIN r ON o.doc_id = r.doc_id
"""
