"""Hashed text features, bounded training samples, and sums over sparse rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LETTERS = regex.compile(r"\p{L}+")
#: Words remembered with their hash before a task starts over.
REMEMBERED = 1 << 19


class WordBuckets:
    """Words (runs of letters, lower case) and first parts of longer ones as hash buckets.

    Frequent words are hashed once.
    """

    def __init__(self, bits: int, part: int = 5):
        self.shift, self.part = 64 - bits, part
        self.known: dict[str, tuple[int, int]] = {}

    def _pair(self, word: str) -> tuple[int, int]:
        own = xxhash.xxh3_64_intdigest(word) >> self.shift
        if len(word) <= self.part:
            return own, -1
        return own, xxhash.xxh3_64_intdigest("^" + word[: self.part]) >> self.shift

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the whole text and the share of its words that each has, in per cent.

        A bucket may come several times.
        """
        counts = Counter(LETTERS.findall((text or "").lower()))
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for word in counts:
            if word not in known:
                known[word] = self._pair(word)
        pairs = np.array([known[w] for w in counts], dtype=np.int64).reshape(-1, 2)
        times = np.fromiter(counts.values(), dtype=np.float64, count=len(counts))
        shares = 100 * times / max(1.0, times.sum())
        longer = pairs[:, 1] >= 0
        ids = np.concatenate([pairs[:, 0], pairs[longer, 1]])
        return ids, np.concatenate([shares, shares[longer]])


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def gram_buckets(symbols: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Hash buckets of all runs of ``n`` symbols."""
    if len(symbols) < n:
        return np.zeros(0, dtype=np.int64)
    wide = symbols.astype(np.uint64)
    mixed = np.full(len(symbols) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        mixed += wide[k : len(wide) - n + 1 + k]
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits)).astype(np.int64)


class SparseRows:
    """Rows of (bucket, value) pairs, laid end to end."""

    def __init__(self, ids: list[np.ndarray], values: list[np.ndarray] | None = None):
        self.lengths = np.array([len(i) for i in ids], dtype=np.int64)
        self.ids = np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int32)
        self.values = (
            np.ones(len(self.ids), dtype=np.float32)
            if values is None
            else np.concatenate([np.zeros(0, np.float32), *values]).astype(np.float32)
        )
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])

    def __len__(self) -> int:
        return len(self.lengths)

    def only(self, wanted: np.ndarray) -> SparseRows:
        """The pairs of the wanted buckets, which are numbered anew from 0."""
        out = SparseRows([])
        keep = wanted[self.ids]
        row = np.repeat(np.arange(len(self)), self.lengths)[keep]
        out.ids, out.values = (np.cumsum(wanted) - 1)[self.ids[keep]], self.values[keep]
        out.lengths = np.bincount(row, minlength=len(self))
        out.starts = np.concatenate([[0], np.cumsum(out.lengths)])
        return out

    def rows(self, chosen: np.ndarray) -> SparseRows:
        out = SparseRows([])
        _, out.ids, out.values = self.take(chosen)
        out.lengths = self.lengths[chosen]
        out.starts = np.concatenate([[0], np.cumsum(out.lengths)])
        return out

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``rows``, bucket, value) of the chosen rows' pairs."""
        lengths = self.lengths[rows]
        place = np.repeat(np.arange(len(rows)), lengths)
        first = np.repeat(self.starts[rows] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        at = np.arange(len(place)) + first
        return place, self.ids[at], self.values[at]


def packed(rows: list[tuple[np.ndarray, np.ndarray]]) -> list[pa.Array]:
    """(buckets, values) of each row as bytes: eight bytes a pair on the way to the driver.

    A bucket that comes several times in a row comes once, with the sum.
    """
    rows = [(np.unique(ids, return_inverse=True), values) for ids, values in rows]
    rows = [(ids, np.bincount(place, values, minlength=len(ids))) for (ids, place), values in rows]
    return [
        pa.array([ids.astype("<i4").tobytes() for ids, _ in rows], pa.binary()),
        pa.array([values.astype("<f4").tobytes() for _, values in rows], pa.binary()),
    ]


def unpacked(rows: list) -> SparseRows:
    ids = [np.frombuffer(r["ids"], dtype="<i4") for r in rows]
    return SparseRows(ids, [np.frombuffer(r["vals"], dtype="<f4") for r in rows])


class Adam:
    """Steps of a size that follows each weight's own gradients."""

    def __init__(self, size: int, rate: float):
        self.rate, self.time = rate, 0
        self.mean, self.square = np.zeros(size), np.zeros(size)

    def step(self, weights: np.ndarray, gradient: np.ndarray) -> None:
        self.time += 1
        self.mean += 0.1 * (gradient - self.mean)
        self.square += 0.001 * (gradient * gradient - self.square)
        scaled = self.mean / (1 - 0.9**self.time)
        spread = np.sqrt(self.square / (1 - 0.999**self.time)) + 1e-8
        weights -= self.rate * scaled / spread


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def sampled(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` of the rows of ``(doc_id, ...)``: those first by a hash of the id."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def map_rows(
    docs: DataFrame, make: Callable[[], Callable[[list], list[pa.Array]]], schema: str, *keep: str
) -> DataFrame:
    """Keeps the named columns and adds those that ``make()(texts)`` returns for each batch."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            made = work(batch.column("text").to_pylist())
            arrays = [batch.column(k) for k in keep] + made
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *names])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    kept = [f"{k} {kinds[k]}" for k in keep]
    return docs.select(*keep, "text").mapInArrow(run, ", ".join([*kept, schema]))


def held_out(column: str, divisor: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % divisor == remainder
