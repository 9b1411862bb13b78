"""Finds passages of benchmark items in documents, also where some words were replaced."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.tables import narrow, stored

#: Masks over a run of words: 1 is looked at, 0 ignored. Wherever 2 of 13, 3 of 15, 4 of 20 or 5 of
#: 25 words differ, at least one mask at one place looks at none of them; longer passages with 80 %
#: equal words hold a part of 13 to 25 words that has as many.
SEEDS = ("111111", "11101011", "11001000111", "101000100111")
#: Slots of the sieve that most places of a document are turned away by, as a power of two, and how
#: many of them a hash has. Its size does not depend on the items.
SIEVE, PROBES = 24, 3
WORD = regex.compile(r"[\p{L}\p{N}]+")
REMEMBERED = 1 << 19


class WordHashes:
    """64-bit hashes of the words (runs of letters and digits, lower case) of a text."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = WORD.findall((text or "").lower())
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter((known[w] for w in words), dtype=np.uint64, count=len(words))


def seed_hashes(words: np.ndarray, seed: str) -> np.ndarray:
    """Hash of the looked-at words at each place where the mask fits."""
    n = len(words) - len(seed) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    mixed = np.full(n, xxhash.xxh3_64_intdigest(seed), dtype=np.uint64)
    for k, looked_at in enumerate(seed):
        if looked_at == "1":
            mixed = (mixed + words[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(31)
    return mixed


def masks_for(count: int) -> list[str]:
    """The masks that an item of so many words is looked up by; one with fewer words than the shortest
    seed as a whole."""
    shortest = min(map(len, SEEDS))
    return list(SEEDS) if count >= shortest else ["1" * count] if count else []


def slots(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The PROBES slots of each hash: its upper bits, after mixing again for each further one."""
    for _ in range(PROBES):
        yield (hashes >> np.uint64(64 - bits)).view(np.int64)
        hashes = (hashes ^ hashes >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)


def passing(hashes: np.ndarray, sieve: np.ndarray) -> np.ndarray:
    """Places of the hashes whose slots are all set."""
    bits = len(sieve).bit_length() - 1
    # The first slot turns nearly all away.
    at = np.flatnonzero(sieve[next(slots(hashes, bits))])
    return at[np.all([sieve[slot] for slot in slots(hashes[at], bits)], axis=0)]


def best_run(same: np.ndarray, miss: float) -> tuple[int, int, int]:
    """The run of places with the most matches less ``miss`` for each mismatch: (first, end, matches)."""
    gains = np.where(same, 1.0, -miss)
    total = np.concatenate([[0.0], np.cumsum(gains)])
    least = np.minimum.accumulate(total)
    end = int(np.argmax(total - least))
    first = int(np.flatnonzero(total[: end + 1] == least[end])[-1])
    return first, end, int(same[first:end].sum())


def longest_run(same: np.ndarray, least_share: float) -> tuple[int, int, int]:
    """The longest run of places of which at least ``least_share`` match: (first, end, matches)."""
    share = Fraction(least_share).limit_denominator(10**6)
    # Whole numbers: a run holds enough matches if the total does not fall over it.
    gains = np.where(same, share.denominator - share.numerator, -share.numerator)
    total = np.concatenate([[0], np.cumsum(gains)])
    first = np.searchsorted(-np.minimum.accumulate(total), -total, "left")
    end = int(np.argmax(np.arange(len(total)) - first))
    return int(first[end]), end, int(same[first[end] : end].sum())


def overlap(
    words: np.ndarray, other: np.ndarray, diagonals: list[int], least_words: int, least_share: float
) -> tuple[int, int, int] | None:
    """(first, end, matches) of the best overlap of a text with an item on the given diagonals: places
    in the text less places in the item."""
    best = None
    miss = least_share / (1 - least_share)
    for diagonal in sorted(diagonals):
        a, b = max(0, diagonal), min(len(words), diagonal + len(other))
        same = words[a:b] == other[a - diagonal : b - diagonal]
        first, end, matches = best_run(same, miss)
        whole = matches == len(other)
        if end - first < least_words and not whole:
            # The run with the most gain may be a part of one that is long enough.
            first, end, matches = longest_run(same, least_share)
        long_enough = end - first >= least_words or whole
        if long_enough and matches >= least_share * (end - first):
            if best is None or matches > best[2]:
                best = a + first, a + end, matches
    return best


def item_hashes(items: DataFrame) -> DataFrame:
    """``(item, text)`` -> ``(hash, item, at)``: every hash of every item with its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text"), strict=True):
                words = hashes(text.as_py())
                for mask in masks_for(len(words)):
                    found = seed_hashes(words, mask)
                    arrays = [found.view(np.int64), np.full(len(found), item), np.arange(len(found), dtype=np.int32)]
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, arrays)), names=["hash", "item", "at"])

    return items.select("item", "text").mapInArrow(run, "hash long, item long, at int")


def sieve_of(hashes: DataFrame) -> np.ndarray:
    """The slots of all item hashes as words of 64 bits; the driver gets 2^(SIEVE - 6) rows at most."""

    size = SIEVE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hash").to_numpy().view(np.uint64)
            found = np.unique(np.concatenate(list(slots(hashes, size))))
            bits = np.left_shift(np.uint64(1), (found & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found >> 6), pa.array(bits)], names=["word", "bits"])

    words = hashes.select("hash").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits"))
    out = np.zeros(1 << (size - 6), dtype=np.int64)
    for word, bits in words.collect():
        out[word] = bits
    return out


def hit_documents(texts: DataFrame, sieve: np.ndarray, masks: list[str]) -> DataFrame:
    """``(doc_id, text)`` -> the rows with hashes that pass the sieve: ``(doc_id, text, hits)``."""
    shared = texts.sparkSession.sparkContext.broadcast(sieve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(shared.value.view(np.uint8), bitorder="little").astype(bool)
        hashes = WordHashes()
        kind = pa.list_(pa.struct([("hash", pa.int64()), ("place", pa.int64())]))
        for batch in batches:
            rows, hits = [], []
            for i, text in enumerate(batch.column("text")):
                words = hashes(text.as_py())
                found: list[np.ndarray] = []
                places: list[np.ndarray] = []
                for mask in masks:
                    made = seed_hashes(words, mask)
                    at = passing(made, table)
                    found.append(made[at].view(np.int64))
                    places.append(at)
                if sum(map(len, places)):
                    rows.append(i)
                    cells = [np.concatenate(found), np.concatenate(places)]
                    hits.append(pa.StructArray.from_arrays(list(map(pa.array, cells)), names=["hash", "place"]))
            index = pa.array(rows, pa.int64())
            edges = np.cumsum([0, *map(len, hits)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(edges), pa.concat_arrays(hits)) if hits else pa.array([], kind)
            arrays = [batch.column("doc_id").take(index), batch.column("text").take(index), lists]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text", "hits"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, text string, hits array<struct<hash:long,place:long>>")


def verified(pairs: DataFrame, least_words: int, least_share: float) -> DataFrame:
    """``(doc, item, doc_id, item_id, text, item_text, diagonals)`` -> the overlaps among them."""
    doc_kind, item_kind = (pairs.schema[c].dataType.simpleString() for c in ("doc_id", "item_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        last: dict[str, tuple[int, np.ndarray]] = {}

        def words_of(side: str, key: int, text: pa.StringScalar) -> np.ndarray:
            # Rows of one text mostly follow each other.
            if last.get(side, (None,))[0] != key:
                last[side] = key, hashes(text.as_py())
            return last[side][1]

        for batch in batches:
            rows, runs = [], []
            cells = (batch.column(c) for c in ("doc", "item", "text", "item_text", "diagonals"))
            for i, (doc, item, text, item_text, diagonals) in enumerate(zip(*cells, strict=True)):
                words, other = words_of("text", doc.as_py(), text), words_of("item", item.as_py(), item_text)
                found = overlap(words, other, diagonals.as_py(), least_words, least_share)
                if found:
                    rows.append(i)
                    runs.append(found)
            index = pa.array(rows, pa.int64())
            columns = list(zip(*runs, strict=True)) or [(), (), ()]
            arrays = [batch.column("doc_id").take(index), batch.column("item_id").take(index)]
            arrays += [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(
                arrays, names=["doc_id", "item_id", "first_word", "end_word", "matches"]
            )

    return pairs.mapInArrow(
        run, f"doc_id {doc_kind}, item_id {item_kind}, first_word long, end_word long, matches long"
    )


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    least_words: int = 13,
    least_share: float = 0.8,
) -> DataFrame:
    """``(doc_id, item_id, first_word, end_word, matches, share)``: the best overlap of each document
    with each item that it overlaps.

    Hashes of spaced seeds (SEEDS) at every place of the items and of the documents are joined. Around
    a hit the two texts are laid along each other and the run with the most equal words is taken, where
    a different word costs as much as ``least_share`` allows. It counts if it is at least
    ``least_words`` long and at least ``least_share`` of its words are equal, or if it is the whole
    item. Where that run is too short, the longest one with ``least_share`` equal words is taken, so
    whatever run meets the rule, the pair is found. Words are runs of letters and digits without case;
    replaced words are found, inserted or left-out ones split a run. ``share`` is matches over the
    run's length. An item of fewer words than the shortest seed has one hash, of all its words.

    The documents are read once, whatever the number of items. A sieve of fixed size, made of the
    items' hashes, turns most places away in the task that reads them; with many items it lets more
    pass, and the join decides. Only documents with a hit are kept, with their texts, for the
    verification. Both sides of the join are stored tables, so AQE can split a hash that many documents
    have. Items and hashes stay in Spark's tables; the driver holds the sieve (2 MB).

    Null and empty items are never found; null and empty documents have no overlap. Repeated rows of
    either side give repeated rows; null ids are kept. Empty tables give an empty result; other columns
    are left out.
    """
    texts = narrow(docs, doc_id=id_col, text=text_col)
    wanted = narrow(items, item_id=item_id_col, text=item_text_col).filter("text IS NOT NULL")
    wanted = stored(wanted.withColumn("item", F.monotonically_increasing_id()), "items")
    hashes = stored(item_hashes(wanted), "item-hashes")
    sieve = sieve_of(hashes)
    # Masks of short items are looked up only if there are such items.
    counts = wanted.select(F.size(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))).alias("n"))
    short = [r["n"] for r in counts.filter(F.col("n").between(1, min(map(len, SEEDS)) - 1)).distinct().collect()]
    masks = [*SEEDS, *("1" * n for n in sorted(short))]
    hit = hit_documents(texts, sieve, masks).withColumn("doc", F.monotonically_increasing_id())
    hit = stored(hit, "hit-documents")
    places = hit.select("doc", F.inline("hits"))
    diagonal = (F.col("place") - F.col("at")).alias("diagonal")
    pairs = (
        places.join(hashes, "hash")
        .select("doc", "item", diagonal)
        .groupBy("doc", "item")
        .agg(F.collect_set("diagonal").alias("diagonals"))
    )
    named = stored(pairs, "pairs").join(wanted.withColumnRenamed("text", "item_text"), "item")
    found = verified(named.join(hit.select("doc", "doc_id", "text"), "doc"), least_words, least_share)
    return found.withColumn("share", F.col("matches") / (F.col("end_word") - F.col("first_word")))


def without_leaks(docs: DataFrame, items: DataFrame, least_words: int = 13, least_share: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that overlap no item, as in ``find_leaks``; columns stay.

    Rows are matched by id and text, so rows that share an id are judged one by one.
    """
    keyed = docs.withColumn("_id", F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit("")))))
    keyed = keyed.withColumn("_key", F.to_json("_id", {"ignoreNullFields": "false"})).drop("_id")
    found = find_leaks(keyed, items, id_col="_key", least_words=least_words, least_share=least_share)
    bad = found.select(F.col("doc_id").alias("_key")).distinct()
    return keyed.join(bad, "_key", "left_anti").select(*docs.columns)
