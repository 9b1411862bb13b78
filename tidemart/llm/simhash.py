"""SimHash fingerprints and the groups of documents whose fingerprints nearly agree."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.components import components
from tidemart.llm.tables import join_split, narrow, stored

BITS = 64
#: A group of at most so many fingerprints is compared pair by pair inside one task; a larger one
#: is split again on further bits first.
DENSE = 2048
#: Shingles hashed at once: bounds the memory that one very long text takes.
CHUNK = 1 << 16


def shingle_hashes(text: str | None, words: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 values of the word shingles, CHUNK at a time; nothing for a text without words.

    A text shorter than a shingle is one shingle.
    """
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    words = min(words, len(found))
    first, last = starts[: len(found) - words + 1], ends[words - 1 :]
    for at in range(0, len(first), CHUNK):
        spans = zip(first[at : at + CHUNK].tolist(), last[at : at + CHUNK].tolist(), strict=True)
        yield np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in spans], dtype="<u8")


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """A bit is 1 if it is set in over half of the XXH64 values of the word shingles.

    Repeats count. A text shorter than a shingle is one shingle; without words the result is 0.
    """
    ones, count = np.zeros(BITS, dtype=np.int64), 0
    for hashes in shingle_hashes(text, words, seed):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        count += len(hashes)
    majority = (2 * ones > count).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, fp)``; ``fp`` holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t.as_py(), words, seed) for t in batch.column("text")]
            fp = pa.array(np.array(made, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fp], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def block_masks(free: int, max_bits: int) -> list[int]:
    """Masks of ``free``'s bits such that two values differing there in at most ``max_bits`` bits
    agree on one mask at least.

    The bits are cut into twice ``max_bits`` blocks; ``max_bits`` differences touch at most that
    many blocks, so ``max_bits`` others agree. A mask is one choice of that many blocks.
    """
    places = [i for i in range(BITS) if free >> i & 1]
    count = 2 * max_bits
    blocks = [0] * count
    for k, i in enumerate(places):
        blocks[k * count // len(places)] |= 1 << i
    return [sum(chosen) for chosen in combinations(blocks, max_bits)]


def _near(a: Column, b: Column, max_bits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= max_bits


def _bucketed(keyed: DataFrame, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """``(mask, key, fp)`` -> links of buckets of two, and the members of larger buckets with n.

    Counting combines before the shuffle. Nearly all buckets hold one fingerprint and end here.
    """
    sizes = keyed.groupBy("mask", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")
    )
    sizes = stored(sizes.filter("n > 1"), "buckets")
    pairs = sizes.filter("n = 2").filter(_near(F.col("a"), F.col("b"), max_bits)).select("a", "b")
    members = join_split(keyed, sizes.filter("n > 2").select("mask", "key", "n"), ["mask", "key"])
    return pairs, members


def _flips(free: int, max_bits: int) -> np.ndarray:
    places = [1 << i for i in range(BITS) if free >> i & 1]
    made = [sum(c) for k in range(1, max_bits + 1) for c in combinations(places, k)]
    return np.array(made, dtype=np.uint64)


def link_group(fps: np.ndarray, mask: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints that agree on ``mask`` -> each one but the first of its component
    there, and that first one.

    Up to DENSE values are compared with each other. More are walked by flipping up to ``max_bits``
    of the bits outside the mask and looking the result up: linear in the number of values.
    """
    fps = np.sort(fps)
    root = np.full(len(fps), -1, dtype=np.int64)
    flips = _flips(~mask & ((1 << BITS) - 1), max_bits) if len(fps) > DENSE else None
    for first in range(len(fps)):
        if root[first] >= 0:
            continue
        root[first] = first
        front = np.array([first])
        while len(front):
            reached = np.zeros(len(fps), dtype=bool)
            for at in range(0, len(front), 256):
                part = fps[front[at : at + 256]]
                if flips is None:
                    near = np.bitwise_count(part[:, None] ^ fps[None, :]) <= max_bits
                    reached |= near.any(axis=0)
                else:
                    wanted = (part[:, None] ^ flips[None, :]).ravel()
                    found = np.searchsorted(fps, wanted)
                    found[found == len(fps)] = 0
                    reached[found[fps[found] == wanted]] = True
            front = np.flatnonzero(reached & (root < 0))
            root[front] = first
    other = np.flatnonzero(root != np.arange(len(fps)))
    return fps[other], fps[root[other]]


def _linked(members: DataFrame, max_bits: int) -> DataFrame:
    """Links inside buckets of bounded size: one row for each fingerprint that has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []

        def groups(last: bool) -> Iterator[tuple[np.ndarray, int]]:
            masks, keys, fps = (np.concatenate(c) for c in zip(*kept, strict=True))
            cuts = np.flatnonzero((masks[1:] != masks[:-1]) | (keys[1:] != keys[:-1])) + 1
            edges = [0, *cuts.tolist(), len(fps)]
            for a, b in zip(edges[:-1], edges[1:] if last else edges[1:-1], strict=False):
                yield fps[a:b], int(masks[a]) & ((1 << BITS) - 1)
            kept[:] = [] if last else [(masks[edges[-2] :], keys[edges[-2] :], fps[edges[-2] :])]

        def made(last: bool) -> Iterator[pa.RecordBatch]:
            ends = [link_group(fps.view(np.uint64), mask, max_bits) for fps, mask in groups(last)]
            if ends:
                a, b = (np.concatenate(c).view(np.int64) for c in zip(*ends, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if batch.num_rows:
                kept.append(tuple(batch.column(c).to_numpy() for c in ("mask", "key", "fp")))
                yield from made(False)
        if kept:
            yield from made(True)

    together = members.select("mask", "key", "fp").repartition("mask", "key")
    return together.sortWithinPartitions("mask", "key").mapInArrow(run, "a long, b long")


def _keyed(df: DataFrame, masks: list[int]) -> DataFrame:
    choices = F.array(*(F.lit(_signed(m)).cast("long") for m in masks))
    split = df.select("fp", F.explode(choices).alias("mask"))
    return split.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def close_links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Distinct ``fp`` -> links ``(a, b)`` that connect exactly what pairs at up to ``max_bits``
    differing bits connect.

    Blocks: each fingerprint goes to the buckets of 20 masks of about 32 bits (for 3 bits), and a
    close pair meets in one at least. A bucket of up to DENSE values is linked in one task. A larger
    one, such as a crowd of near copies around one fingerprint, is split once more in the same way
    on its other bits; what is left has about 16 free bits, so its size is bounded by their number.
    """
    everything = (1 << BITS) - 1
    masks = block_masks(everything, max_bits)
    pairs, members = _bucketed(_keyed(fps, masks), max_bits)
    members = stored(members, "members")
    crowded = members.filter(F.col("n") > DENSE)
    inner = {m: [m | s for s in block_masks(everything & ~m, max_bits)] for m in masks}
    choices = F.create_map(
        *(
            part
            for m, subs in inner.items()
            for part in (
                F.lit(_signed(m)).cast("long"),
                F.array(*(F.lit(_signed(s)).cast("long") for s in subs)),
            )
        )
    )
    split = crowded.select("fp", F.explode(choices[F.col("mask")]).alias("mask"))
    again = split.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    # A value may come to the same inner bucket from several outer ones.
    inner_pairs, inner_members = _bucketed(again.distinct(), max_bits)
    return (
        pairs.union(inner_pairs)
        .union(_linked(members.filter(F.col("n") <= DENSE), max_bits))
        .union(_linked(inner_members, max_bits))
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    max_bits: int = 3,
    seed: int = 42,
) -> DataFrame:
    """One row for each input row: ``(doc_id, fp, component_id)``.

    ``component_id`` is the smallest id reachable over links of at most ``max_bits`` differing bits,
    the row's own id included. Equal texts meet in one fingerprint, so copies cost one row there.
    A null text counts as empty; empty texts have fingerprint 0 and are linked like any other.
    Repeated ids give repeated rows. A null id stays null and is never the smallest one; a component
    of null ids alone has a null id. An empty table gives an empty result.
    """
    texts = narrow(docs, doc_id=id_col, text=text_col)
    marked = stored(fingerprints(texts, words, seed), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    return named(marked, distinct, close_links(distinct.select("fp"), max_bits))


def named(marked: DataFrame, distinct: DataFrame, links: DataFrame) -> DataFrame:
    """``(doc_id, fp)``, ``(fp, least)`` and links of ``fp`` -> ``(doc_id, fp, component_id)``."""
    roots = components(links)
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    first = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = placed.join(first, "root").select("fp", "component_id")
    return marked.join(ids, "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, words: int = 5, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest id stays.

    Rows with a null id are not compared and stay. Of rows that repeat the smallest id, one stays.
    Columns stay as they are.
    """
    return first_of_groups(docs, lambda known: near_duplicates(known, words=words, max_bits=max_bits))


def first_of_groups(docs: DataFrame, grouped: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows whose id is the ``component_id`` that ``grouped`` gives, and rows with a null id."""
    known = docs.filter("doc_id IS NOT NULL")
    kept = grouped(known).filter("doc_id = component_id").select("doc_id").distinct()
    first = known.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return first.unionByName(docs.filter("doc_id IS NULL"))
