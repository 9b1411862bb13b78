"""Byte strings of a given length that start at two or more places of a collection.

Method: a collection Burrows-Wheeler transform built column by column. Documents are cut into short
pieces around content-chosen anchors, so that equal strings lie in pieces with the same anchor, in
the same columns. ``column_blocks`` then puts one symbol of every piece in front per round: the
pieces are kept in the order of what follows (a stable sort by the new symbol turns the order of one
round into that of the next), and the common prefixes of neighbours are carried along. Neighbours
with a common prefix of the full length are repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.tables import join_split, narrow, stored

#: Length of the byte strings whose hash picks an anchor.
GRAM = 32
#: Window starts of a text that are handled at once.
CHUNK = 1 << 18
#: Pieces whose columns are sorted together.
BLOCK = 1 << 14

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_POSITION = np.uint64((1 << 20) - 1)


def _powers(count: int, factor: int) -> np.ndarray:
    made = np.full(count, factor, dtype=np.uint64)
    made[0] = 1
    return np.multiply.accumulate(made)


class Anchors:
    """Cuts a text into runs of window starts that share their anchor.

    A window's anchor is the leftmost of its GRAM-byte strings with the smallest hash: it depends on
    the window's bytes alone, so equal windows have equal anchors at equal places.
    """

    def __init__(self, length: int):
        self.length = length
        self.gram = min(GRAM, length)
        self.width = length - self.gram + 1
        most = CHUNK + length + self.gram
        self.up = _powers(most, _BASE)
        self.down = _powers(most, pow(_BASE, -1, 1 << 64))

    def chunk(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First window start of each run, the anchor's place, and the anchor's hash."""
        k, w, n = self.gram, self.width, len(data)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=total[1:])
        grams = (total[k:] - total[: n - k + 1]) * self.down[: n - k + 1]
        grams ^= grams >> np.uint64(32)
        grams *= np.uint64(0xD6E8FEB86659FD93)
        grams ^= grams >> np.uint64(29)
        grams *= np.uint64(0xBF58476D1CE4E5B9)
        grams ^= grams >> np.uint64(32)
        places = np.arange(len(grams), dtype=np.uint64)
        keys = (grams & ~_POSITION) | places
        blocks = -(-len(keys) // w)
        padded = np.full(blocks * w, _MASK, dtype=np.uint64)
        padded[: len(keys)] = keys
        table = padded.reshape(blocks, w)
        before = np.minimum.accumulate(table, axis=1).ravel()
        after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = len(keys) - w + 1
        best = np.minimum(after[:starts], before[w - 1 : w - 1 + starts])
        at = (best & _POSITION).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
        return first, at[first], grams[at[first]]

    def runs(self, text: bytes) -> Iterator[tuple[np.ndarray, ...]]:
        """Blocks of (first window start, window count, anchor place, anchor hash, piece digest)."""
        whole = np.frombuffer(text, dtype=np.uint8)
        last = len(whole) - self.length  # the last window start
        for begin in range(0, last + 1, CHUNK):
            ends = min(begin + CHUNK, last + 1)
            first, at, grams = self.chunk(whole[begin : ends - 1 + self.length])
            first, at = first + begin, at + begin
            count = np.diff(np.append(first, ends))
            spans = zip(
                first.tolist(),
                (first + count - 1 + self.length).tolist(),
                (at - first).tolist(),
                strict=True,
            )
            digest = [xxhash.xxh3_64_intdigest(text[a:b], off) for a, b, off in spans]
            yield first, count, at, grams, np.array(digest, dtype=np.uint64)


ANCHORS = "doc_id {id}, th long, at long, off int, h long, d long"


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """``(doc_id, th, text)`` -> a row for each run of window starts with one anchor.

    ``at`` packs the first start and the number of starts; ``off`` is the anchor's distance from the
    first start; ``h`` is the anchor's hash and ``d`` a digest of the run's bytes and ``off``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Anchors(length)
        for batch in batches:
            rows: list[int] = []
            parts: list[list[np.ndarray]] = [[], [], [], []]
            size = 0

            def flush(batch=batch):
                cells = [np.concatenate(p) for p in parts]
                index = pa.array(np.repeat(np.array(rows[0::2]), np.array(rows[1::2])))
                made = [batch.column("doc_id").take(index), batch.column("th").take(index)]
                made += [pa.array(c) for c in cells]
                rows.clear()
                for p in parts:
                    p.clear()
                names = ["doc_id", "th", "at", "off", "h", "d"]
                return pa.RecordBatch.from_arrays(made, names=names)

            for i, text in enumerate(batch.column("text")):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                for first, count, at, grams, digest in cutter.runs(raw):
                    rows += [i, len(first)]
                    parts[0].append(first << 16 | count)
                    parts[1].append((at - first).astype(np.int32))
                    parts[2].append(grams.view(np.int64))
                    parts[3].append(digest.view(np.int64))
                    size += len(first)
                if size > 100_000:
                    yield flush()
                    size = 0
            if size:
                yield flush()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "th", "text").mapInArrow(run, ANCHORS.format(id=kind))


def column_blocks(
    pieces: list[bytes], offs: np.ndarray, length: int, width: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Column-wise construction over pieces that are aligned at their anchors.

    Yields for each column in which windows may start, from right to left: the column, the order of
    the pieces by what starts there, and the length of each one's common prefix with the one before
    it, never counting past a piece's end. Column ``width - 1`` holds the anchors.
    """
    m, columns = len(pieces), width - 1 + length
    table = np.zeros((m, columns), dtype=np.uint16)
    for i, (piece, off) in enumerate(zip(pieces, offs.tolist(), strict=True)):
        s = width - 1 - off
        table[i, s : s + len(piece)] = np.frombuffer(piece, dtype=np.uint8)
        table[i, s : s + len(piece)] += 1  # 0 stands for no symbol
    table = np.ascontiguousarray(table.T)
    order = np.arange(m)
    common = np.zeros(m, dtype=np.int16)
    for column in range(columns - 1, -1, -1):
        symbols = table[column][order]
        moved = np.argsort(symbols, kind="stable")
        symbols = symbols[moved]
        same = (symbols[1:] == symbols[:-1]) & (symbols[1:] > 0)
        after = np.zeros(m, dtype=np.int16)
        if same.any():
            a, b = moved[:-1][same] + 1, moved[1:][same]
            after[1:][same] = _range_min(common, a, b) + 1
        order, common = order[moved], after
        if column < width:
            yield column, order, common


def _range_min(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of ``values[a..b]``, both ends included."""
    span = b - a + 1
    level = np.frexp(span)[1] - 1
    out = np.empty(len(a), dtype=values.dtype)
    table = values
    for k in range(int(level.max()) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        here = np.flatnonzero(level == k)
        if len(here):
            out[here] = np.minimum(table[a[here]], table[b[here] - (1 << k) + 1])
    return out


def repeated_windows(
    pieces: list[bytes], offs: np.ndarray, length: int, width: int, open_rows: np.ndarray
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which windows of the pieces repeat among them, and one window of each class of ``open_rows``.

    The first result has a row for each piece and a column for each window start. The second names
    (piece, column) for each class of equal windows that an open row is in: rows whose anchor has
    more pieces than this block, so that equal windows may lie in another block.
    """
    found = np.zeros((len(pieces), width), dtype=bool)
    heads: list[tuple[int, int]] = []
    counts = np.array([len(p) - length + 1 for p in pieces])
    low = width - 1 - offs
    for column, order, common in column_blocks(pieces, offs, length, width):
        full = common >= length
        member = full.copy()
        member[:-1] |= full[1:]
        found[order[member], column] = True
        if open_rows.any():
            row = order[~full]  # the first of each class, and single windows
            own = open_rows[row] & (low[row] <= column) & (column < low[row] + counts[row])
            heads += [(int(r), column) for r in row[own]]
    return found, heads


def _ranges(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of the runs of true cells in each row."""
    edge = np.zeros((found.shape[0], 1), dtype=np.int8)
    step = np.diff(np.hstack([edge, found.astype(np.int8), edge]), axis=1)
    row, first = np.nonzero(step == 1)
    return row, first, np.nonzero(step == -1)[1] - 1


def _compared(pieces: DataFrame, length: int) -> DataFrame:
    """Pieces dealt by anchor -> ranges ``(lo, hi)`` of places where repeated strings start, for
    pieces that occur once (``single``).

    Rows with a ``digest`` stand for one class of windows of an anchor that has several blocks; of
    these there are rows for the other pieces too.
    """
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Anchors(length)
        width = cutter.width
        names = ["h", "part", "doc_id", "th", "at", "off", "open", "single", "piece"]
        kept: list[tuple] = []
        id_type = None

        def block(rows: list[tuple]) -> pa.RecordBatch:
            _, _, doc_id, th, at, off, is_open, single, piece = zip(*rows, strict=True)
            offs, opens = np.array(off), np.array(is_open, dtype=bool)
            found, heads = repeated_windows(list(piece), offs, length, width, opens)
            found[~np.array(single, dtype=bool)] = False  # these repeat as a whole
            row, first, last = _ranges(found)
            rows_of = row.tolist() + [r for r, _ in heads]
            digests: list[bytes | None] = [None] * len(row)
            for r, column in heads:
                s = column - (width - 1 - off[r])
                digests.append(xxhash.xxh3_128_digest(piece[r][s : s + length]))
            columns = [c for _, c in heads]
            # From columns back to places in the texts.
            low = [(at[r] >> 16) + off[r] - (width - 1) for r in rows_of]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([doc_id[r] for r in rows_of], id_type),
                    pa.array([th[r] for r in rows_of], pa.int64()),
                    pa.array([x + c for x, c in zip(low, first.tolist() + columns, strict=True)], pa.int64()),
                    pa.array([x + c for x, c in zip(low, last.tolist() + columns, strict=True)], pa.int64()),
                    pa.array([single[r] for r in rows_of], pa.bool_()),
                    pa.array(digests, pa.binary()),
                ],
                names=["doc_id", "th", "lo", "hi", "single", "digest"],
            )

        def full_groups(last: bool) -> Iterator[list[tuple]]:
            """Whole groups of one (h, part), several to a block."""
            begin = at = 0
            while at < len(kept):
                end = at
                while end < len(kept) and kept[end][:2] == kept[at][:2]:
                    end += 1
                if end == len(kept) and not last:
                    break
                if end - begin >= BLOCK:
                    yield kept[begin:end]
                    begin = end
                at = end
            if last and begin < len(kept):
                yield kept[begin:]
                begin = len(kept)
            del kept[:begin]

        for batch in batches:
            id_type = batch.column("doc_id").type
            kept.extend(zip(*(batch.column(c).to_pylist() for c in names), strict=True))
            if len(kept) >= 2 * BLOCK:
                for rows in full_groups(False):
                    yield block(rows)
        for rows in full_groups(True):
            yield block(rows)

    dealt = pieces.repartition("h", "part").sortWithinPartitions("h", "part")
    return dealt.mapInArrow(run, f"doc_id {kind}, th long, lo long, hi long, single boolean, digest binary")


def _pieces(wanted: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """Takes the bytes of the wanted runs out of the texts that hold them."""

    kind = wanted.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "part", "at", "off", "open", "single"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]
        for batch in batches:
            cells: list[list] = [[] for _ in kinds]
            rows: list[int] = []
            for i, (text, runs) in enumerate(zip(batch.column("text"), batch.column("runs"), strict=True)):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                for r in runs.as_py():
                    first, count = r["at"] >> 16, r["at"] & 0xFFFF
                    rows.append(i)
                    for cell, name in zip(cells, names, strict=False):
                        cell.append(r[name])
                    cells[-1].append(raw[first : first + count - 1 + length])
            index = pa.array(rows, pa.int64())
            arrays = [batch.column("doc_id").take(index), batch.column("th").take(index)]
            arrays += [pa.array(c, k) for c, k in zip(cells, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "th", *names, "piece"])

    by_doc = wanted.groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("at", "h", "part", "off", "open", "single")).alias("runs")
    )
    one = docs.select(F.col("doc_id").alias("id"), F.col("th").alias("hash"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("hash"))
    # Rows that repeat an id and its text give the same piece again, which changes nothing: a piece
    # that occurs twice is repeated anyway.
    texts = one.join(by_doc, same).select("doc_id", "th", "text", "runs")
    return texts.mapInArrow(
        run,
        f"doc_id {kind}, th long, h long, part long, at long, off int, open boolean, single boolean, "
        "piece binary",
    )


def window_ranges(docs: DataFrame, length: int) -> DataFrame:
    """``(doc_id, th, text)`` -> ``(doc_id, th, lo, hi)``: ranges of the places where repeated
    strings start."""
    found = anchors(docs, length)
    keys = (
        found.groupBy("h")
        .agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("least"), F.max("d").alias("most"))
        .filter("n > 1")
        .select("h", (F.col("least") != F.col("most")).alias("mixed"))
    )
    # An anchor that occurs once is in no repeat: most rows end here.
    hits = stored(join_split(found, keys, ["h"]), "anchors")
    mixed = hits.filter("mixed")
    times = mixed.groupBy("h", "d").agg(F.count(F.lit(1)).alias("times"))
    counted = stored(join_split(mixed, times, ["h", "d"]), "pieces")
    # A piece that occurs several times repeats as a whole, at each of its places.
    columns = ["doc_id", "th", "at"]
    copies = hits.filter("NOT mixed").select(columns).union(counted.filter("times > 1").select(columns))
    first = F.shiftright("at", 16)
    last = first + F.col("at").bitwiseAND(F.lit(0xFFFF)) - 1
    whole = copies.select("doc_id", "th", first.alias("lo"), last.alias("hi"))
    # Compared are the pieces that occur once, and one place of each other one. All firsts come from
    # the same row.
    once = counted.filter("times = 1").select("h", "d", *columns, "off", F.lit(True).alias("single"))
    others = (
        counted.filter("times > 1")
        .groupBy("h", "d")
        .agg(*(F.first(c).alias(c) for c in (*columns, "off")))
        .withColumn("single", F.lit(False))
    )
    distinct = stored(once.unionByName(others), "distinct")
    blocks = distinct.groupBy("h").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = join_split(distinct, blocks, ["h"]).select(
        "doc_id", "th", "at", "h", "off", "single",
        F.pmod(F.xxhash64("d"), "blocks").alias("part"), (F.col("blocks") > 1).alias("open"),
    )
    compared = stored(_compared(_pieces(dealt, docs, length), length), "compared")
    # Classes of an anchor with several blocks meet again by their bytes' 128-bit digest. A block
    # has one row for a class, so a class has as many rows as blocks at most.
    classes = (
        compared.filter("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.collect_list(F.struct("doc_id", "th", "lo", "hi", "single")).alias("rows"))
        .filter(F.size("rows") > 1)
        .select(F.inline("rows"))
    )
    shared = compared.filter("digest IS NULL").select(*classes.columns).union(classes)
    return whole.union(shared.filter("single").select(*whole.columns))


def merged(ranges: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Ranges of window starts -> maximal runs ``[begin, end)`` of covered bytes."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi + length))
        else:
            out.append((lo, hi + length))
    return out


def whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans less the bytes of characters that lie only partly inside."""
    out = []
    for a, b in spans:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 200,
    characters: bool = False,
) -> DataFrame:
    """``(doc_id, text, spans, kept)`` for each row: the runs of bytes covered by a string of
    ``length`` bytes that starts at another place too, and the text's other bytes, joined.

    Places are all bytes of all rows; a string never reaches from one row into another. Every
    occurrence goes, the first one included. Strings are judged on the input. With ``characters``
    a character that lies partly in a run stays whole, so ``kept`` is valid UTF-8.
    A null text counts as empty: no spans, empty ``kept``. Texts shorter than ``length`` stay as
    they are. Rows that repeat an id, or an id and its text, are places of their own; a null id is
    an id like any other here. An empty table gives an empty result. Other columns are left out.
    """
    texts = narrow(docs, doc_id=id_col, text=text_col)
    texts = texts.withColumn("th", F.xxhash64(F.coalesce("text", F.lit(""))))
    by_doc = (
        window_ranges(texts, length)
        .groupBy("doc_id", "th")
        .agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
        .select(F.col("doc_id").alias("id"), F.col("th").alias("hash"), "ranges")
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("hash"))
    joined = texts.join(by_doc, same, "left").select("doc_id", "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans, kept = [], []
            for text, ranges in zip(batch.column("text"), batch.column("ranges"), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                runs = merged([(r["lo"], r["hi"]) for r in ranges.as_py() or []], length)
                if characters:
                    runs = whole_characters(raw, runs)
                rest, at = [], 0
                for a, b in runs:
                    rest.append(raw[at:a])
                    at = b
                kept.append(b"".join([*rest, raw[at:]]))
                spans.append([{"start": a, "end": b} for a, b in runs])
            arrays = [batch.column("doc_id"), batch.column("text")]
            arrays += [pa.array(spans, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text", "spans", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(
        run, f"doc_id {kind}, text string, spans array<struct<start:long,end:long>>, kept binary"
    )


def replace_texts(docs: DataFrame, length: int = 200) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text``, in whole characters, and ``n_chars``, if
    there is such a column, counted anew; other columns stay.

    Rows are matched by id and text. A null text stays null.
    """
    marked = docs.withColumn(
        "_key", F.struct(F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    ).withColumn("_key", F.to_json("_key", {"ignoreNullFields": "false"}))
    cut = remove_repeats(marked, id_col="_key", length=length, characters=True)
    # Rows that repeat an id and its text share one result.
    new = cut.select(F.col("doc_id").alias("_key"), F.col("kept").cast("string").alias("_kept"))
    joined = marked.join(new.dropDuplicates(["_key"]), "_key")
    text = F.when(F.col("text").isNotNull(), F.col("_kept"))
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out.select(*docs.columns)
