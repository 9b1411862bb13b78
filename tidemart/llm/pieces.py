"""Subword ids of whole texts by a table of distinct marked words, and texts from ids.

Where no piece of a model reaches from one word over the space marker into the next one, a text can
be cut in front of its marker runs and each part be segmented for itself. Texts repeat their words, so
each distinct part ("chunk") of a task's texts is segmented once, and its ids are joined back by
position.

The table is a task's own, not one of the whole collection: sending the chunks of all texts to one
table and their ids back takes more room than the texts (see the README), while segmenting a chunk
again in another task costs microseconds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tidemart.llm.tables import narrow

MARK = "▁"
#: A run of space markers and what follows it; a text without a leading marker begins with the rest.
CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
#: Characters of texts whose new chunks are segmented together.
BLOCK = 1 << 20
#: Distinct chunks, and ids of theirs, in a task's table before it is begun anew.
ENTRIES, IDS = 1 << 19, 1 << 22


@cache
def processor(proto: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=proto)


def stays_in_words(proto: bytes) -> bool:
    """Whether no piece has a space marker behind another character."""
    model = processor(proto)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return not any(MARK in piece.lstrip(MARK) for piece in pieces)


def chunks(model: sentencepiece.SentencePieceProcessor, text: str) -> list[str]:
    return CHUNK.findall(model.normalize(text).replace(" ", MARK))


def segment(model: sentencepiece.SentencePieceProcessor, parts: list[str]) -> list[list[int]]:
    """Ids of each chunk.

    A marked chunk is segmented behind a word whose ids are known and dropped: alone, a chunk that is
    one marker would be taken for an empty text.
    """
    known = len(model.encode("x"))
    marked = model.encode(["x" + part for part in parts])
    return [
        ids[known:] if part.startswith(MARK) else model.encode(part)
        for part, ids in zip(parts, marked, strict=True)
    ]


class ChunkTable:
    """Distinct chunks in the order in which they came, with their ids end to end."""

    def __init__(self, model: sentencepiece.SentencePieceProcessor):
        self.model = model
        self.places: dict[str, int] = {}
        self.starts = np.zeros(1, dtype=np.int64)  # where each chunk's ids begin, and the end
        self.ids = np.zeros(0, dtype=np.int32)

    def positions(self, text: str) -> np.ndarray:
        """The places of a text's chunks; a new chunk gets the next place, its ids come with ``fill``."""
        places = self.places
        found = [places.setdefault(part, len(places)) for part in chunks(self.model, text)]
        return np.array(found, dtype=np.int64)

    def fill(self) -> None:
        """Segments the chunks that came since the last time."""
        fresh = list(self.places)[len(self.starts) - 1 :]
        if not fresh:
            return
        made = segment(self.model, fresh)
        lengths = np.fromiter(map(len, made), dtype=np.int64, count=len(made))
        self.starts = np.concatenate([self.starts, self.starts[-1] + lengths.cumsum()])
        self.ids = np.concatenate([self.ids, np.fromiter((i for ids in made for i in ids), dtype=np.int32)])

    def join(self, positions: np.ndarray) -> np.ndarray:
        """The ids of the chunks at ``positions``, end to end."""
        starts = self.starts[positions]
        lengths = self.starts[positions + 1] - starts
        ends = lengths.cumsum()
        return self.ids[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]

    def full(self) -> bool:
        return len(self.places) > ENTRIES or len(self.ids) > IDS


def encode(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    add_end: bool = True,
) -> DataFrame:
    """``(doc_id, ids)`` for each row: the ids that the model gives the whole text, then its end id.

    The model file is read once, by the driver, and sent to the tasks (half a megabyte). Some BLOCK
    characters of texts are cut into chunks at a time; their new chunks go to the task's table in one
    call, then the texts' ids are laid out by position. Rows stay where they are: nothing is shuffled
    or stored, and a lost task needs only its own texts again. A task holds one block, a table of some
    ENTRIES chunks and the longest text with its ids.

    A null text counts as empty: only the end id. Texts without a space are one chunk of any length.
    Repeated and null ids keep their rows. An empty table gives an empty result; other columns are left
    out. A model with a piece over a marker is refused.
    """
    with open(model_path, "rb") as file:
        proto = file.read()
    if not stays_in_words(proto):
        raise ValueError("a piece of this model reaches over a space marker")
    shared = docs.sparkSession.sparkContext.broadcast(proto)
    last = [processor(proto).eos_id()] if add_end else []
    texts = narrow(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = processor(shared.value)
        table = ChunkTable(model)
        for batch in batches:
            begin = size = 0
            held: list[np.ndarray] = []
            for i, text in enumerate(batch.column("text")):
                whole = text.as_py() or ""
                held.append(table.positions(whole))
                size += len(whole)
                if size < BLOCK and i + 1 < batch.num_rows:
                    continue
                table.fill()
                rows = [np.append(table.join(positions), last).astype(np.int32) for positions in held]
                edges = np.cumsum([0, *map(len, rows)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(rows)))
                doc_ids = batch.column("doc_id").slice(begin, len(rows))
                yield pa.RecordBatch.from_arrays([doc_ids, ids], names=["doc_id", "ids"])
                begin, size, held = i + 1, 0, []
                if table.full():
                    table = ChunkTable(model)

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, ids, text)``: the text that the model gives the ids.

    A null list counts as empty and gives an empty text. Other columns are left out.
    """
    with open(model_path, "rb") as file:
        shared = encoded.sparkSession.sparkContext.broadcast(file.read())
    rows = narrow(encoded, doc_id=id_col, ids=ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = processor(shared.value)
        for batch in batches:
            lists = (ids.values for ids in batch.column("ids"))
            texts = [model.decode([] if ids is None else ids.to_numpy().tolist()) for ids in lists]
            arrays = [*batch.columns, pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "ids", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")
