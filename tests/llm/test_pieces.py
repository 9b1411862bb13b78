"""Ids by the chunk table against the library on whole texts, and back."""

import random

import public_tokenizers
import pytest
import sentencepiece
from conftest import rows

from tidemart.llm import pieces, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def odd_texts():
    rng = random.Random(3)
    symbols = [" ", "  ", "▁", "\n", "\t", "a", "the", "Ümlaut", "日本語", "😀", "<s>", "<0x41>", "\x00", "１", "x", "x "]
    return [
        None, "", " ", "   ", "▁", "▁▁", "a ", " a", "x", "xx x", "\n", "<s> </s> <unk>", "́", "　",
        "word " * 30_000, "ab" * 40_000, " " * 5_000, "no space" * 3_000,
        *("".join(rng.choices(symbols, k=rng.randrange(1, 40))) for _ in range(300)),
    ]


def test_chunks_are_segmented_as_in_the_text(plain):
    for text in odd_texts():
        parts = pieces.chunks(plain, text or "")
        assert "".join(parts) == plain.normalize(text or "")
        assert sum(pieces.segment(plain, parts), []) == plain.encode(text or "")


@pytest.mark.parametrize("block", [pieces.BLOCK, 50])
def test_whole_texts(spark, plain, monkeypatch, block):
    monkeypatch.setattr(pieces, "BLOCK", block)
    texts = odd_texts()
    docs = spark.createDataFrame(
        [(str(i // 2) if i % 7 else None, t, i, i, "c", 0) for i, t in enumerate(texts)],
        "id string, body string, block int, codes int, chunk string, ids int",
    )
    encoded = pieces.encode(docs.repartition(3), MODEL, "id", "body")
    decoded = pieces.decode(encoded, MODEL)
    want = []
    for i, text in enumerate(texts):
        ids = plain.encode(text or "", add_eos=True)
        want.append((str(i // 2) if i % 7 else None, ids, plain.decode(ids)))
    assert rows(decoded) == sorted(want, key=repr)


def test_without_end_and_without_rows(spark, plain):
    docs = spark.createDataFrame([(1, "a b a"), (2, None)], "doc_id long, text string")
    assert rows(pieces.encode(docs, MODEL, add_end=False)) == [(1, plain.encode("a b a")), (2, [])]
    empty = pieces.encode(docs.limit(0), MODEL)
    assert pieces.decode(empty, MODEL).collect() == []
    assert rows(pieces.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), MODEL)) == [(1, None, "")]


def test_each_chunk_is_segmented_once(plain, monkeypatch):
    """What goes to the model are the distinct chunks, over all blocks until the table is full."""
    seen = []
    segment = pieces.segment
    monkeypatch.setattr(pieces, "segment", lambda model, parts: seen.extend(parts) or segment(model, parts))
    table = pieces.ChunkTable(plain)
    texts = ["one two two three", "", "three one", "four  two"] * 5
    for text in texts:
        positions = table.positions(text)
        table.fill()
        assert table.join(positions).tolist() == plain.encode(text)
    assert sorted(seen) == sorted(set(seen)) and len(seen) == 5 and not table.full()
    monkeypatch.setattr(pieces, "ENTRIES", 4)
    assert table.full()


def test_a_model_with_pieces_over_markers_is_refused(spark, monkeypatch):
    monkeypatch.setattr(pieces, "stays_in_words", lambda proto: False)
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="marker"):
        pieces.encode(docs, MODEL)


def test_query_against_the_library(spark, sf_dir, plain):
    import hashlib

    def code(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for doc_id, text in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        ids = plain.encode(text or "", add_eos=True)
        want.append((doc_id, len(ids), code(" ".join(map(str, ids))), code(plain.decode(ids))))
    assert rows(queries.op11_pieces(spark, sf_dir)) == sorted(want, key=repr)
