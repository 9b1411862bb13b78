"""Removes lines or paragraphs that an earlier place of the collection has already."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.tables import narrow, stored

SPACE = "[\\x20\\x09-\\x0D]+"


def normalised(unit: Column) -> Column:
    """A-Z in lower case, runs of white space as one space, none at the ends."""
    lower = F.translate(unit, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(lower, SPACE, " "))


def remove_units(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    separator: str = "\n",
    least_words: int = 1,
) -> DataFrame:
    """``(doc_id, n_units, spans, kept)`` for each row.

    Texts are cut at ``separator`` (a newline for lines, two for paragraphs). Units with the same
    normalised words are copies; the one in the row with the smallest id, and there the first one,
    stays, the others go. Units without words stay, and so do those of fewer than ``least_words``.
    ``spans`` are ``(unit, start, end, first_id)`` of what was removed:
    place among the units, code points counted from 0 in the original text, and the id that keeps
    it. ``kept`` is the rest, joined by the separator.

    Digests (MD5 of the normalised unit) are grouped with a combine before the shuffle, and only
    those that occur twice come back to the rows, so a line that a third of all rows share costs one
    row of state. Null texts count as empty: one empty unit. Rows that repeat an id are told apart
    by their text; rows that repeat both keep their units in one of them only if nothing earlier has
    them, and share the outcome. A null id ranks after all others. An empty table gives an empty
    result; other columns are left out.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("th", F.xxhash64("text"))
    cut = F.split("text", separator.replace("\n", "\\n"), -1)
    units = rows.select("doc_id", "th", F.posexplode(cut).alias("unit", "line"))
    plain = normalised(F.col("line"))
    worded = (
        units.withColumn("plain", plain)
        .filter((F.col("plain") != "") & (F.size(F.split("plain", " ")) >= least_words))
        .select("doc_id", "th", "unit", F.unhex(F.md5("plain")).alias("digest"))
    )
    worded = stored(worded, "units")
    # A place's rank is its id, then its unit, then its text's hash: rows that share an id differ there.
    # The least id is null only where all ids are.
    least = (
        worded.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))
        .filter("n > 1")
        .select("digest", "first_id")
    )
    # A table of its own is dealt out anew for the join, where AQE can split a hot digest.
    copies = stored(worded.join(stored(least, "least"), "digest"), "copies")
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id"))
    first = (
        copies.filter(is_first)
        .groupBy("digest")
        .agg(F.min(F.struct("unit", "th")).alias("place"))
        .select("digest", F.col("place.unit").alias("first_unit"), F.col("place.th").alias("first_th"))
    )
    gone = copies.join(stored(first, "first"), "digest").filter(
        ~is_first | (F.col("unit") != F.col("first_unit")) | (F.col("th") != F.col("first_th"))
    )
    by_row = (
        gone.groupBy("doc_id", "th")
        .agg(F.collect_set(F.struct("unit", "first_id")).alias("gone"))
        .select(F.col("doc_id").alias("id"), F.col("th").alias("hash"), F.array_sort("gone").alias("gone"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("hash"))
    joined = rows.join(by_row, same, "left").select("doc_id", "text", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = [(n, pa.int64()) for n in ("unit", "start", "end")]
            kind = pa.list_(pa.struct([*place, ("first_id", batch.column("doc_id").type)]))
            counts, spans, kept = [], [], []
            for text, gone in zip(batch.column("text"), batch.column("gone"), strict=True):
                lines = text.as_py().split(separator)
                starts = [0, *accumulate(len(line) + len(separator) for line in lines)]
                first = {g["unit"]: g["first_id"] for g in gone.as_py() or []}
                counts.append(len(lines))
                spans.append(
                    [
                        {
                            "unit": i,
                            "start": starts[i],
                            "end": starts[i] + len(lines[i]),
                            "first_id": first[i],
                        }
                        for i in sorted(first)
                    ]
                )
                kept.append(separator.join(line for i, line in enumerate(lines) if i not in first))
            arrays = [batch.column("doc_id"), pa.array(counts, pa.int64())]
            arrays += [pa.array(spans, kind), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_units", "spans", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    spans = f"array<struct<unit:long,start:long,end:long,first_id:{kind}>>"
    return joined.mapInArrow(run, f"doc_id {kind}, n_units long, spans {spans}, kept string")


SQL = r"""
WITH u AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS unit FROM documents),
p AS (SELECT *, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+', ' ', 'g')) AS plain FROM u),
r AS (SELECT doc_id, unit, line, plain <> ''
    AND row_number() OVER (PARTITION BY plain ORDER BY doc_id NULLS LAST, unit) > 1 AS gone FROM p)
SELECT doc_id, count(*) AS n_units, count(*) FILTER (gone) AS n_removed,
  coalesce(sum(length(line)) FILTER (gone), 0)::BIGINT AS removed_chars,
  md5(coalesce(string_agg(line, chr(10) ORDER BY unit) FILTER (NOT gone), '')) AS kept_md5
FROM r GROUP BY doc_id
"""
