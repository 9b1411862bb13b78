"""Fill-in-the-middle: texts cut in three and put in another order, over seekable frames.

A text is stored as independent zstandard frames of FRAME code points with the number of code points
before each. A cut opens only the frame it falls into; the other frames go into the new order as they
are. Digests read the frames in their order, one at a time, and never hold a whole text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.tables import narrow, stored

FRAME = 1 << 14
#: The markers, in the order prefix, suffix, middle.
MARKERS = ("<P>", "<S>", "<M>")
FRAMES = "array<struct<start:long,units:int,data:binary>>"
_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("units", pa.int32()), ("data", pa.binary())]))

Frame = dict  # start, units, data
_pack = zstandard.ZstdCompressor(level=3)
_open = zstandard.ZstdDecompressor()


def packed(text: str) -> bytes:
    return _pack.compress(text.encode("utf-8", "surrogatepass"))


def opened(frame: Frame) -> str:
    return _open.decompress(frame["data"]).decode("utf-8", "surrogatepass")


def frames_of(text: str, size: int = FRAME) -> list[Frame]:
    return placed((part, packed(part)) for at in range(0, len(text), size) for part in [text[at : at + size]])


def placed(parts) -> list[Frame]:
    """``(text or its length, data)`` end to end, as frames."""
    out, start = [], 0
    for part, data in parts:
        units = part if isinstance(part, int) else len(part)
        out.append({"start": start, "units": units, "data": data})
        start += units
    return out


def section(frames: list[Frame], begin: int, end: int) -> list[tuple[int, bytes]]:
    """``(units, data)`` of the code points from ``begin`` to ``end``; only cut frames are opened."""
    out = []
    for frame in frames:
        a, b = max(begin - frame["start"], 0), min(end - frame["start"], frame["units"])
        if a >= b:
            continue
        whole = a == 0 and b == frame["units"]
        out.append((b - a, frame["data"] if whole else packed(opened(frame)[a:b])))
    return out


def arranged(frames: list[Frame], n: int, form: str, first: int, second: int) -> list[Frame]:
    """The frames of a text in the order of ``form``, with markers."""
    if form == "plain":
        return frames
    p, s, m = ((len(mark), packed(mark)) for mark in MARKERS)
    prefix, middle = section(frames, 0, first), section(frames, first, second)
    suffix = section(frames, second, n)
    if form == "psm":
        return placed([p, *prefix, s, *suffix, m, *middle])
    return placed([s, *suffix, p, *prefix, m, *middle])


def marker_places(frames: list[Frame], markers: list[str]) -> list[int]:
    """Where the markers begin, each one looked for behind the one before it."""
    out: list[int] = []
    rest, start = "", 0  # what may hold the begin of a marker, and its place
    wanted = list(markers)
    for frame in frames:
        rest += opened(frame)
        while wanted:
            at = rest.find(wanted[0])
            keep = len(rest) - len(wanted[0]) + 1 if at < 0 else at + len(wanted[0])
            if at >= 0:
                out.append(start + at)
                wanted.pop(0)
            keep = max(keep, 0)
            rest, start = rest[keep:], start + keep
            if at < 0:
                break
        if not wanted:
            break
    return out


def restored(frames: list[Frame], form: str) -> list[Frame]:
    """The frames of the text that ``arranged`` was made from, from its frames and form alone."""
    if form == "plain":
        return frames
    n = frames[-1]["start"] + frames[-1]["units"]
    p, s, m = MARKERS
    a, b, c = marker_places(frames, [p, s, m] if form == "psm" else [s, p, m])
    one, two = section(frames, a + 3, b), section(frames, b + 3, c)
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    return placed([*prefix, *section(frames, c + 3, n), *suffix])


def digest(frames: list[Frame]) -> str:
    """SHA-256 of the text in UTF-8, lower-case hex."""
    made = hashlib.sha256()
    for frame in frames:
        made.update(_open.decompress(frame["data"]))
    return made.hexdigest()


def framed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = FRAME) -> DataFrame:
    """``(doc_id, n, marked, frames)``: code points, whether a marker occurs, and the frames.

    A null text counts as empty: no frames.
    """
    texts = narrow(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A few rows at a time: long texts exist once as text and once as frames.
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t.as_py() or "" for t in part.column("text")]
                arrays = [
                    part.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([any(mark in t for mark in MARKERS) for t in texts], pa.bool_()),
                    pa.array([frames_of(t, size) for t in texts], _ARROW),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "marked", "frames"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, n long, marked boolean, frames {FRAMES}")


def _draws(doc_id: str, seed: int) -> list[Column]:
    """The first four 8-digit groups of the SHA-256 of ``seed:id``, as whole numbers."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    code = F.sha2(text, 256)
    return [F.conv(F.substring(code, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def planned(marked: DataFrame, seed: int, percent: int, spm_percent: int) -> DataFrame:
    """Adds ``form`` and the lengths ``prefix_chars`` and ``middle_chars`` to ``framed`` rows."""
    h1, h2, h3, h4 = _draws("doc_id", seed)
    plain = (F.col("n") == 0) | F.col("marked") | (h3 % 100 >= percent)
    a, b = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    cut = marked.withColumn("form", form)
    unless = F.col("form") != "plain"
    return cut.withColumns(
        {
            "prefix_chars": F.when(unless, F.least(a, b)),
            "middle_chars": F.when(unless, F.greatest(a, b) - F.least(a, b)),
        }
    )


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 1,
    percent: int = 90,
    spm_percent: int = 20,
    size: int = FRAME,
) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, frames)``: each text in its new order.

    Two draws by the id's hash cut the ``n`` code points into prefix, middle and suffix. ``percent``
    of the texts are changed: ``spm_percent`` of these to ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
    (spm), the others to ``<P>`` prefix ``<S>`` suffix ``<M>`` middle (psm). Empty texts, null texts
    and those that hold a marker stay (plain; the lengths are null). ``frames`` is the output;
    ``texts`` makes a column of text of it, ``restore`` gives the original frames.

    Frames are written to the shared folder once and read again for the cuts. Rows that repeat an id
    are cut by the same draws; a null id draws as an empty one. An empty table gives an empty result;
    other columns are left out.
    """
    plan = planned(stored(framed(docs, id_col, text_col, size), "frames"), seed, percent, spm_percent)
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = part.select(["n", "form", "prefix_chars", "middle_chars", "frames"]).to_pylist()
                made = []
                for row in rows:
                    first = row["prefix_chars"] or 0
                    second = first + (row["middle_chars"] or 0)
                    made.append(arranged(row["frames"], row["n"], row["form"], first, second))
                yield pa.RecordBatch.from_arrays(
                    [*part.select(columns).columns, pa.array(made, _ARROW)], names=[*columns, "frames"]
                )

    kind = plan.schema["doc_id"].dataType.simpleString()
    return plan.select(*columns, "frames").mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, frames {FRAMES}"
    )


def _per_row(changed: DataFrame, column: str, kind: str, arrow: pa.DataType, function) -> DataFrame:
    """Adds ``column``: ``function(frames, form)`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                frames, forms = part.column("frames"), part.column("form").to_pylist()
                made = [function(f.as_py(), form) for f, form in zip(frames, forms, strict=True)]
                kept = [part.column(c) for c in part.schema.names if c != column]
                names = [c for c in part.schema.names if c != column]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(made, arrow)], names=[*names, column])

    rest = [f"`{f.name}` {f.dataType.simpleString()}" for f in changed.schema.fields if f.name != column]
    return changed.mapInArrow(run, ", ".join([*rest, f"`{column}` {kind}"]))


def restore(changed: DataFrame) -> DataFrame:
    """The rows of ``transform`` with the ``frames`` of the original texts again.

    Only ``frames`` and ``form`` are used: markers are looked for in the output itself.
    """
    return _per_row(changed, "frames", FRAMES, _ARROW, restored)


def texts(changed: DataFrame, column: str = "text") -> DataFrame:
    """Adds the text that ``frames`` hold."""
    return _per_row(changed, column, "string", pa.string(), lambda frames, _: "".join(map(opened, frames)))


def with_digests(changed: DataFrame) -> DataFrame:
    """Adds ``output_sha256`` and ``restored_sha256`` to ``transform`` rows, in place of the frames."""

    def both(frames: list[Frame], form: str) -> list[str]:
        return [digest(frames), digest(restored(frames, form))]

    made = _per_row(changed, "both", "array<string>", pa.list_(pa.string()), both)
    return made.select(
        *(c for c in made.columns if c not in ("frames", "both")),
        F.col("both")[0].alias("output_sha256"),
        F.col("both")[1].alias("restored_sha256"),
    )


SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS code FROM documents),
h AS (SELECT doc_id, x, length(x)::BIGINT AS n, [('0x' || substr(code, 8 * i + 1, 8))::BIGINT FOR i IN range(4)] AS h FROM t),
c AS (SELECT doc_id, x, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
    WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(x, 1, a) AS pre, substr(x, a + 1, b - a) AS mid, substr(x, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(x) AS restored_sha256
FROM p
"""
