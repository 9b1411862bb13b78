"""Splitting app log records into error, start, display, action and page records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.operators.changes import json_object

KINDS = ("error", "start", "display", "action", "page")
#: The kind of lines that are no records, beside the five.
DIRTY = "dirty"


def _common_json() -> Column:
    return F.to_json(F.col("common"))


def _entries(array: str, with_ts: bool) -> Column:
    """Each element of ``array`` with the common part and page id (and time) put into it."""
    extra = [F.lit("common"), _common_json(), F.lit("page_id"), F.col("page.page_id")]
    if with_ts:
        extra += [F.lit("ts"), F.col("ts").cast("string")]
    names = F.array(*extra[0::2])
    added = F.create_map(*extra)
    return F.transform(
        F.col(array),
        lambda e: F.map_concat(F.map_filter(e, lambda k, v: ~F.array_contains(names, k)), added),
    )


def split_log(logs: DataFrame) -> dict[str, DataFrame]:
    """The five record kinds as separate tables.

    An error record is the whole record; all others lose ``err``. A record with ``start`` gives
    no page, display or action records.
    """
    clean = logs.drop("err")
    pages = clean.where(F.col("start").isNull())
    return {
        "error": logs.where(F.col("err").isNotNull()),
        "start": clean.where(F.col("start").isNotNull()),
        "display": pages.select(F.explode(_entries("displays", True)).alias("display")),
        "action": pages.select(F.explode(_entries("actions", False)).alias("action")),
        "page": pages.drop("displays", "actions", "start"),
    }


def _as_map(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def opened_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Each line with its JSON object as variant ``record`` and what the visitor logic reads.

    A log record is an object that has a visitor id and a time and repeats no key. For other lines
    ``record``, ``common`` and ``ts`` are null.
    """
    rest = [c for c in lines.columns if c != column]
    # A generator is evaluated once per row, so a text is parsed once.
    once = F.explode(F.array(json_object(F.col(column)))).alias("_v")
    parsed = lines.select(*rest, F.col(column), once)

    def get(path: str, kind: str) -> Column:
        return F.try_variant_get("_v", path, kind)

    mid, ts = get("$.common.mid", "string"), get("$.ts", "bigint")
    common = F.struct(mid.alias("mid"), get("$.common.is_new", "string").alias("is_new"))
    good = mid.isNotNull() & ts.isNotNull()
    read = F.struct(common.alias("common"), ts.alias("ts"), F.col("_v").alias("record"))
    taken = parsed.select(*rest, F.col(column), F.explode(F.array(F.when(good, read))).alias("_r"))
    return taken.select(*rest, F.col(column), "_r.common", "_r.ts", "_r.record")


def open_records(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Log records with all fields they have, and the lines that are no records.

    A record becomes the variant ``record``; ``common`` (visitor id, mark) and ``ts`` are read out for
    the visitor logic. Other columns of ``lines`` pass through.
    """
    rest = [c for c in lines.columns if c != column]
    opened = opened_lines(lines, column)
    good = F.col("ts").isNotNull()
    return opened.where(good).select(*rest, "common", "ts", "record"), opened.where(~good).select(*rest, F.col(column))


def route_open(logs: DataFrame, dirty: str | None = None) -> DataFrame:
    """The five kinds of ``route_log`` from open records; every field keeps its value and type.

    ``common.is_new`` of the row replaces that of the record. With ``dirty``, a row without a record
    gives the text in that column as a sixth kind.
    """
    text = F.col(dirty) if dirty else F.lit(None).cast("string")
    logs = logs.select("common", "record", text.alias("_text"))

    def but(fields: Column, *names: str) -> Column:
        return F.map_filter(fields, lambda k, v: ~k.isin(*names))

    def there(name: str) -> Column:
        value = F.col("_r")[name]
        return value.isNotNull() & ~F.is_variant_null(value)

    # Further generators: the record is opened once, not for each of its kinds.
    logs = logs.select("common", "record", F.explode(F.array(_as_map(F.col("record")))).alias("_m"), "_text")
    common, mark = _as_map(F.col("_m")["common"]), F.col("common.is_new")
    # Few marks were changed; all other records stay as they are.
    same = mark.isNull() | mark.eqNullSafe(F.try_variant_get("record", "$.common.is_new", "string"))
    marked = F.map_concat(but(common, "is_new"), F.create_map(F.lit("is_new"), mark.cast("variant")))
    changed = F.create_map(F.lit("common"), F.to_variant_object(marked))
    record = F.when(same, F.col("_m")).otherwise(F.map_concat(but(F.col("_m"), "common"), changed))
    logs = logs.select(F.explode(F.array(record)).alias("_r"), "_text")

    is_start = there("start")
    page_id = F.try_variant_get(F.col("_r")["page"], "$.page_id", "variant")

    def record_of(kind: str, fields: Column, when: Column) -> Column:
        row = F.struct(F.lit(kind).alias("kind"), F.to_json(fields).alias("value"))
        return F.when(when, F.array(row))

    def entries(kind: str, array: str, **extra: Column) -> Column:
        added = F.create_map(*(x for name, value in extra.items() for x in (F.lit(name), value)))
        listed = F.try_variant_get(F.col("_r")[array], "$", "array<map<string,variant>>")
        rows = F.transform(
            F.filter(listed, lambda e: e.isNotNull()),
            lambda e: F.struct(
                F.lit(kind).alias("kind"),
                F.to_json(F.map_concat(but(e, *extra), added)).alias("value"),
            ),
        )
        return F.when(~is_start, rows)

    shared = {"common": F.col("_r")["common"], "page_id": page_id}
    parts = [
        record_of("error", F.col("_r"), there("err")),
        record_of("start", but(F.col("_r"), "err"), is_start),
        entries("display", "displays", **shared, ts=F.col("_r")["ts"]),
        entries("action", "actions", **shared),
        record_of("page", but(F.col("_r"), "err", "displays", "actions", "start"), ~is_start),
    ]
    routed = F.flatten(F.array_compact(F.array(*parts)))
    if dirty:
        line = F.array(F.struct(F.lit(DIRTY).alias("kind"), F.col("_text").alias("value")))
        routed = F.when(F.col("_r").isNull(), line).otherwise(routed)
    return logs.select(F.explode(routed).alias("r")).select("r.kind", "r.value")


def route_log(logs: DataFrame) -> DataFrame:
    """The same five kinds as rows ``(kind, value)`` with JSON text, made in one pass.

    A sink that writes by ``kind`` (a topic column or a partition folder) needs neither five
    scans nor a cached copy of the input.
    """
    names = [c for c in ("common", "page", "displays", "actions", "start", "err", "ts") if c in logs.columns]
    is_start = F.col("start").isNotNull()

    def record(kind: str, fields, when: Column) -> Column:
        value = F.to_json(F.struct(*[F.col(f) for f in fields]))
        return F.when(when, F.array(F.struct(F.lit(kind).alias("kind"), value.alias("value"))))

    def entries(kind: str, array: str, with_ts: bool) -> Column:
        rows = F.transform(
            _entries(array, with_ts),
            lambda e: F.struct(F.lit(kind).alias("kind"), F.to_json(e).alias("value")),
        )
        return F.when(~is_start, rows)

    without_err = [n for n in names if n != "err"]
    page_fields = [n for n in without_err if n not in ("displays", "actions", "start")]
    parts = [
        record("error", names, F.col("err").isNotNull()),
        record("start", without_err, is_start),
        entries("display", "displays", True),
        entries("action", "actions", False),
        record("page", page_fields, ~is_start),
    ]
    routed = F.flatten(F.array_compact(F.array(*parts)))
    return logs.select(F.explode(routed).alias("r")).select("r.kind", "r.value")
