"""App-log operators and jobs, keywords and window summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.functions import times
from tidemart.functions.text import explode_keywords
from tidemart.operators import applog, changes, summaries, visits
from tidemart.plans import summary, traffic
from workload import adapters as a
from workload import oracle as o
from workload.oracle import BASE, bounds, with_ctes
from workload.registry import query

PAGE_COLUMNS = "mid ar ch vc is_new page_id last_page_id during_time ts seq".split()
VISIT_COLUMNS = "mid ar ch vc is_new page_id ts seq".split()


def flat(rows, *more: str):
    """Page records as plain columns."""
    return rows.select(
        *[F.col(f"common.{c}").alias(c) for c in ("mid", "ar", "ch", "vc", "is_new")],
        F.col("page.page_id").alias("page_id"),
        F.col("page.last_page_id").alias("last_page_id"),
        F.col("page.during_time").alias("during_time"),
        "ts",
        "seq",
        *more,
    )


def columns(names) -> str:
    return ", ".join(names)


@query(
    "split_valid_json",
    with_ctes(
        "SELECT 'valid' AS kind, mid AS text, seq FROM page"
        " UNION ALL SELECT 'dirty', md5(text), -1 - doc_id FROM documents",
        "page",
    ),
)
def split_valid_json(spark, d):
    valid, dirty = traffic.valid_logs(a.log_lines(spark, d))
    good = valid.select(F.lit("valid").alias("kind"), F.col("common.mid").alias("text"), "seq")
    bad = dirty.select(F.lit("dirty").alias("kind"), F.md5("value").alias("text"), "seq")
    return good.unionByName(bad)


@query(
    "session_start_filter",
    with_ctes(f"SELECT {columns(VISIT_COLUMNS)} FROM page WHERE last_page_id IS NULL", "page"),
)
def session_start_filter(spark, d):
    return flat(visits.session_start_filter(a.page_log(spark, d))).select(*VISIT_COLUMNS)


@query(
    "search_filter",
    with_ctes(
        "SELECT md5(item) AS item, ts FROM search WHERE last_page_id = 'search'"
        " AND item_type = 'keyword' AND item IS NOT NULL",
        "search",
    ),
)
def search_filter(spark, d):
    found = summaries.search_filter(a.search_pages(spark, d))
    return found.select(F.md5(F.col("page")["item"]).alias("item"), "ts")


def _routed_sql(source: str) -> str:
    """The five record kinds; ``source`` has one row per log record."""
    return f"""
    SELECT 'error' AS kind, mid, is_new, CASE WHEN page_id = 'signup' THEN NULL ELSE page_id END AS page_id,
      ts, 'code ' || seq AS detail FROM {source} WHERE page_id = 'error'
    UNION ALL SELECT 'start', mid, is_new, NULL, ts, 'icon' FROM {source} WHERE page_id = 'signup'
    UNION ALL SELECT 'display', mid, is_new, page_id, ts, CAST(i AS VARCHAR)
      FROM (SELECT *, unnest(range(1, seq % 3 + 1)) AS i FROM {source} WHERE page_id <> 'signup')
    UNION ALL SELECT 'action', mid, is_new, page_id, ts, 'buy' FROM {source} WHERE page_id = 'purchase'
    UNION ALL SELECT 'page', mid, is_new, page_id, ts, NULL FROM {source} WHERE page_id <> 'signup'"""


def _json_fields(rows):
    """What the SQL side states, taken out of the JSON text of a routed record."""

    def get(path):
        return F.get_json_object("value", path)

    common = get("$.common")
    entry = F.col("kind").isin("display", "action")
    return rows.select(
        "kind",
        F.get_json_object(common, "$.mid").alias("mid"),
        F.get_json_object(common, "$.is_new").alias("is_new"),
        F.when(entry, get("$.page_id")).otherwise(get("$.page.page_id")).alias("page_id"),
        get("$.ts").cast("bigint").alias("ts"),
        F.when(F.col("kind") == "error", get("$.err"))
        .when(F.col("kind") == "start", get("$.start.entry"))
        .when(F.col("kind") == "display", get("$.item"))
        .when(F.col("kind") == "action", get("$.action_id"))
        .alias("detail"),
    )


@query("split_log", with_ctes(_routed_sql("page"), "page"))
def split_log(spark, d):
    """The five tables, put together again for the comparison."""
    tables = applog.split_log(a.app_log(spark, d))
    rows = []
    for kind in applog.KINDS:
        part = tables[kind]
        value = part.columns[0] if kind in ("display", "action") else F.struct(*part.columns)
        rows.append(part.select(F.lit(kind).alias("kind"), F.to_json(value).alias("value")))
    return _json_fields(changes.union_streams(*rows))


@query("route_log", with_ctes(_routed_sql("page"), "page"))
def route_log(spark, d):
    return _json_fields(applog.route_log(a.app_log(spark, d)))


@query("base_log", with_ctes(_routed_sql("repaired"), "repaired"))
def base_log(spark, d):
    routed, _ = traffic.base_log(a.log_lines(spark, d))
    return _json_fields(routed)


@query(
    "log_kinds",
    with_ctes(
        f"SELECT kind, count(*) AS n, md5(string_agg(row, ' ' ORDER BY row)) AS rows_md5 FROM ("
        f"SELECT kind, concat_ws('|', kind, mid, is_new, page_id, ts, detail) AS row FROM ({_routed_sql('repaired')})"
        " UNION ALL SELECT 'dirty', 'dirty|' || md5(text) FROM documents) GROUP BY kind",
        "repaired",
    ),
)
def log_kinds(spark, d):
    """Six kinds from one frame: the routed records, and the dirty lines as they came."""
    return _kind_digests(traffic.log_kinds(a.log_lines(spark, d)))


def _kind_digests(kinds):
    records = _json_fields(kinds.where("kind <> 'dirty'"))
    label = F.concat_ws("|", "kind", "mid", "is_new", "page_id", "ts", "detail").alias("row")
    dirty = kinds.where("kind = 'dirty'").select("kind", F.concat(F.lit("dirty|"), F.md5("value")).alias("row"))
    rows = records.select("kind", label).unionByName(dirty)
    joined = F.md5(F.array_join(F.array_sort(F.collect_list("row")), " "))
    return rows.groupBy("kind").agg(F.count("*").alias("n"), joined.alias("rows_md5"))


_OPEN = "'s' || seq AS sid, 'promo' AS source_type, CAST(seq + 0.5 AS DOUBLE) AS during_time"


@query(
    "base_log_open_fields",
    with_ctes(
        f"""SELECT 'error' AS kind, mid, is_new, {_OPEN}, seq AS code, NULL::BIGINT AS item, seq AS trace, ts
          FROM repaired WHERE page_id = 'error'
        UNION ALL SELECT 'page', mid, is_new, {_OPEN}, NULL, NULL, seq, ts FROM repaired
        UNION ALL SELECT 'display', mid, is_new, 's' || seq, NULL, NULL, NULL, seq, NULL, ts FROM repaired""",
        "repaired",
    ),
)
def base_log_open_fields(spark, d):
    """Fields that no layout names, error objects and fractional numbers come through."""
    routed, _ = traffic.base_log(a.open_log_lines(spark, d))

    def get(path):
        return F.get_json_object("value", path)

    return routed.select(
        "kind",
        get("$.common.mid").alias("mid"),
        get("$.common.is_new").alias("is_new"),
        get("$.common.sid").alias("sid"),
        get("$.page.source_type").alias("source_type"),
        get("$.page.during_time").cast("double").alias("during_time"),
        get("$.err.error_code").cast("bigint").alias("code"),
        get("$.item").cast("bigint").alias("item"),
        get("$.trace.id").cast("bigint").alias("trace"),
        get("$.ts").cast("bigint").alias("ts"),
    )


@query(
    "base_log_dirty",
    "SELECT md5('{\"seq\":' || event_id || '}') AS text FROM events"
    " UNION ALL SELECT md5(text) FROM documents",
)
def base_log_dirty(spark, d):
    lines = a.open_log_lines(spark, d).unionByName(a.log_lines(spark, d))
    _, dirty = traffic.base_log(lines)
    return dirty.select(F.md5("value").alias("text"))


@query("repair_is_new", with_ctes(f"SELECT {columns(PAGE_COLUMNS)} FROM repaired", "repaired"))
def repair_is_new(spark, d):
    return flat(visits.repair_is_new(a.page_log(spark, d))).select(*PAGE_COLUMNS)


VISITOR_SQL = with_ctes(f"SELECT {columns(VISIT_COLUMNS)} FROM visitor", "visitor")
JUMP_SQL = with_ctes(f"SELECT {columns(VISIT_COLUMNS)}, reason FROM jump", "jump")


@query("unique_visitor", VISITOR_SQL)
def unique_visitor(spark, d):
    return flat(visits.unique_visitor(a.page_log(spark, d))).select(*VISIT_COLUMNS)


@query("unique_visitor_detail", VISITOR_SQL)
def unique_visitor_detail(spark, d):
    """From page records as text, as the job reads them."""
    pages = _page_texts(spark, d)
    return flat(traffic.unique_visitor_detail(traffic.page_records(pages))).select(*VISIT_COLUMNS)


@query("user_jump", JUMP_SQL)
def user_jump(spark, d):
    return flat(visits.user_jump(a.page_log(spark, d)), "reason").select(*VISIT_COLUMNS, "reason")


@query("user_jump_detail", JUMP_SQL)
def user_jump_detail(spark, d):
    pages = traffic.page_records(_page_texts(spark, d))
    return flat(traffic.user_jump_detail(pages), "reason").select(*VISIT_COLUMNS, "reason")


@query(
    "user_jump_hours",
    with_ctes(f"SELECT {columns(VISIT_COLUMNS)}, reason FROM jump_hours", "jump_hours"),
)
def user_jump_hours(spark, d):
    jumps = visits.user_jump(a.page_log(spark, d), timeout_ms=4 * 3_600_000)
    return flat(jumps, "reason").select(*VISIT_COLUMNS, "reason")


@query(
    "match_timeout_split",
    with_ctes(
        "SELECT 'matched' AS output, mid, ts, seq FROM dense_jump WHERE reason = 'match'"
        " UNION ALL SELECT 'timed out', mid, ts, seq FROM dense_jump WHERE reason = 'timeout'",
        "dense_jump",
    ),
)
def match_timeout_split(spark, d):
    matched, timed_out = visits.split_jumps(visits.user_jump(a.dense_pages(spark, d)))
    rows = [
        part.select(F.lit(name).alias("output"), "common.mid", "ts", "seq")
        for name, part in (("matched", matched), ("timed out", timed_out))
    ]
    return changes.union_streams(*rows)


@query(
    "user_jump_dense",
    with_ctes(f"SELECT {columns(VISIT_COLUMNS)}, reason FROM dense_jump", "dense_jump"),
)
def user_jump_dense(spark, d):
    """At 10 seconds, with many records that follow in time."""
    return flat(visits.user_jump(a.dense_pages(spark, d)), "reason").select(*VISIT_COLUMNS, "reason")


@query("traffic_page_view_window_dense", with_ctes(o.traffic(10, "dense_"), "dense_page", "dense_visitor", "dense_jump"))
def traffic_page_view_window_dense(spark, d):
    """Windows of 10 seconds that sum many rows."""
    pages = a.dense_pages(spark, d)
    return summary.traffic_page_view_window(pages, visits.unique_visitor(pages), visits.user_jump(pages))


def _page_texts(spark, d):
    pages = a.page_log(spark, d)
    return pages.select(F.to_json(F.struct("common", "page", "ts")).alias("value"), "seq")


@query(
    "union_streams",
    with_ctes(
        "SELECT mid, seq FROM page WHERE last_page_id IS NULL UNION ALL SELECT mid, seq FROM page"
        " UNION ALL SELECT mid, seq FROM page",
        "page",
    ),
)
def union_streams(spark, d):
    pages = a.page_log(spark, d)
    starts = visits.session_start_filter(pages)
    return changes.union_streams(starts, pages, pages).select("common.mid", "seq")


@query("explode_keywords", with_ctes("SELECT word, second FROM keyword", "keyword"))
def keywords(spark, d):
    found = summaries.search_filter(a.search_pages(spark, d))
    items = found.select(F.col("page")["item"].alias("item"), times.row_time("ts").alias("rt"))
    words = explode_keywords(items)
    return words.select("word", F.unix_seconds("rt").alias("second"))


KEYWORD_WINDOW = (
    f"SELECT {bounds('second // 10 * 10', 10)}, 'search' AS source, word AS keyword,"
    " count(*) AS keyword_count FROM keyword GROUP BY ALL"
)


@query("keyword_window_count", with_ctes(KEYWORD_WINDOW, "keyword"))
def keyword_window_count(spark, d):
    pages = a.search_pages(spark, d).withColumn("rt", times.row_time("ts"))
    items = summaries.search_filter(pages).select(F.col("page")["item"].alias("item"), "rt")
    return summaries.keyword_window_count(explode_keywords(items))


@query(
    "keyword_page_view_window",
    with_ctes(
        f"SELECT {bounds('second // 10 * 10', 10)}, 'search' AS source, word AS keyword,"
        " count(*) AS keyword_count FROM keyword GROUP BY ALL",
        "keyword",
    ),
)
def keyword_page_view_window(spark, d):
    return summary.keyword_page_view_window(a.search_pages(spark, d))


@query(
    "traffic_measures",
    with_ctes(
        """SELECT vc, ch, ar, is_new, uv_ct, sv_ct, pv_ct, dur_sum, uj_ct, ts FROM (
        SELECT *, 1::BIGINT AS uv_ct, 0::BIGINT AS sv_ct, 0::BIGINT AS pv_ct, 0::BIGINT AS dur_sum,
          0::BIGINT AS uj_ct FROM (SELECT vc, ch, ar, is_new, ts FROM visitor)
        UNION ALL SELECT vc, ch, ar, is_new, ts, 0, 0, 0, 0, 1 FROM jump
        UNION ALL SELECT vc, ch, ar, is_new, ts, 0,
          CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END, 1, during_time, 0 FROM page)""",
        "visitor",
        "jump",
    ),
)
def traffic_measures(spark, d):
    measures = summaries.traffic_measures(*_traffic(spark, d))
    ts = F.unix_millis("et").alias("ts")
    return measures.select(*summaries.TRAFFIC_KEYS, *summaries.MEASURES, ts)


def _traffic(spark, d):
    pages = a.page_log(spark, d)
    return pages, visits.unique_visitor(pages), visits.user_jump(pages)


@query("traffic_window_sum", with_ctes(o.traffic(3600), "visitor", "jump"))
def traffic_window_sum(spark, d):
    measures = summaries.traffic_measures(*_traffic(spark, d))
    return summaries.traffic_window_sum(measures, "1 hour")


@query("traffic_page_view_window", with_ctes(o.traffic(10), "visitor", "jump"))
def traffic_page_view_window(spark, d):
    return summary.traffic_page_view_window(*_traffic(spark, d))


@query(
    "scalar_functions",
    f"""SELECT event_id,
      strftime(make_timestamp(epoch_us(ts) + 28800000000), '%Y-%m-%d') AS day,
      strftime(make_timestamp(epoch_us(ts) + 28800000000), '%Y-%m-%d %H:%M:%S') AS second,
      CAST(epoch_us(date_trunc('day', ts)) // 1000 - 28800000 AS BIGINT) AS day_ms,
      CAST(epoch_us(date_trunc('second', ts)) // 1000 - 28800000 AS BIGINT) AS second_ms,
      strftime(ts, '%Y-%m-%d') AS date_id,
      epoch_us(ts) // 1000000 AS row_time, NULL::VARCHAR AS bad_date,
      CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
)
def scalar_functions(spark, d):
    events = a.table(spark, d, "events").withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    tz = "GMT+8"
    local = a.stamp("ts")
    return events.select(
        "event_id",
        times.to_date_str("ms", tz).alias("day"),
        times.to_ymdhms("ms", tz).alias("second"),
        times.to_ts(F.substring(local, 1, 10), tz=tz).alias("day_ms"),
        times.to_ts(local, full=True, tz=tz).alias("second_ms"),
        times.date_id(local).alias("date_id"),
        F.unix_seconds(times.row_time("ms")).alias("row_time"),
        times.date_id(F.col("event_type")).alias("bad_date"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
    )
