"""The registered queries as SQL for DuckDB, over the same tables and the same derivations."""

from __future__ import annotations

BASE = 1704067200

DETAIL_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def stamp(column: str, add: str | None = None) -> str:
    moment = column if add is None else f"{column} + INTERVAL {add}"
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S')"


def money(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(18,2)) AS VARCHAR)"


def whole(expr: str) -> str:
    return f"CAST(CAST(round({expr}) AS BIGINT) AS VARCHAR)"


def txt(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def order_change(status: str, new: str, before: str, offset: int) -> str:
    return f"""
    SELECT {txt('o_orderkey')} AS id, 'update' AS type, '{new}' AS order_status,
      '{before}' AS old_status, {stamp('o_orderdate', '1 DAY')} AS operate_time,
      o_orderkey + {BASE + offset} AS version, o_custkey, o_totalprice, o_orderdate,
      o_orderpriority
    FROM orders WHERE o_orderstatus = '{status}'"""


CTES = {
    "dic": """
    SELECT DISTINCT c AS dic_code, 'name of ' || c AS dic_name FROM (
      SELECT l_returnflag AS c FROM lineitem UNION ALL SELECT l_linestatus FROM lineitem
      UNION ALL SELECT o_orderpriority FROM orders
      UNION ALL SELECT role FROM conversations WHERE role <> 'system')""",
    "order_info": f"""
    SELECT {txt('o_orderkey')} AS id, 'insert' AS type, '1001' AS order_status,
      NULL AS old_status, NULL AS operate_time, o_orderkey + {BASE} AS version,
      o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders
    UNION ALL {order_change('O', '1002', '1001', 600)}
    UNION ALL {order_change('F', '1003', '1001', 600)}
    UNION ALL {order_change('P', '1005', '1001', 600)}
    UNION ALL {order_change('P', '1006', '1005', 1200)}""",
    "detail": f"""
    SELECT {DETAIL_ID} AS id, {txt('l_orderkey')} AS order_id, {txt('l_partkey')} AS sku_id,
      'part ' || l_partkey AS sku_name, {money('l_extendedprice')} AS order_price,
      {whole('l_quantity')} AS sku_num, {stamp('l_shipdate')} AS create_time,
      l_returnflag AS source_type, {txt('l_suppkey')} AS source_id,
      {money('l_extendedprice')} AS split_total_amount,
      {whole('l_discount * 100')} AS split_activity_amount,
      {whole('l_tax * 100')} AS split_coupon_amount, l_orderkey + {BASE} AS et
    FROM lineitem""",
    "activity": f"""
    SELECT 'x' || {DETAIL_ID} AS id, {DETAIL_ID} AS order_detail_id,
      {whole('l_discount * 100')} AS activity_id, {txt('l_linenumber')} AS activity_rule_id
    FROM lineitem WHERE l_discount > 0""",
    "coupon": f"""
    SELECT 'x' || {DETAIL_ID} AS id, {DETAIL_ID} AS order_detail_id,
      {whole('l_tax * 100')} AS coupon_id, {txt('l_suppkey')} AS coupon_use_id
    FROM lineitem WHERE l_tax > 0""",
    "pre": """
    SELECT od.id, od.order_id, od.sku_id, od.sku_name, od.order_price, od.sku_num,
      od.create_time, od.source_type AS source_type_id, dic.dic_name AS source_type_name,
      od.source_id, od.split_total_amount, od.split_activity_amount, od.split_coupon_amount,
      'Customer ' || oi.o_custkey AS consignee, NULL::VARCHAR AS consignee_tel,
      CAST(CAST(oi.o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total_amount, oi.order_status,
      CAST(oi.o_custkey AS VARCHAR) AS user_id, oi.o_orderpriority AS payment_way,
      NULL::VARCHAR AS delivery_address, NULL::VARCHAR AS order_comment,
      NULL::VARCHAR AS out_trade_no, NULL::VARCHAR AS trade_body, oi.operate_time,
      NULL::VARCHAR AS expire_time, NULL::VARCHAR AS process_status,
      NULL::VARCHAR AS tracking_no, NULL::VARCHAR AS parent_order_id,
      CAST(oi.o_custkey % 34 AS VARCHAR) AS province_id,
      NULL::VARCHAR AS activity_reduce_amount, NULL::VARCHAR AS coupon_reduce_amount,
      NULL::VARCHAR AS original_total_amount, NULL::VARCHAR AS feight_fee,
      NULL::VARCHAR AS feight_fee_reduce, NULL::VARCHAR AS refundable_time,
      oa.id AS order_detail_activity_id, oa.activity_id, oa.activity_rule_id,
      oc.id AS order_detail_coupon_id, oc.coupon_id, oc.coupon_use_id, oi.type,
      oi.old_status, oi.version
    FROM detail od
    JOIN order_info oi ON od.order_id = oi.id
    LEFT JOIN activity oa ON od.id = oa.order_detail_id
    LEFT JOIN coupon oc ON od.id = oc.order_detail_id
    JOIN dic ON od.source_type = dic.dic_code""",
    "payment": f"""
    SELECT {txt('o_orderkey')} AS order_id, o_orderpriority AS payment_type,
      {stamp('o_orderdate', '1 HOUR')} AS callback_time
    FROM orders WHERE o_orderstatus = 'O'""",
    "refund": f"""
    SELECT {DETAIL_ID} AS id, {txt('l_suppkey')} AS user_id, {txt('l_orderkey')} AS order_id,
      {txt('l_partkey')} AS sku_id, l_linestatus AS refund_type,
      {whole('l_quantity')} AS refund_num, {money('l_extendedprice')} AS amount,
      l_returnflag AS reason_type, 'line ' || l_linenumber AS reason_txt,
      {stamp('l_shipdate')} AS create_time, {stamp('l_shipdate', '3 DAYS')} AS callback_time,
      l_orderkey
    FROM lineitem WHERE l_returnflag = 'R'""",
    "cart": f"""
    SELECT {DETAIL_ID} AS id, {txt('l_suppkey')} AS user_id, {txt('l_partkey')} AS sku_id,
      {money('l_extendedprice')} AS cart_price, 'part ' || l_partkey AS sku_name,
      {stamp('l_shipdate')} AS create_time, l_returnflag AS source_type,
      {txt('l_suppkey')} AS source_id, l_linenumber AS first_num,
      CAST(round(l_quantity) AS INTEGER) AS last_num
    FROM lineitem""",
    "page": """
    SELECT CAST(user_id AS VARCHAR) AS mid, CAST(user_id % 5 AS VARCHAR) AS ar,
      CAST(user_id % 3 AS VARCHAR) AS ch, CAST(event_id % 4 AS VARCHAR) AS vc,
      CASE WHEN event_id % 3 <> 0 THEN '1' ELSE '0' END AS is_new, event_type AS page_id,
      props AS item, CASE WHEN event_type = 'click' THEN 'keyword' END AS item_type,
      CASE WHEN event_type IN ('signup', 'view') THEN NULL
           WHEN event_type = 'click' THEN 'search' ELSE 'home' END AS last_page_id,
      CAST(round(value * 100) AS BIGINT) AS during_time, epoch_us(ts) // 1000 AS ts, event_id AS seq
    FROM events""",
    "dense_page": f"""
    SELECT * REPLACE ({BASE * 1000} + (ts - {BASE * 1000}) // 600 AS ts) FROM page""",
    "dense_visitor": """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mid,
      strftime(make_timestamp(ts * 1000), '%Y-%m-%d') ORDER BY ts, seq) AS rn
      FROM dense_page WHERE last_page_id IS NULL) WHERE rn = 1""",
    "dated": """
    SELECT *, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS day FROM page""",
    "first_seen": """
    SELECT mid, CASE WHEN is_new = '1' THEN day
      ELSE strftime(make_timestamp(ts * 1000 - 86400000000), '%Y-%m-%d') END AS first_day
    FROM (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ts, seq) AS rn FROM dated)
    WHERE rn = 1""",
    "repaired": """
    SELECT d.mid, d.ar, d.ch, d.vc, d.page_id, d.last_page_id, d.during_time, d.ts, d.seq,
      CASE WHEN d.is_new = '1' AND d.day <> f.first_day THEN '0' ELSE d.is_new END AS is_new
    FROM dated d JOIN first_seen f USING (mid)""",
    "visitor": """
    SELECT mid, ar, ch, vc, is_new, page_id, during_time, ts, seq, day FROM (
      SELECT *, lag(day) OVER (PARTITION BY mid ORDER BY ts, seq) AS before FROM dated
      WHERE last_page_id IS NULL)
    WHERE before IS NULL OR before <> day""",
    "search": f"""
    SELECT 'search' AS last_page_id, 'keyword' AS item_type, text AS item,
      (doc_id + {BASE}) * 1000 + 500 AS ts FROM documents
    UNION ALL SELECT last_page_id, item_type, item, ts FROM page""",
    "keyword": r"""
    SELECT word, ts // 1000 AS second FROM (
      SELECT unnest(string_split_regex(lower(item), '[^\p{L}\p{N}]+')) AS word, ts
      FROM search WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL)
    WHERE word <> ''""",
    "reading": """
    SELECT CAST(user_id AS VARCHAR) AS id, value AS vc, event_id AS l_seq, ts AS l_et
    FROM events WHERE event_type = 'click'""",
    "name": """
    SELECT CAST(user_id AS VARCHAR) AS id, 'sensor ' || event_id AS name, ts AS r_et
    FROM events""",
}


def jumps(timeout_ms: int, pages: str = "page") -> str:
    return f"""
    SELECT mid, ar, ch, vc, is_new, page_id, ts, seq,
      CASE WHEN next_ts IS NULL OR next_ts - ts >= {timeout_ms} THEN 'timeout'
           ELSE 'match' END AS reason
    FROM (
      SELECT *, lead(ts) OVER w AS next_ts, lead(last_page_id IS NULL) OVER w AS next_start
      FROM {pages} WINDOW w AS (PARTITION BY mid ORDER BY ts, seq))
    WHERE last_page_id IS NULL AND (next_ts IS NULL OR next_ts - ts >= {timeout_ms} OR next_start)"""


def traffic(size_s: int, prefix: str = "") -> str:
    ms = size_s * 1000
    zero = "0::BIGINT"
    return f"""
    SELECT {bounds(f'ts // {ms} * {size_s}', size_s)}, vc, ch, ar, is_new,
      CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(sv) AS BIGINT) AS sv_ct,
      CAST(sum(pv) AS BIGINT) AS pv_ct, CAST(sum(dur) AS BIGINT) AS dur_sum,
      CAST(sum(uj) AS BIGINT) AS uj_ct
    FROM (
      SELECT ts, vc, ch, ar, is_new, 1 AS uv, 0 AS sv, 0 AS pv, {zero} AS dur, 0 AS uj FROM {prefix}visitor
      UNION ALL SELECT ts, vc, ch, ar, is_new, 0, 0, 0, {zero}, 1 FROM {prefix}jump
      UNION ALL SELECT ts, vc, ch, ar, is_new, 0, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END,
        1, during_time, 0 FROM {prefix}page)
    GROUP BY ALL"""


CTES["jump"] = jumps(10_000)
CTES["dense_jump"] = jumps(10_000, "dense_page")
CTES["jump_hours"] = jumps(4 * 3_600_000)

NEEDS = {
    "pre": ["dic", "order_info", "detail", "activity", "coupon"],
    "dated": ["page"],
    "first_seen": ["dated"],
    "repaired": ["dated", "first_seen"],
    "visitor": ["dated"],
    "jump": ["page"],
    "jump_hours": ["page"],
    "dense_page": ["page"],
    "dense_visitor": ["dense_page"],
    "dense_jump": ["dense_page"],
    "search": ["page"],
    "keyword": ["search"],
}


def bounds(second: str, size_s: int) -> str:
    start = f"make_timestamp(({second}) * 1000000)"
    end = f"make_timestamp(({second} + {size_s}) * 1000000)"
    return f"{stamp(start)} AS stt, {stamp(end)} AS edt"


def with_ctes(select: str, *names: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS.get(name, []):
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    ctes = ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered)
    return f"WITH {ctes}\n{select}" if ctes else select
