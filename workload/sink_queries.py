"""Sinks: write what Spark derives from the tables, read it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.operators import changes, config, summaries, visits
from tidemart.plans import dim, summary
from tidemart.session import scratch_dir
from tidemart.sinks import files, keyed, writers
from tidemart.sources import tables as sources
from workload import adapters as a
from workload import oracle as o
from workload.oracle import BASE, txt, with_ctes
from workload.registry import query


@query(
    "write_append",
    with_ctes("SELECT mid, is_new, page_id, ts FROM page", "page"),
)
def write_append(spark, d):
    path = scratch_dir(spark, "append")
    writers.write_append(path)(a.page_log(spark, d).select("common", "page", "ts"), 0)
    back = spark.read.text(path)
    record = F.from_json(
        "value", "common struct<mid:string,is_new:string>, page struct<page_id:string>, ts bigint"
    )
    return back.select(record.alias("r")).select("r.common.*", "r.page.page_id", "r.ts")


@query(
    "write_exactly_once",
    "SELECT doc_id % 2 AS batch_id, md5(CASE WHEN doc_id % 7 = 0 THEN '' ELSE text END) AS text FROM documents",
)
def write_exactly_once(spark, d):
    """Two batches, the second written twice as after a failure."""
    path = scratch_dir(spark, "once")
    documents = a.table(spark, d, "documents")
    write = writers.write_exactly_once(path)
    for batch_id in (0, 1, 1):
        part = documents.where(F.col("doc_id") % 2 == batch_id)
        write(part.select(F.when(F.col("doc_id") % 7 != 0, F.col("text")).alias("value")), batch_id)
    return spark.read.parquet(path).select(
        F.col("batch_id").cast("bigint").alias("batch_id"), F.md5("value").alias("text")
    )


def _order_states(spark, d):
    feed = a.change_feed(spark, d, "order_info")
    version = F.col("ts").cast("bigint").alias("version")
    return changes.cdc_filter(
        feed, "order_info", ["id", "order_status", version], types=("insert", "update")
    )


LATEST_ORDER = with_ctes(
    "SELECT id, max_by(order_status, version) AS order_status, max(version) AS version"
    " FROM order_info GROUP BY id",
    "order_info",
)


@query("write_upsert", LATEST_ORDER)
def write_upsert(spark, d):
    """Inserts and updates as two batches, the updates written twice."""
    path = scratch_dir(spark, "upsert")
    states = _order_states(spark, d)
    write = writers.write_upsert(path, ["id"], ["version"])
    write(states.where("order_status = '1001'"), 0)
    for _ in range(2):
        write(states.where("order_status <> '1001'"), 1)
    return writers.read_upsert(spark, path, ["id"])


@query("latest_by_key", LATEST_ORDER)
def latest_by_key(spark, d):
    return changes.latest_by_key(_order_states(spark, d), ["id"], ["version"])


@query(
    "write_dim_routed",
    f"""SELECT 'customer' AS source, {txt('c_custkey')} AS id, c_name AS name,
      CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS detail FROM customer
    UNION ALL SELECT 'supplier', {txt('s_suppkey')}, s_name, {txt('s_nationkey')} FROM supplier
    UNION ALL SELECT 'part', {txt('p_partkey')}, p_name, p_brand FROM part
    UNION ALL SELECT 'nation', {txt('n_nationkey')}, n_name, NULL FROM nation""",
)
def write_dim_routed(spark, d):
    """All dimension tables, written by one batch writer and read table by table."""
    root = scratch_dir(spark, "dim")
    rules = config.latest_config(sources.read_config_cdc(a.rule_messages(spark)))
    dim.make_dim_tables(spark, root, rules)
    feed = a.change_feed(spark, d, "customer", "supplier", "part", "nation", "region")
    write = dim.write_dims(root, lambda: sources.read_config_cdc(a.rule_messages(spark)))
    write(feed, 0)
    return dim_tables(spark, root, rules)


def dim_tables(spark, root, rules):
    """All dimension tables as one."""
    detail = {"customer": "segment", "supplier": "nation", "part": "brand", "nation": None}
    parts = []
    for rule in rules.toLocalIterator():
        table = writers.read_dim(spark, root, rule.asDict())
        key, name = table.columns[:2]
        extra = detail[rule["source_table"]]
        parts.append(
            table.select(
                F.lit(rule["source_table"]).alias("source"),
                F.col(key).alias("id"),
                F.col(name).alias("name"),
                (F.col(extra) if extra else F.lit(None).cast("string")).alias("detail"),
            )
        )
    return changes.union_streams(*parts)


@query(
    "ensure_dim_table",
    "SELECT c_mktsegment AS segment, unnest(['k' || max(c_nationkey), 'name', 'added']) AS name,"
    " unnest([0, 1, 2]) AS place FROM customer GROUP BY 1",
)
def ensure_dim_table(spark, d):
    """The stored columns of one table per segment, named after the customers' nations, as the files
    have them; each rule gains a column after its table was made."""
    root = scratch_dir(spark, "ensure")
    first = F.concat(F.lit("k"), F.max("c_nationkey"))
    rules = a.table(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("sink_table")).agg(first.alias("sink_pk"))
    for more in (",name", ",name,added"):
        dim.make_dim_tables(spark, root, rules.withColumn("sink_columns", F.concat("sink_pk", F.lit(more))))
    rows = []
    for segment in (n for n in files.names(spark, root) if not n.startswith("_")):
        held = writers.dim_table(spark, root, segment).current()
        stored = spark.read.parquet(f"{root}/{segment}/{held.names[-1]}").columns
        rows += [(segment, name, i) for i, name in enumerate(c for c in stored if not c.startswith("_"))]
    return spark.createDataFrame(rows, "segment string, name string, place int")


@query(
    "write_upsert_folded",
    LATEST_ORDER.replace("max(version) AS version", "max(version) AS version, true AS few_files"),
)
def write_upsert_folded(spark, d):
    """Forty batches, inserts and then updates; ``few_files`` says that a read meets no more parts
    than a few batches would leave."""
    path = scratch_dir(spark, "folded")
    states = _order_states(spark, d).withColumn("part", F.pmod(F.col("id").cast("bigint"), F.lit(20)))
    write = writers.write_upsert(path, ["id"], ["version"])
    most = 0
    table = keyed.KeyedTable(spark, path, ["id"], ["version"])
    for batch_id in range(40):
        kind = "order_status = '1001'" if batch_id < 20 else "order_status <> '1001'"
        write(states.where(f"part = {batch_id % 20} AND {kind}").drop("part"), batch_id)
        most = max(most, len(table.current().parts))
    return table.read().withColumn("few_files", F.lit(most <= (keyed.LEVELS - 1) * (keyed.FAN - 1) + 1))


@query(
    "dim_partial_upsert",
    f"""SELECT {txt('o_custkey')} AS id, max_by(o_orderpriority, o_orderkey) AS a,
      max_by(o_orderstatus, o_orderkey) FILTER (o_orderkey % 2 = 0) AS b,
      CAST(max(o_orderkey) FILTER (o_orderkey % 3 = 0) AS VARCHAR) AS c
    FROM orders GROUP BY o_custkey""",
)
def dim_partial_upsert(spark, d):
    """Customers' last orders: each change sets the columns it has, in two batches."""
    root = scratch_dir(spark, "partial")
    key = F.col("o_orderkey")

    def entry(name, value):
        return F.struct(F.lit(name).alias("k"), value.alias("v"))

    entries = F.array(
        entry("id", a.text_of(F.col("o_custkey"))),
        entry("a", F.col("o_orderpriority")),
        F.when(key % 2 == 0, entry("b", F.col("o_orderstatus"))),
        F.when(key % 3 == 0, entry("c", a.text_of(key))),
    )
    routed = a.table(spark, d, "orders").select(
        F.lit("dim_buyer").alias("sink_table"),
        a.text_of(F.col("o_custkey")).alias("sink_key"),
        F.map_from_entries(F.array_compact(entries)).alias("data"),
        key.alias("ts"),
    )
    middle = routed.agg(F.percentile_approx("ts", 0.5)).first()[0]
    write = writers.write_dim_routed(root)
    write(routed.where(F.col("ts") <= middle), 0)
    write(routed.where(F.col("ts") > middle), 1)
    rule = {"sink_table": "dim_buyer", "sink_columns": "id,a,b,c", "sink_pk": "id"}
    return writers.read_dim(spark, root, rule)


@query(
    "dim_key_outside_columns",
    f"SELECT {txt('s_suppkey')} AS code, s_name AS name FROM supplier",
)
def dim_key_outside_columns(spark, d):
    """A rule without its key among the columns makes no table; the other one keeps every row."""
    root = scratch_dir(spark, "keys")
    rules = spark.createDataFrame(
        [
            ("customer", "dim_customer", "name,segment", "id"),
            ("supplier", "dim_supplier", "code,name", "code"),
        ],
        "source_table string, sink_table string, sink_columns string, sink_pk string",
    )
    rows = a.change_feed(spark, d, "customer", "supplier")
    code = F.map_from_arrays(F.array(F.lit("code")), F.array(F.col("data")["id"]))
    coded = rows.withColumn("data", F.map_concat("data", code))
    routed = config.config_broadcast_join(changes.cdc_upserts_only(coded), config.has_key(rules))
    writers.write_dim_routed(root)(routed, 0)
    tables = [r["sink_table"] for r in config.has_key(rules).toLocalIterator()]
    parts = [
        writers.read_dim(spark, root, {"sink_table": t, "sink_columns": "code,name", "sink_pk": "code"})
        for t in tables
    ]
    return changes.union_streams(*parts)


SUMMARY_COLUMNS = ["stt", "edt", *summaries.TRAFFIC_KEYS, *summaries.MEASURES, "ts"]


@query("write_summary", with_ctes(o.traffic(3600), "visitor", "jump"))
def write_summary(spark, d):
    path = scratch_dir(spark, "summary")
    pages = a.page_log(spark, d)
    measures = summaries.traffic_measures(pages, visits.unique_visitor(pages), visits.user_jump(pages))
    writers.write_summary(SUMMARY_COLUMNS, path=path)(
        summaries.traffic_window_sum(measures, "1 hour"), 0
    )
    back = spark.read.parquet(path)
    return back.where(F.col("ts") > BASE).drop("ts", "batch_id")


@query(
    "write_keyword_summary",
    with_ctes(
        f"SELECT {o.bounds('second // 10 * 10', 10)}, 'search' AS source, word AS keyword,"
        " count(*) AS keyword_count, true AS whole_second FROM keyword GROUP BY ALL",
        "keyword",
    ),
)
def write_keyword_summary(spark, d):
    """The keyword summary as its job writes it: stamped with the whole second of the writing."""
    path = scratch_dir(spark, "keywords")
    columns = ["stt", "edt", "source", "keyword", "keyword_count", "ts"]
    write = writers.write_summary(columns, path=path, whole_seconds=True)
    write(summary.keyword_page_view_window(a.search_pages(spark, d)), 0)
    back = spark.read.parquet(f"{path}/batch_id=0")
    return back.withColumn("whole_second", (F.col("ts") % 1000 == 0) & (F.col("ts") > BASE * 1000)).drop("ts")


@query(
    "write_messages",
    f"SELECT 'orders' AS topic, '{{\"id\":\"' || o_orderkey || '\"}}' AS key, {txt('o_orderkey')} AS id,"
    f" {txt('o_custkey')} AS user_id FROM orders",
)
def write_messages(spark, d):
    """Keyed JSON messages for a topic, through files."""
    path = scratch_dir(spark, "messages")
    feed = a.change_feed(spark, d, "order_info")
    rows = changes.cdc_filter(feed, "order_info", ["id", "user_id"])
    writers.write_messages("orders", ["id"], fmt="parquet", path=path)(rows, 0)
    record = F.from_json("value", "id string, user_id string").alias("r")
    return spark.read.parquet(path).select("topic", "key", record).select("topic", "key", "r.*")


@query(
    "drop_transient",
    f"SELECT {txt('o_orderkey')} AS id, {txt('o_custkey')} AS user_id FROM orders",
)
def drop_transient(spark, d):
    """Rows as a sink writes them without the columns that only later steps of the job need."""
    path = scratch_dir(spark, "transient")
    feed = a.change_feed(spark, d, "order_info")
    rows = changes.cdc_filter(feed, "order_info", ["id", "user_id", "province_id", "total_amount"])
    columns = ["id", "province_id", "user_id", "total_amount", "ts"]
    write = writers.write_summary(columns, path=path, transient=["province_id", "total_amount", "ts"])
    write(rows, 0)
    return spark.read.parquet(f"{path}/batch_id=0")


@query(
    "read_lookup",
    with_ctes("SELECT dic_code, dic_name, '0' AS parent_code FROM dic", "dic"),
)
def read_lookup(spark, d):
    path = scratch_dir(spark, "dictionary")
    a.dictionary(spark, d).write.parquet(path)
    return sources.read_lookup(spark, path).select("dic_code", "dic_name", "parent_code")
