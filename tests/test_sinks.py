import json

from conftest import rows
from pyspark.sql import functions as F

from tidemart.operators import config
from tidemart.plans import dim
from tidemart.session import scratch_dir
from tidemart.sinks import files, writers
from tidemart.sinks.keyed import KeyedTable
from tidemart.sources import tables as sources
from tidemart.streaming.runner import run_batches, start, stream_of, with_lookups


def frame(spark, data, schema="id string, v string, n long"):
    return spark.createDataFrame(data, schema)


def test_messages(spark):
    df = frame(spark, [("a", "x", 1)])
    message = writers.as_messages(df, key=["id"], topic="t").first()
    assert json.loads(message["key"]) == {"id": "a"} and message["topic"] == "t"
    assert json.loads(message["value"]) == {"id": "a", "v": "x", "n": 1}


def test_rewritten_batch_is_not_doubled(spark):
    path = scratch_dir(spark, "once")
    write = writers.write_exactly_once(path)
    for batch_id, texts in ((0, ["a", None]), (1, ["b"]), (1, ["b"])):
        write(frame(spark, [(t,) for t in texts], "value string"), batch_id)
    assert rows(spark.read.parquet(path).select("value")) == [("",), ("a",), ("b",)]


def test_upsert_and_compaction(spark):
    path, target = scratch_dir(spark, "up"), scratch_dir(spark, "compact")
    write = writers.write_upsert(path, ["id"], ["n"])
    write(frame(spark, [("a", "old", 1), ("a", "new", 2), ("b", "only", 1)]), 0)
    write(frame(spark, [("a", "newer", 0)]), 1)
    expected = [("a", "newer", 0), ("b", "only", 1)]
    assert rows(writers.read_upsert(spark, path, ["id"])) == expected
    writers.compact_upsert(spark, path, target, ["id"])
    assert rows(writers.read_upsert(spark, target, ["id"])) == expected


def test_full_join_to_upsert_stream(spark):
    """Results of a stream, upserted by key in several micro-batches."""
    source, path, state = (scratch_dir(spark, n) for n in ("in", "out", "state"))
    for part in ([("a", "1", 1), ("b", "1", 1)], [("a", "2", 2)], [("b", "0", 0)]):
        frame(spark, part).coalesce(1).write.mode("append").parquet(source)
    stream = stream_of(spark, source, "id string, v string, n long", files_per_trigger=1)
    run_batches(stream, writers.write_upsert(path, ["id"], ["n"]), state)
    assert KeyedTable(spark, path, ["id"]).current().batch > 0
    assert rows(writers.read_upsert(spark, path, ["id"]).select("id")) == [("a",), ("b",)]


def test_running_query(spark):
    source, path, state = (scratch_dir(spark, n) for n in ("in", "out", "state"))
    frame(spark, [("a", "1", 1)]).write.parquet(source)
    running = start(
        stream_of(spark, source, "id string, v string, n long"), writers.write_append(path), state, "1 second")
    running.processAllAvailable()
    running.stop()
    assert json.loads(spark.read.text(path).first()[0])["id"] == "a"


def test_summary_columns(spark):
    path = scratch_dir(spark, "summary")
    write = writers.write_summary(["n", "id", "v", "ts"], path=path, transient=["v"])
    write(frame(spark, [("a", "x", 1)]), 0)
    written = spark.read.parquet(f"{path}/batch_id=0")
    assert written.columns == ["n", "id", "ts"] and written.where("ts > 0").count() == 1


def test_options():
    jdbc = writers.jdbc_options("jdbc:x://h/db", "t", "d.Driver")
    assert jdbc == {"url": "jdbc:x://h/db", "dbtable": "t", "batchsize": "1000", "driver": "d.Driver"}
    assert sources.kafka_source_options("h:1", "t", 5)["maxOffsetsPerTrigger"] == "5"
    assert writers.kafka_sink_options("h:1", "t")["kafka.enable.idempotence"] == "true"


def test_dim_schema():
    schema = writers.dim_schema({"sink_columns": "id,a", "sink_pk": None})
    assert [(f.name, f.nullable) for f in schema] == [("id", False), ("a", True)]


def rule(source, sink, columns, pk, ms):
    after = {"source_table": source, "sink_table": sink, "sink_columns": columns, "sink_pk": pk}
    return (json.dumps({"after": after, "op": "r", "ts_ms": ms}),)


def test_dim_tables_follow_rules_and_batches(spark):
    root = scratch_dir(spark, "dim")
    texts = [rule("brand", "dim_brand", "id,name", None, 1), rule("shop", "dim_shop", "code,x", "code", 1)]

    def records():
        return sources.read_config_cdc(spark.createDataFrame(texts, "value string"))

    def feed(*changes):
        lines = [
            (json.dumps({"database": "m", "table": t, "type": k, "ts": ts, "data": d}),) for t, k, ts, d in changes]
        return sources.read_change_feed(spark.createDataFrame(lines, "value string"))

    brand = {"sink_table": "dim_brand", "sink_columns": "id,name", "sink_pk": "id"}
    shop = {"sink_table": "dim_shop", "sink_columns": "code,x", "sink_pk": "code"}
    dim.make_dim_tables(spark, root, dim.latest_config(records()))
    assert writers.read_dim(spark, root, brand).count() == 0
    write = dim.write_dims(root, records)
    write(feed(
        ("brand", "bootstrap-insert", 1, {"id": "1", "name": "a", "logo": "z"}),
        ("brand", "update", 3, {"id": "1", "name": "c"}), ("brand", "update", 2, {"id": "1", "name": "b"}),
        ("brand", "delete", 9, {"id": "1"}), ("shop", "insert", 1, {"code": "k'k", "x": "1"}),
        ("other", "insert", 1, {"id": "5"})), 0)
    assert rows(writers.read_dim(spark, root, brand)) == [("1", "c")]
    texts.append(rule("other", "dim_brand", "id,name", "id", 2))
    write(feed(("other", "insert", 1, {"id": "5", "name": "n"}), ("shop", "update", 2, {"code": "k'k", "x": "2"})), 1)
    assert rows(writers.read_dim(spark, root, brand)) == [("1", "c"), ("5", "n")]
    assert rows(writers.read_dim(spark, root, shop)) == [("k'k", "2")]


def test_dim_changes_set_only_their_columns(spark):
    """Within a batch and between batches; a null that is sent is a value."""
    root = scratch_dir(spark, "dim")
    rule_text = [rule("shop", "dim_shop", "id,a,b,c", None, 1)]
    write = dim.write_dims(root, lambda: sources.read_config_cdc(spark.createDataFrame(rule_text, "value string")))

    def feed(*changes):
        lines = [(json.dumps({"database": "m", "table": "shop", "type": "update", "ts": ts, "data": d}),) for ts, d in changes]
        return sources.read_change_feed(spark.createDataFrame(lines, "value string"))

    write(feed((1, {"id": "1", "a": "x", "b": "y", "c": "z"}), (2, {"id": "1", "b": "y2"})), 0)
    write(feed((3, {"id": "1", "c": None}), (3, {"a": "keyless"})), 1)
    shop = {"sink_table": "dim_shop", "sink_columns": "id,a,b,c", "sink_pk": "id"}
    assert rows(writers.read_dim(spark, root, shop)) == [("1", "x", "y2", None)]
    assert rows(spark.read.parquet(f"{root}/_keyless").select("data")) == [({"a": "keyless"},)]


def test_rules_need_their_key_among_the_columns(spark):
    """Rows of such a rule would all have the same, empty key."""
    root = scratch_dir(spark, "dim")
    texts = [rule("brand", "dim_brand", "name,logo", None, 1), rule("shop", "dim_shop", "id,x", None, 1)]
    records = sources.read_config_cdc(spark.createDataFrame(texts, "value string"))
    rules = dim.latest_config(records)
    assert rows(config.lacks_key(rules).select("sink_table")) == [("dim_brand",)]
    lines = [(json.dumps({"database": "m", "table": t, "type": "insert", "ts": 1, "data": {"id": str(i), "x": "v"}}),)
             for t in ("brand", "shop") for i in range(5)]
    dim.write_dims(root, lambda: records)(sources.read_change_feed(spark.createDataFrame(lines, "value string")), 0)
    shop = {"sink_table": "dim_shop", "sink_columns": "id,x", "sink_pk": "id"}
    assert writers.read_dim(spark, root, shop).count() == 5
    assert [n for n in files.names(spark, root) if not n.startswith("_")] == ["dim_shop"]


def test_stored_columns_are_the_rules(spark):
    """An added column is null in old rows and filled in new ones; the files have these columns."""
    root = scratch_dir(spark, "dim")
    narrow = {"sink_table": "dim_shop", "sink_columns": "id,a", "sink_pk": None}
    wide = {"sink_table": "dim_shop", "sink_columns": "id,a,b", "sink_pk": None}
    assert writers.ensure_dim_table(spark, root, narrow).names == ["id", "a"]
    routed = "sink_table string, sink_key string, data map<string,string>, ts long"
    write = writers.write_dim_routed(root)
    write(spark.createDataFrame([("dim_shop", "1", {"id": "1", "a": "x"}, 1)], routed), 0)
    assert writers.ensure_dim_table(spark, root, wide).names == ["id", "a", "b"]
    assert rows(writers.read_dim(spark, root, wide)) == [("1", "x", None)]
    write(spark.createDataFrame([("dim_shop", "1", {"id": "1", "b": "y"}, 2), ("dim_shop", "2", {"id": "2"}, 2)], routed), 1)
    assert rows(writers.read_dim(spark, root, wide)) == [("1", "x", "y"), ("2", None, None)]
    parts = [n for n in files.names(spark, f"{root}/dim_shop") if n.startswith("part-")]
    stored = {tuple(c for c in spark.read.parquet(f"{root}/dim_shop/{n}").columns if c[0] != "_") for n in parts}
    assert stored == {("id", "a"), ("id", "a", "b")}


def test_changes_of_one_second_keep_their_order(spark):
    """The position in the source decides, in facts and in dimensions."""
    root, path = scratch_dir(spark, "dim"), scratch_dir(spark, "up")
    order = [("9", 2), ("7", 0), ("8", 1)]
    routed = [("t", "k", {"id": "k", "v": v}, 5, {"offset": at}) for v, at in order]
    frame5 = spark.createDataFrame(
        routed, "sink_table string, sink_key string, data map<string,string>, ts long, position struct<offset:long>"
    )
    writers.write_dim_routed(root)(frame5, 0)
    table = {"sink_table": "t", "sink_columns": "id,v", "sink_pk": "id"}
    assert rows(writers.read_dim(spark, root, table)) == [("k", "9")]
    facts = frame5.selectExpr("sink_key AS id", "data['v'] AS v", "ts AS version", "position")
    writers.write_upsert(path, ["id"], ["version"])(facts, 0)
    assert rows(writers.read_upsert(spark, path, ["id"]).select("v")) == [("9",)]


def test_lookups_see_a_growing_dictionary(spark):
    """A code that comes between two micro-batches of one running stream is found."""
    source, out, state, names = (scratch_dir(spark, n) for n in ("in", "out", "state", "names"))
    schema = "dic_code string, dic_name string, parent_code string, create_time timestamp, operate_time timestamp"

    def entry(code):
        spark.createDataFrame([(code, code.upper(), "0", None, None)], schema).write.mode("append").parquet(names)

    entry("a")
    frame(spark, [("1", "a", 1)]).write.parquet(source)
    write = with_lookups(writers.write_append(out), lambda: sources.read_lookup(spark, names), {"v": "name"})
    running = start(stream_of(spark, source, "id string, v string, n long"), write, state, "1 second")
    running.processAllAvailable()
    entry("b")
    frame(spark, [("2", "b", 2)]).write.mode("append").parquet(source)
    running.processAllAvailable()
    running.stop()
    found = [json.loads(r[0]) for r in spark.read.text(out).select("value").collect()]
    assert sorted((r["id"], r["name"]) for r in found) == [("1", "A"), ("2", "B")]


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert spark.range(1).select(F.lit(1)).count() == 1
