"""What must not grow into one task or one call: lookups, rules, feeds and keyed state."""

import random
import re
from datetime import datetime
from pathlib import Path

import pandas as pd
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from conftest import rows
from tidemart.operators import changes, config
from tidemart.operators.summaries import WORD_BUCKETS, _counted_in_chunks
from tidemart.plans import summary, trade
from tidemart.sources.tables import read_change_feed
from tidemart.session import scratch_dir
from tidemart.streaming import processors
from tidemart.streaming.runner import run_available, stream_of, with_lookups
from workload import adapters as a
from workload import segment_queries, stream_queries


def plan_of(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def small_tables(spark, tmp_path):
    at = datetime(2024, 1, 2)
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
    names += "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    lines = [(k, 1, 2, 1, 3.0, 9.0, 0.0, 0.0, None if k == 4 else "RA"[k % 2], "O", at) for k in range(6)]
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "1-URGENT")], "o_orderkey long, o_orderpriority string").write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    spark.createDataFrame([("user",), ("system",)], "role string").write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def test_facts_are_not_dealt_by_code(spark, tmp_path):
    d = small_tables(spark, tmp_path)
    entries = a.dictionary(spark, d)
    assert rows(entries.select("dic_code", "dic_name")) == sorted(
        [(c, f"name of {c}") for c in ("1-URGENT", "A", "O", "R", "user")] + [(None, None)], key=repr
    )
    added = trade.cart_add(a.change_feed(spark, d, "cart_info"), entries)
    plan = plan_of(added)
    # The planner goes by the size of the stored codes, not by that of the tables they come from.
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Aggregate" not in plan
    # A code that is null meets no name; each other line is inserted and then raised to 3.
    assert sorted(r["id"] for r in added.collect()) == sorted(2 * [f"{k}-1-1-2" for k in (0, 1, 2, 3, 5)])


def test_changes_are_not_dealt_by_rule(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fields = "source_table string, sink_table string, sink_columns string, sink_pk string"
        rules = spark.createDataFrame([("t", "dim_t", "id,v", "id")], fields)
        feed = spark.createDataFrame(
            [("t", "5", {"id": "1", "v": "x", "w": "y"}), ("u", "5", {"id": "2"})],
            "table string, ts string, data map<string,string>",
        )
        spans = rules.select("*", F.lit(0).alias("from_ms"), F.lit(None).cast("long").alias("to_ms"), F.lit(True).alias("keyed"))
        for routed in (
            config.config_broadcast_join(feed, rules),
            config.rules_at_change(feed, spans, F.col("ts").cast("long") * 1000),
        ):
            assert "BroadcastHashJoin" in plan_of(routed)
            assert [(r["sink_table"], r["data"]) for r in routed.collect()] == [("dim_t", {"id": "1", "v": "x"})]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_messages_of_other_tables_are_not_parsed(spark):
    """By the plan and by the rows: texts that can name a table in another spelling are kept."""
    texts = [
        '{"table":"t_a","type":"insert","ts":"1","data":{"v":"1"}}',
        ' { "data" : {"v":"2"}, "ts":2, "type":"insert", "table" : "t_a" }',
        '{"table":"t\\u005fa","type":"insert","ts":"3","data":{"v":"3"}}',
        '{"table":"t_a_b","type":"insert","ts":"4","data":{"v":"no","t_a":"x"}}',
        '{"table":"u","type":"insert","ts":"5","data":{"v":"no","k":"t_a"}}',
        '{"table":7,"type":"insert","ts":"6","data":{"v":"7"}}',
        '{"table":true,"type":"insert","ts":"6","data":{"v":"8"}}',
        "t_a",
        None,
    ]
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    feed, plain = read_change_feed(lines, keep_message=True), read_change_feed(lines)
    assert "_message" not in plain.columns
    for table, values in (("t_a", "123"), ("7", "7"), ("true", "8"), ("u", ["no"]), ("none", "")):
        found = changes.cdc_filter(feed, table, ["v"], keep=["et"])
        assert rows(found) == rows(changes.cdc_filter(plain, table, ["v"], keep=["et"]))
        assert sorted(r["v"] for r in found.collect()) == sorted(values)
    # The test on the text comes before the generators that parse it.
    plan = changes.cdc_filter(feed, "t_a", ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Contains(") > plan.rindex("Generate")


def test_jobs_on_tables_keep_the_partitions(spark, tmp_path):
    """Only streams, which have a state store for each partition, get as many as there are cores."""
    d, name = small_tables(spark, tmp_path), "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "200")
    try:
        a.table(spark, d, "orders")
        assert spark.conf.get(name) == "200"
        with a.few_stores(spark):
            assert spark.conf.get(name) == "4"
        assert spark.conf.get(name) == "200"
    finally:
        spark.conf.set(name, before)


def test_flushes_are_read_by_one_query(spark, sf_dir, monkeypatch):
    """A restart for each flush would replay the state into new stores beside the old ones."""
    started, start = [], DataStreamWriter.start
    monkeypatch.setattr(DataStreamWriter, "start", lambda w, *x: started.append(1) or start(w, *x))
    found = stream_queries.full_stream_join_stream(spark, sf_dir)
    assert len(started) == 1
    # Rows that no partner came for are given by the watermark, which the flushes move.
    assert found.where("oa_id IS NULL OR oc_id IS NULL").count() > 0


def test_steps_go_on_where_the_query_is(spark):
    source, out, state = (scratch_dir(spark, n) for n in ("steps", "steps-out", "steps-state"))

    def bring(*seconds):
        rows_of = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, s),) for s in seconds], "et timestamp")
        rows_of.coalesce(1).write.mode("append").parquet(source)

    bring(1, 1, 2)
    counts = stream_of(spark, source, "et timestamp").withWatermark("et", "0 seconds").groupBy("et").count()
    run_available(counts, out, state, steps=[lambda: bring(3), lambda: bring(9, 2)], options={"compression": "zstd"})
    # What is late by then stays out. A restart goes on from the checkpoint.
    given = [(1, 2), (2, 1), (3, 1), (9, 1)]
    assert rows(spark.read.parquet(out).select(F.second("et"), "count")) == given
    run_available(counts, out, state, steps=[lambda: bring(20)])
    assert rows(spark.read.parquet(out).select(F.second("et"), "count")) == [*given[:2], (20, 1), *given[2:]]


def test_state_and_topics_are_packed(spark, monkeypatch):
    conf = "spark.sql.streaming.stateStore."
    assert spark.conf.get(conf + "compression.codec") == "zstd"
    assert spark.conf.get(conf + "rocksdb.allowFAllocate") == "false"
    # Queries that run to their end do not count the rows of their state; others still do.
    counts, start = conf + "rocksdb.trackTotalNumberOfRows", DataStreamWriter.start
    seen = []
    monkeypatch.setattr(DataStreamWriter, "start", lambda w, *x: seen.append(spark.conf.get(counts)) or start(w, *x))
    before = spark.conf.get(counts, None)
    source, out, state = (scratch_dir(spark, n) for n in ("plain", "plain-out", "plain-state"))
    spark.range(1).write.parquet(source)
    run_available(stream_of(spark, source, "id long"), out, state)
    assert seen == ["false"] and spark.conf.get(counts, None) == before != "false" and spark.read.parquet(out).count() == 1
    path = stream_queries.topic(spark, "packed", spark.range(3).select(F.col("id").cast("string").alias("value")))
    files = list(Path(path).glob("part-*"))
    assert files and all(".zstd." in f.name for f in files)
    assert rows(spark.read.parquet(path)) == [("0",), ("1",), ("2",)]


def test_words_are_sent_by_their_own_size(spark, tmp_path):
    """Many names with few words: the names' size does not make the texts' substrings be shuffled."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    parts = spark.range(20_000).select(F.xxhash64("id").alias("p_partkey"), F.lit("Red ring").alias("p_name"))
    parts.write.parquet(f"{tmp_path}/part.parquet")
    texts = spark.createDataFrame([(1, "a red bring"), (2, None)], "doc_id long, text string")
    texts.write.parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set(name, "20k")
    try:
        for job in (segment_queries.keyword_segments, segment_queries.keyword_segments_longest):
            found = job(spark, str(tmp_path))
            assert re.search(r"BroadcastHashJoin \[word#", plan_of(found))
            # "a", "red", "b", "ring"; and of "aredbring" the same.
            assert sorted(r[:4] for r in found.collect()) == [(1, False, 4, 2), (1, True, 4, 2)]
    finally:
        spark.conf.unset(name)


class Held:
    """State variables in memory that count their calls."""

    def __init__(self):
        self.calls, self.timers, self.kept = 0, set(), {}

    def _variable(self, name, *_):
        return Variable(self, self.kept.setdefault(name, {}))

    getMapState = getValueState = getListState = _variable

    def registerTimer(self, ms):
        self.timers.add(ms)


class Variable:
    def __init__(self, handle, values):
        self.handle, self.values = handle, values

    def _call(self, result=None):
        self.handle.calls += 1
        return result

    def get(self):
        return self._call(self.values.get(()))

    def update(self, value):
        self._call(self.values.__setitem__((), value))

    def clear(self):
        self._call(self.values.clear())

    def getValue(self, key):
        return self._call(self.values.get(key))

    def updateValue(self, key, value):
        self._call(self.values.__setitem__(key, value))

    def removeKey(self, key):
        self._call(self.values.pop(key))

    def iterator(self):
        return self._call(iter(list(self.values.items())))


class Clock:
    """Stands for the timer that expired, too."""

    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


def test_jumps_take_few_trips_to_the_state():
    """Many visitors of a bucket, decided by two watermarks, with a trip for a day and not for a row."""
    rng, base = random.Random(5), 1_704_067_200_000
    made = [(f"m{rng.randrange(300)}", rng.random() < 0.7, base + rng.randrange(120_000), i) for i in range(3000)]
    copies = []
    for mid, start, ts, seq in made:
        own = ts - ts % 60_000
        copies.append((f"{mid} {own}", own, ts, seq, start, str(seq) if start else None))
        if ts - own < 10_000:
            copies.append((f"{mid} {own - 60_000}", own - 60_000, ts, seq, start, None))
    frame = pd.DataFrame(copies, columns=["name", "slice", "ts", "seq", "is_start", "payload"])
    held, detector = Held(), processors.JumpDetector(10_000)
    detector.init(held)
    assert not sum(len(f) for f in detector.handleInputRows((0,), iter([frame[:2000], frame[2000:]]), Clock(0)))
    early = base + 60_500
    got = [r for f in detector.handleExpiredTimer((0,), Clock(early), Clock(early)) for r in zip(f.payload, f.reason)]
    first = len(got)
    got += [r for f in detector.handleExpiredTimer((0,), Clock(10**14), Clock(10**14)) for r in zip(f.payload, f.reason)]
    want = []
    ordered = sorted(made, key=lambda r: r[2:])
    for i, (mid, start, ts, seq) in enumerate(ordered):
        after = next((r for r in ordered[i + 1 :] if r[0] == mid), None)
        if start and (after is None or after[2] - ts >= 10_000 or after[1]):
            near = after is not None and after[2] - ts < 10_000
            want.append((str(seq), "match" if near else "timeout"))
    # The second in which the watermark less the timeout lies is not decided yet.
    assert first == sum(made[int(seq)][2] < base + 50_000 for seq, _ in want)
    assert sorted(got) == sorted(want)
    assert held.calls < 40 and not held.kept["rows"] and not held.kept["days"]


def test_first_visits_of_a_bucket_take_one_call():
    held, days = Held(), processors.FirstVisitDay()
    days.init(held)
    columns = ["mid", "part", "ts", "seq", "first_day"]
    rows_ = [(f"m{i % 300}", i % 3 - 1, 1000 - i, i, f"d{i}") for i in range(900)] + [(None, 0, 1, 1, "dn")]
    frame = pd.DataFrame(rows_, columns=columns)
    (told,) = days.handleInputRows((0,), iter([frame[:500], frame[500:]]), None)
    want = {(m, p, f"d{600 + int(m[1:])}") for m, p, *_ in rows_[:-1] if p != processors.NO_PART} | {(None, 0, "dn")}
    assert set(told.itertuples(index=False, name=None)) == want
    later = pd.DataFrame([("m0", 7, 0, 0, "other")], columns=columns)
    (told,) = days.handleInputRows((0,), iter([later]), None)
    assert list(told.itertuples(index=False, name=None)) == [("m0", 7, "d600")]


def test_an_early_outer_join_works_on_rows():
    held, join = Held(), processors.OuterJoin(True, True, 5000)
    join.init(held)

    def call(*given):
        made = iter([Row(is_left=left, id=i, ts=ts, payload=i) for left, i, ts in given])
        return sorted((tuple(r) for r in join.handleInputRows(("k",), made, None)), key=repr)

    assert call((True, "a", 0), (False, "far", 9000)) == [("a", None, False), (None, "far", False)]
    assert call((False, "b", 10)) == [("a", "b", False), ("a", None, True)]
    assert not list(join.handleExpiredTimer(("k",), Clock(6000), Clock(6000)))
    assert set(held.kept["rows"]) == {(False, "far")}


def test_words_of_a_window_are_few_rows_of_state(spark, tmp_path):
    """A word in every search, a null one and windows of many words, in two runs."""
    searches = [(f"hot w{i % 400} w{i % 7}", 1_704_067_200_000 + 20 * i) for i in range(700)]
    searches += [("none", 1_704_067_201_000), ("other hot", 1_704_067_190_000)]
    pages = [({"item": text, "item_type": "keyword", "last_page_id": "search"}, ts) for text, ts in searches]
    later = [({**pages[0][0], "item": "late"}, 4_000_000_000_000)]
    path, schema = str(tmp_path / "pages"), "page map<string,string>, ts long"
    spark.createDataFrame(pages, schema).repartition(3).write.parquet(path)

    def tokens(text):
        return F.when(text == "none", F.array(F.lit(None).cast("string"))).otherwise(F.split(text, " "))

    states = []
    for part in (None, later):
        if part:
            spark.createDataFrame(part, schema).write.mode("append").parquet(path)
        counted = summary.keyword_page_view_window(stream_of(spark, path, schema), tokenizer=tokens)
        query = (
            counted.writeStream.trigger(availableNow=True)
            .option("checkpointLocation", str(tmp_path / "state"))
            .start(str(tmp_path / "out"))
        )
        query.awaitTermination()
        states += [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    # 402 words in one window, 402 in the next, 2 in the one before.
    assert 0 < max(states) <= 3 * WORD_BUCKETS
    found = rows(spark.read.parquet(str(tmp_path / "out")))
    told = summary.keyword_page_view_window(spark.createDataFrame(pages, schema), tokenizer=tokens)
    assert found == rows(told) and len(found) > 400
    assert {r[4] for r in found if r[3] is None} == {1} and sum(r[4] for r in found if r[3] == "hot") == 701


def test_a_busy_word_is_counted_before_it_is_dealt(spark):
    words = spark.range(30_000, numPartitions=1).select(F.timestamp_seconds(F.col("id") % 2).alias("rt"), F.lit("hot").alias("word"))
    chunks = _counted_in_chunks(words, words.schema).collect()
    assert sorted(r["n"] for r in chunks) == [15_000, 15_000]


def test_rows_are_held_only_when_they_are_looked_at_twice(spark):
    """The rows of a batch for which the dictionary is read anyway go straight to the writer."""
    codes, held, out = {"a": "A"}, [], []

    def read():
        return spark.createDataFrame(list(codes.items()), "dic_code string, dic_name string")

    def batch(*values):
        return spark.createDataFrame([(c,) for c in values], "code string")

    def write(named, n):
        held.append(frames[n].is_cached)
        out.append(rows(named))

    frames = [batch("a"), batch("a", "b")]
    job = with_lookups(write, read, {"code": "name"}, max_age=3600)
    job(frames[0], 0)
    codes["b"] = "B"
    job(frames[1], 1)
    assert held == [False, True] and not frames[1].is_cached
    assert out == [[("a", "A")], [("a", "A"), ("b", "B")]]


def test_a_record_is_read_in_one_pass(spark):
    """One step takes all values out of a message, nested ones and those of another type too."""
    lines = spark.createDataFrame(
        [('{"table":"t","ts":7,"data":{"a":1.50,"b":{"z":[1,null],"y":"x"},"c":null,"d":[true]},"old":"no"}',), ("[1]",)],
        "value string",
    )
    feed = read_change_feed(lines)
    assert rows(feed.select("table", "type", "ts", "old")) == [("t", None, "7", None)]
    assert feed.first()["data"] == {"a": "1.5", "b": '{"y":"x","z":[1,null]}', "c": None, "d": "[true]"}
    plan = feed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and plan.count("try_variant_get") == 1 and "lambda" not in plan
