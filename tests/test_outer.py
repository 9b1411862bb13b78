"""Early outer joins: the keyed table after each micro-batch against the join of all rows so far."""

import datetime

import pytest
from conftest import rows

from tidemart.session import scratch_dir
from tidemart.sinks import writers
from tidemart.streaming.outer import upsert_join
from tidemart.streaming.runner import Lookup, run_batches, stream_of

LEFT = "l_id string, k string, l_et timestamp"
RIGHT = "r_id string, r_k string, r_et timestamp"


def at(second):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=second)


def plain(left, right, how, within):
    out, met = [], set()
    for a in left:
        for b in right:
            if a[1] is not None and a[1] == b[1] and abs((a[2] - b[2]).total_seconds()) <= within:
                out.append((a[0], b[0]))
                met |= {("l", a[0]), ("r", b[0])}
    if how in ("left", "full"):
        out += [(a[0], None) for a in left if ("l", a[0]) not in met]
    if how in ("right", "full"):
        out += [(None, b[0]) for b in right if ("r", b[0]) not in met]
    return sorted(out, key=repr)


STEPS = [
    ([("a1", "x", at(0)), ("a2", "y", at(0)), ("a3", None, at(1))], [("b1", "x", at(2)), ("b2", "z", at(0))]),
    ([("a4", "z", at(4)), ("a5", "x", at(3))], [("b3", "x", at(20)), ("b4", None, at(3))]),
    ([("a6", "x", at(18)), ("a7", "q'\"null", at(18))], [("b5", "y", at(3)), ("b6", "q'\"null", at(19))]),
]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_rows_come_early_and_are_replaced(spark, how):
    left, right, path, state = (scratch_dir(spark, n) for n in ("l", "r", "out", "state"))
    seen = ([], [])
    for more_left, more_right in STEPS:
        spark.createDataFrame(more_left, LEFT).coalesce(1).write.mode("append").parquet(left)
        spark.createDataFrame(more_right, RIGHT).coalesce(1).write.mode("append").parquet(right)
        seen[0].extend(more_left)
        seen[1].extend(more_right)
        joined = upsert_join(
            stream_of(spark, left, LEFT), stream_of(spark, right, RIGHT),
            [("k", "r_k")], (["l_id"], ["r_id"]), ("l_et", "r_et"), how, within_ms=5000, delay="1 hour",
        )
        run_batches(joined, writers.write_upsert(path, ["l_id", "r_id"], []), state)
        got = rows(writers.read_upsert(spark, path, ["l_id", "r_id"]).select("l_id", "r_id"))
        assert got == plain(*seen, how, 5)


def test_old_rows_leave_the_state_and_stay_in_the_table(spark):
    left, right, path, state = (scratch_dir(spark, n) for n in ("l", "r", "out", "state"))
    steps = [
        ([("a1", "x", at(0))], [("b0", "w", at(0))]),
        ([("a2", "v", at(100))], [("b1", "v", at(100))]),  # moves the watermark past a1 and its bound
        ([], [("b2", "v", at(101))]),
    ]
    for more_left, more_right in steps:
        spark.createDataFrame(more_left, LEFT).coalesce(1).write.mode("append").parquet(left)
        spark.createDataFrame(more_right, RIGHT).coalesce(1).write.mode("append").parquet(right)
        joined = upsert_join(
            stream_of(spark, left, LEFT), stream_of(spark, right, RIGHT),
            [("k", "r_k")], (["l_id"], ["r_id"]), ("l_et", "r_et"), "full", within_ms=5000, delay="0 seconds",
        )
        run_batches(joined, writers.write_upsert(path, ["l_id", "r_id"], []), state)
    got = rows(writers.read_upsert(spark, path, ["l_id", "r_id"]).select("l_id", "r_id"))
    assert got == [("a1", None), ("a2", "b1"), ("a2", "b2"), (None, "b0")]
    held = spark.read.format("statestore").option("stateVarName", "rows").load(state)
    assert {r["key"][0] if hasattr(r["key"], "__getitem__") else r["key"] for r in held.collect()} == {'["v"]'}


def test_a_dictionary_with_a_life_time(spark):
    """New codes are found at once; a changed name when the snapshot is too old."""
    now, entries, reads = [0.0], {"a": "A"}, []

    def read():
        reads.append(now[0])
        return spark.createDataFrame(list(entries.items()), "dic_code string, dic_name string")

    def named(*codes):
        facts = spark.createDataFrame([(c,) for c in codes], "code string")
        return dict(rows(lookup.entries(facts, ["code"])))

    lookup = Lookup(read, 60, clock=lambda: now[0])
    assert named("a", None) == {"a": "A"} and len(reads) == 1
    entries["a"] = "new"
    assert named("a") == {"a": "A"} and len(reads) == 1
    entries["b"] = "B"
    assert named("a", "b") == {"a": "new", "b": "B"} and len(reads) == 2
    entries["a"] = "newer"
    now[0] = 61.0
    assert named("a")["a"] == "newer" and len(reads) == 3
