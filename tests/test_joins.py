import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemart.operators import config, joins
from tidemart.schemas import SENSOR_NAME, SENSOR_READING
from tidemart.sources.tables import read_config_cdc, read_csv_lines

LEFT = ["p,4.5,100", "p,4.75,103", "q,1.25,100", "r,7.5,90", "r,7.5,91", "t,0.5,5"]
RIGHT = ["p,gauge,99", "p,dial,103", "p,dial,110", "q,lamp,107", "r,bell,88", "r,horn,93", "u,none,5"]


def sensors(spark, left=LEFT, right=RIGHT):
    def lines(texts):
        return spark.createDataFrame([(t,) for t in texts], "value string")

    readings = read_csv_lines(lines(left), SENSOR_READING)
    names = read_csv_lines(lines(right), SENSOR_NAME)
    return (
        readings.select("id", "vc", F.timestamp_seconds("ts").alias("l_et")),
        names.select(F.col("id"), "name", F.timestamp_seconds("ts").alias("r_et")),
    )


def test_read_csv_lines_bad_parts(spark):
    df = spark.createDataFrame([("7,x,9",), ("8",)], "value string")
    assert rows(read_csv_lines(df, SENSOR_READING)) == [("7", None, 9), ("8", None, None)]


@pytest.mark.parametrize("bounds", [(-5000, 5000), (0, 0), (-1000, 0), (-2500, 7000), (1000, 2000)])
def test_interval_join_is_brute_force(spark, bounds):
    left, right = sensors(spark)
    got = rows(joins.interval_join(left, right, "id", ("l_et", "r_et"), *bounds).select(
        "id", "vc", F.unix_seconds("l_et"), "name", F.unix_seconds("r_et")))
    expected = []
    for a in LEFT:
        for b in RIGHT:
            (i, vc, lt), (j, name, rt) = a.split(","), b.split(",")
            if i == j and bounds[0] <= (int(rt) - int(lt)) * 1000 <= bounds[1]:
                expected.append((i, float(vc), int(lt), name, int(rt)))
    assert got == sorted(expected, key=repr)


def test_interval_join_busy_key(spark):
    """One key with all rows: slices keep the compared pairs near the result size."""
    n = 20_000
    left = spark.range(n).selectExpr("'k' as id", "id as l", "timestamp_seconds(id) as l_et")
    right = spark.range(n).selectExpr("'k' as id", "id as r", "timestamp_seconds(id) as r_et")
    got = joins.interval_join(left, right, "id", ("l_et", "r_et"))
    assert got.count() == 11 * n - 2 * (1 + 2 + 3 + 4 + 5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_slice" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_outer_joins(spark):
    left, right = sensors(
        spark, ["p,4.5,100", "q,1.25,100", "p,4.75,103"], ["p,gauge,99", "u,none,5"])
    right = right.withColumnRenamed("id", "r_id")
    on = [("id", "r_id")]

    def pairs(join):
        return rows(join(left, right, on).select("id", "r_id", "name"))

    both = [("p", "p", "gauge")] * 2
    alone_l, alone_r = ("q", None, None), (None, "u", "none")
    assert pairs(joins.inner_stream_join) == both
    assert pairs(joins.left_stream_join) == [*both, alone_l]
    assert pairs(joins.right_stream_join) == [*both, alone_r]
    assert pairs(joins.full_stream_join) == [*both, alone_l, alone_r]


def test_within_bound(spark):
    left, right = sensors(spark, ["a,1,100"], ["a,near,105", "a,far,106"])
    right = right.withColumnRenamed("id", "r_id")
    joined = joins.inner_stream_join(
        left, right, [("id", "r_id")], times=("l_et", "r_et"), within="5 SECONDS")
    assert rows(joined.select("name")) == [("near",)]


def test_lookup_drops_misses(spark):
    facts = spark.createDataFrame([("a",), ("z",), (None,)], "code string")
    dic = spark.createDataFrame([("a", "A"), ("b", "B")], "dic_code string, dic_name string")
    assert rows(joins.lookup_join(facts, joins.lookup_entries(dic), "code", "name")) == [("a", "A")]


def test_plans_are_made_without_a_job(spark):
    """Lookups and rule joins neither count nor fetch while they are put together."""
    from unittest import mock

    facts = spark.createDataFrame([("a", {"id": "1"})], "table string, data map<string,string>")
    dic = spark.createDataFrame([("a", "A")], "dic_code string, dic_name string")
    rules = spark.createDataFrame(
        [("a", "dim_a", "id", "id")], "source_table string, sink_table string, sink_columns string, sink_pk string")
    kind = type(facts)
    with mock.patch.object(kind, "count") as count, mock.patch.object(kind, "collect") as collect:
        joins.lookup_join(facts, joins.lookup_entries(dic), "table", "name")
        config.config_broadcast_join(facts, rules)
    assert not count.called and not collect.called


def test_latest_config(spark):
    texts = [
        '{"after": {"source_table": "a", "sink_table": "dim_1", "sink_columns": "id"}, "op": "r", "ts_ms": 1}',
        '{"after": {"source_table": "a", "sink_table": "dim_2", "sink_columns": "id,x", "sink_pk": ""},'
        ' "op": "u", "ts_ms": 2}',
        '{"after": {"source_table": "b", "sink_table": "dim_b", "sink_pk": "k"}, "op": "r", "ts_ms": 1}',
        '{"before": {"source_table": "b"}, "after": null, "op": "d", "ts_ms": 5}',
        '{"after": {"source_table": "c", "sink_table": "dim_c", "sink_pk": "k"}, "op": "r", "ts_ms": 1}',
    ]
    records = read_config_cdc(spark.createDataFrame([(t,) for t in texts], "value string"))
    rules = config.latest_config(records)
    assert rows(rules.select("source_table", "sink_table", "sink_pk")) == [
        ("a", "dim_2", "id"), ("c", "dim_c", "k")]


def test_fact_join_splits_a_busy_key(spark):
    """Adaptive execution splits the partition of a key that holds most rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 200_000, 1, 8).selectExpr(
            "if(id % 3 = 0, 'busy', concat('k', id % 9973)) as k", "uuid() as v")
        keys = spark.range(9973).selectExpr("concat('k', id) as rk").unionByName(
            spark.createDataFrame([("busy",)], "rk string"))
        joined = joins.inner_stream_join(facts, keys, [("k", "rk")])
        assert joined.count() == 200_000
        counted = joined.groupBy().agg(F.max("v"), F.count("*"))
        counted.collect()
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
