"""Registered text queries against their SQL in DuckDB; the others by what they must return."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidemart.llm import queries
from tidemart.llm.tables import stored

TABLES = "documents embeddings pages benchmark labels".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(n for n, s in queries.ORACLES.items() if s))
def test_against_sql(spark, duck, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    result = duck.execute(queries.ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)


def test_all_are_registered():
    assert set(queries.QUERIES) <= set(contract.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    before = docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == before.columns
        docs = stored(after, "stage")
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and 0 < counts[-1] < before.count()
    assert set(docs.columns) == {*before.columns, "taken"}


def test_pipeline_on_odd_rows(spark, sf_dir, tmp_path):
    """Null ids, texts and sources, repeated rows, an extra column; then no rows at all."""
    import corpus_pipeline

    base = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (5, None, "en", None, 0), (6, "", "en", "src1", 0)], base.schema
    )
    docs = base.limit(40).union(base.limit(2)).union(odd).selectExpr("*", "'x' AS size")
    for n, part in enumerate((docs, docs.limit(0))):
        path = f"{tmp_path}/{n}"
        part.write.parquet(f"{path}/documents.parquet")
        for name in ("labels", "benchmark"):
            spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
        made = corpus_pipeline.run(spark, path)
        assert "size" in made.columns
        assert (made.count() > 0) == (n == 0)


def test_pipeline_leaves_its_result_only(spark, sf_dir):
    """Tables of finished stages are gone when the last one is stored."""
    import corpus_pipeline
    from tidemart.sinks import files

    base = spark.conf.get("spark.checkpoint.dir")
    before = set(files.names(spark, base))
    made = corpus_pipeline.run(spark, sf_dir)
    [left] = set(files.names(spark, base)) - before
    assert left.startswith("source-mixing") and made.count() > 0


@pytest.mark.parametrize("name", ["ids of text", "long texts", "clashing columns"])
def test_pipeline_stages_on_other_rows(spark, sf_dir, tmp_path, name):
    """Each stage by itself: text ids, a text of 200,000 words, columns named like its own."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    path = str(tmp_path)
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark")}
    if name == "ids of text":
        docs = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
        tables["labels"] = tables["labels"].withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    if name == "long texts":
        docs = docs.withColumn("text", F.when(F.col("doc_id") % 20 == 0, F.repeat(F.lit("many words "), 100_000)).otherwise(F.col("text")))
    if name == "clashing columns":
        docs = docs.selectExpr("*", "1 AS item", "2 AS th", "3 AS hits", "4 AS fp", "5 AS least", "6 AS grade")
    for table, df in tables.items():
        df.write.parquet(f"{path}/{table}.parquet")
    docs.write.parquet(f"{path}/documents.parquet")
    for stage, function in corpus_pipeline.STAGES:
        made = function(spark, spark.read.parquet(f"{path}/documents.parquet"), path)
        assert set(docs.columns) <= set(made.columns), stage
        assert 0 < made.count() <= docs.count(), stage
