"""The registered queries: each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemart.llm import (
    infill,
    langid,
    leaks,
    mixing,
    neighbours,
    pieces,
    quality,
    repeats,
    resample,
    simhash,
    toxicity,
    units,
    urls,
)
from tidemart.llm.features import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    apart = held_out("doc_id", 3, 1)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, labels, learn=~apart, threshold=0.7)
    return scored.select("doc_id", apart.alias("held_out"), "score", "predicted")


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=3)
    return groups.select(
        "doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id"
    )


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = quality.grades_of(table(spark, sf_dir, "labels"))
    rated = quality.rate(table(spark, sf_dir, "documents"), ratings, least_grade=1)
    return rated.select("doc_id", "expected_grade", "tail", (F.col("tail") >= 0.5).alias("kept"))


@query("op4_leaks")
def op4_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_mix", mixing.SQL)
def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = mixing.quality_weights(table(spark, sf_dir, "labels"))
    return mixing.mix(table(spark, sf_dir, "documents"), quality=weights)


@query("op10_repeats")
def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"), length=200)
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"]
    )
    return cut.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op6_langid")
def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    apart = held_out("doc_id", 4, 2)
    found = langid.identify(table(spark, sf_dir, "documents"), learn=~apart)
    return found.select("doc_id", apart.alias("held_out"), "lang_pred", "score")


@query("op7_units", units.SQL)
def op7_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = units.remove_units(table(spark, sf_dir, "documents"), separator="\n")
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"]
    )
    return cut.select(
        "doc_id",
        "n_units",
        F.size("spans").cast("long").alias("n_removed"),
        removed.alias("removed_chars"),
        F.md5("kept").alias("kept_md5"),
    )


@query("op8_neighbours")
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query("op9_urls", urls.SQL)
def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


@query("op11_pieces")
def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = pieces.encode(table(spark, sf_dir, "documents"), model)
    return pieces.decode(encoded, model).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query("op12_resample", resample.SQL)
def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_infill", infill.SQL)
def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.with_digests(infill.transform(table(spark, sf_dir, "documents")))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
