"""Mixes sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.tables import WORD, narrow, stored

#: Buckets into which the sampling keys of each source are cut for the prefix sums.
BUCKETS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(row: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the id and the seed alone."""
    digest = F.md5(F.concat(F.coalesce(row.cast("string"), F.lit("")), F.lit(f"/{seed}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """``(source, size)`` -> ``(source, source_size, target)``.

    Sources by code point, null last, take the weights in turn. The targets add up to ``share`` of
    all words; no target is above ``most`` times its source's words, and what is above goes to the
    others by weight: target = min(most * size, level * weight) with one level for all. The level is
    found where sources, in the order in which they reach their bound, stop reaching it. One row for
    each source passes through one window; documents do not.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(place) - 1) % len(weights)
    weighed = totals.withColumn(
        "weight", F.array(*(F.lit(w) for w in weights))[turn].cast("double")
    ).withColumn("bound", F.col("source_size") * float(most))
    by_bound = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_bound.rowsBetween(Window.unboundedPreceding, -1)
    # The level if this source and all after it stay below their bounds.
    level = (
        F.sum("source_size").over(everything) * float(share)
        - F.coalesce(F.sum("bound").over(before), F.lit(0.0))
    ) / F.sum("weight").over(by_bound.rowsBetween(0, Window.unboundedFollowing))
    levelled = weighed.withColumn("level", level).withColumn(
        "fits", F.col("level") * F.col("weight") <= F.col("bound")
    )
    # The first source that stays below its bound fixes the level; without one, all are at it.
    fixed = F.first(F.when(F.col("fits"), F.col("level")), ignorenulls=True).over(
        by_bound.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.least("bound", F.coalesce(fixed * F.col("weight"), F.col("bound")))
    return levelled.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    quality: DataFrame | None = None,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 42,
) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for each row.

    ``taken`` is how many words of the row the mix takes: all of them once for each complete epoch
    of its source, then once more for the rows that come first by the Efraimidis-Spirakis key
    ``-ln(u) / weight`` until the rest of the target is used up; the row at the edge is cut there.
    So every source's taken words are its target rounded down. ``u`` depends on the id and the seed,
    ``weight`` comes from ``quality`` (``doc_id, weight``; 1 where a row has none or it is not
    above 0).

    The prefix sums run in buckets of the key, whose sums are added up first, so that no task needs
    a whole source. Rows without words take nothing. Null texts have size 0, null sources are one
    source, null ids share one ``u``. Ties in the key go by id, then size. Repeated rows count as
    often as they occur. An empty table gives an empty result.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col, source=source_col).select(
        "doc_id", "source", word_count(F.col("text")).alias("size")
    )
    if quality is not None:
        known = quality.filter("weight > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(
            F.max("weight").cast("double").alias("weight")
        )
        rows = rows.join(known, "doc_id", "left")
    else:
        rows = rows.withColumn("weight", F.lit(1.0))
    key = -F.ln(uniform(F.col("doc_id"), seed)) / F.coalesce("weight", F.lit(1.0))
    # exp(-key) falls as the key rises, lies in (0, 1), and spreads the rows over the buckets.
    rows = rows.withColumn("key", key).withColumn(
        "bucket", F.floor((1 - F.exp(-F.col("key"))) * BUCKETS).cast("int")
    )
    # The texts are read once: what follows needs their sizes alone.
    rows = stored(rows.drop("weight"), "sizes")
    targets = source_targets(rows.select("source", "size"), weights, share, most).select(
        F.col("source").alias("name"), "source_size", "target"
    )
    rows = rows.join(targets, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sums.select(
        F.col("source").alias("name"),
        F.col("bucket").alias("part"),
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"),
    )
    same = F.col("source").eqNullSafe(F.col("name")) & (F.col("bucket") == F.col("part"))
    inside = (
        Window.partitionBy("source", "bucket")
        .orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.join(starts, same).withColumn(
        "before", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    epochs = F.coalesce(epochs, F.lit(0)).cast("long")
    rest = F.floor(F.col("target")).cast("long") - epochs * F.col("source_size")
    partial = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return placed.select(
        "doc_id", "size", "source_size", "target",
        (epochs * F.col("size") + partial).cast("long").alias("taken"),
    )


def quality_weights(labels: DataFrame) -> DataFrame:
    """Sampling weights from graded rows: 2 for good, 0.5 for bad; others count as 1."""
    weight = F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5)
    return labels.select("doc_id", weight.alias("weight"))


def with_taken(docs: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``taken``, as in ``mix``.

    Rows are matched by id, source and text hash; rows that repeat all three share what is taken of
    them evenly, rounded down.
    """
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    keyed = docs.withColumn("_key", F.to_json(F.struct("doc_id", "source", hashed.alias("hash")), {"ignoreNullFields": "false"}))
    names = keyed.select(F.col("doc_id").alias("key_id"), F.col("_key").alias("key"))
    if quality is not None:
        names = names.distinct()
        quality = quality.join(names, F.col("doc_id") == F.col("key_id")).select(F.col("key").alias("doc_id"), "weight")
    taken = mix(keyed, id_col="_key", quality=quality).groupBy("doc_id").agg(
        F.floor(F.avg("taken")).cast("long").alias("taken")
    )
    return keyed.join(taken.withColumnRenamed("doc_id", "_key"), "_key").select(*docs.columns, "taken")


SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
q AS (SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 END)::DOUBLE AS weight
      FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
t AS (SELECT source, sum(size)::DOUBLE AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2.0::DOUBLE * source_size AS bound,
        (CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3
         WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS weight FROM t),
l AS (SELECT *, ((sum(source_size) OVER () * 1.5::DOUBLE)
        - coalesce(sum(bound) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w),
f AS (SELECT level FROM l WHERE level * weight <= bound ORDER BY bound / weight, source NULLS LAST LIMIT 1),
s AS (SELECT l.source, l.source_size, least(l.bound, coalesce(f.level * l.weight, l.bound)) AS target
      FROM l LEFT JOIN f ON true),
k AS (SELECT d.doc_id, d.size, s.source, s.source_size, s.target,
        -ln((('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '') || '/42'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE)
          / coalesce(q.weight, 1.0::DOUBLE) AS key
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source LEFT JOIN q ON d.doc_id = q.doc_id),
b AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM k)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (epochs * size + greatest(0, least(size, floor(target) - epochs * source_size - before)))::BIGINT AS taken
FROM b
"""
