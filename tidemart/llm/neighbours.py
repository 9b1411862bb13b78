"""Approximate nearest neighbours: probed lists, scanned with early abandoning on rotated vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.tables import narrow, stored

#: Columns looked at before the next test.
COLUMNS = 16
#: Queries that the number of probed lists is derived from, and the fewest lists they may give.
TRIED = 256
LEAST_PROBES = 24
#: Vectors of a list that one task scans, and queries that scan them together.
CHUNK = 4096
ASKING = 512


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, and not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def rotation(dims: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix: afterwards any block of columns is as good a sample as another."""
    made, upper = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return made * np.sign(np.diag(upper))


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` from all rows of ``b``."""
    out = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.maximum(out, 0)


def centres(sample: np.ndarray, count: int, seed: int, rounds: int = 12) -> np.ndarray:
    """k-means centres of a sample."""
    random = np.random.default_rng(seed)
    found = sample[random.choice(len(sample), size=count, replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate(
            [squares(sample[i : i + 4096], found).argmin(1) for i in range(0, len(sample), 4096)]
        )
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, sample)
        sizes = np.bincount(nearest, minlength=count)
        found = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], found)
    return found


def scan(query: np.ndarray, rows: np.ndarray, k: int, doubt: float, bound: float = np.inf) -> np.ndarray:
    """Indexes of rows that may be among the ``k`` nearest to ``query``; both are rotated.

    ``bound`` is a squared distance that ``k`` rows elsewhere are known to keep to. The first rows are
    measured in full and set the k-th best distance, if it is below. Of the others one block of
    columns after another is added up. After d of D columns a row's distance is estimated as its
    partial square times D / d; the hypothesis that it is within the k-th best is given up once the
    estimate is above it by the factor (1 + doubt / sqrt(d)) ** 2.
    """
    dims = rows.shape[1]
    first = min(len(rows), max(4 * k, 64))
    full = ((rows[:first] - query) ** 2).sum(1)
    if first == len(rows):
        return np.flatnonzero(full <= bound * (1 + 1e-9))
    limit = min(bound, np.partition(full, k - 1)[k - 1])
    alive = np.arange(first, len(rows))
    partial = np.zeros(len(alive))
    for d in range(0, dims, COLUMNS):
        part = rows[alive, d : d + COLUMNS] - query[d : d + COLUMNS]
        partial += np.einsum("ij,ij->i", part, part)
        seen = min(d + COLUMNS, dims)
        factor = 1.0 if seen == dims else (1 + doubt / np.sqrt(seen)) ** 2
        keep = partial * (dims / seen) <= factor * limit * (1 + 1e-9)
        alive, partial = alive[keep], partial[keep]
        if not len(alive):
            break
    return np.concatenate([np.flatnonzero(full <= limit * (1 + 1e-9)), alive])


class Lists:
    """The lists of an index and the vectors' rotation, made from a bounded sample."""

    def __init__(self, sample: np.ndarray, per_list: int, rows: int, most_lists: int, seed: int):
        dims = sample.shape[1]
        self.turn = rotation(dims, seed)
        count = int(min(max(1, rows // per_list), most_lists, len(sample)))
        self.centres = centres(sample @ self.turn, count, seed)

    def turned(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.turn

    def probes(self, turned: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` nearest lists of each vector, nearest first."""
        distance = squares(turned, self.centres)
        return np.argsort(distance, axis=1, kind="stable")[:, :count]


def enough_probes(members: DataFrame, tried: pd.DataFrame, lists: Lists, k: int, least_recall: float) -> int:
    """How many nearest lists hold ``least_recall`` of the ``k`` nearest others of the tried queries.

    ``members`` are ``(group, list, turned)``, all of which are measured; ``tried`` are distinct
    ``(group, vector)``. Each task keeps the ``k`` nearest of its rows for each query.
    """
    queries = lists.turned(np.stack(tried["vector"].to_numpy()))
    order = lists.probes(queries, len(lists.centres))
    rank = np.empty(order.shape, dtype=np.int16)
    np.put_along_axis(rank, order, np.arange(order.shape[1], dtype=np.int16)[None, :], axis=1)
    shared = members.sparkSession.sparkContext.broadcast((tried["group"].to_numpy(), queries, rank))

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, mine, rank = shared.value
        best, where = np.empty((len(mine), 0)), np.empty((len(mine), 0), dtype=np.int16)
        for batch in batches:
            if not len(batch):
                continue
            far = squares(mine, np.stack(batch["turned"].to_numpy()))
            far[names[:, None] == batch["group"].to_numpy()[None, :]] = np.inf
            best = np.concatenate([best, far], axis=1)
            where = np.concatenate([where, rank[:, batch["list"].to_numpy()]], axis=1)
            first = np.argsort(best, axis=1, kind="stable")[:, :k]
            best, where = (np.take_along_axis(c, first, axis=1) for c in (best, where))
        query, _ = np.nonzero(np.isfinite(best))
        fine = np.isfinite(best)
        yield pd.DataFrame({"query": query, "far": best[fine], "place": where[fine].astype(np.int32)})

    found = members.select("group", "list", "turned").mapInPandas(nearest, "query long, far double, place int")
    order = F.row_number().over(Window.partitionBy("query").orderBy("far", "place"))
    counts = found.withColumn("nth", order).filter(F.col("nth") <= k).groupBy("place").count().toPandas()
    if not len(counts):
        return 1
    sizes = np.bincount(counts["place"], weights=counts["count"], minlength=len(lists.centres))
    return int(np.argmax(np.cumsum(sizes) >= least_recall * sizes.sum())) + 1


def search(
    vectors: DataFrame,
    asks: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    probes: int | None = None,
    per_list: int = 400,
    most_lists: int = 4096,
    most_sample: int = 20000,
    doubt: float = 2.1,
    seed: int = 42,
    least_recall: float = 0.99,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row where ``asks`` holds (over ``vec_id``) the
    ``k`` nearest other rows found, by Euclidean distance in double precision, nearest first and of
    equal ones the smaller id first.

    An index of lists is fitted on at most ``most_sample`` vectors, the first by a hash of their id;
    every vector is then put into its nearest list. A query scans its ``probes`` nearest lists with
    ``scan``: first the LEAST_PROBES nearest, whose k-th best distance then bounds what the others can
    add. If their number is not given, TRIED of the queries are measured against all vectors, and
    it is the number of lists that holds ``least_recall`` of their neighbours, LEAST_PROBES at least:
    on vectors without clusters that is a large share of the lists, whatever their number. What is left is measured on the original vectors. Equal vectors are searched for once
    and stand in for each other: only the ``k + 1`` smallest ids of each can be in a result. Lists
    go in chunks, and the queries of a chunk in groups, so no task holds a list as a whole.

    Vectors that are null, zero, of another length than the commonest one (of equally common ones the
    shorter), or hold a null, NaN
    or infinite component take no part, neither as query nor as candidate. Rows with a null id take no
    part either. Of rows that repeat an id the one with the smallest vector counts. Fewer other vectors than ``k`` give fewer rows; an empty table gives
    an empty result; other columns are left out.
    """
    spark = vectors.sparkSession
    rows = narrow(vectors, vec_id=id_col, vector=vector_col)
    rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    # -0.0 equals 0.0 but would be another group.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    rows = rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    schema = "query_id long, rank int, vec_id long, score double"
    commonest = rows.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if commonest is None:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("vector") == commonest["dims"])
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most_sample).select("vector").toPandas()["vector"]
    # Of equal vectors the smallest ids; the cut happens before the shuffle.
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    groups = few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    groups = stored(groups.withColumn("group", F.col("ids")[0]), "vectors")
    count = groups.count()
    lists = Lists(np.stack([np.array(v) for v in sample]), per_list, count, most_lists, seed)
    shared = spark.sparkContext.broadcast(lists)
    def placed(number: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                own = shared.value
                turned = own.turned(np.stack(batch["vector"].to_numpy()))
                found = own.probes(turned, number)
                yield pd.DataFrame(
                    {"group": batch["group"], "list": list(found.astype(np.int32)), "turned": list(turned)}
                )

        return run

    kind = "group long, list array<int>, turned array<double>"
    members = groups.select("group", "vector").mapInPandas(placed(1), kind)
    members = stored(members.select("group", F.col("list")[0].alias("list"), "turned"), "lists")
    asking = rows.filter(asks).select("vec_id", "vector")
    asked = asking.groupBy("vector").agg(F.min("vec_id").alias("group"))
    if probes is None:
        # Taken like the sample, by a hash, but of the queries.
        first = asked.orderBy(F.xxhash64("group"), "group").limit(TRIED).toPandas()
        fitting = enough_probes(members, first, lists, k, least_recall) if len(first) else 1
        probes = max(LEAST_PROBES, fitting)
    probes = min(probes, len(lists.centres))
    probing = asked.select("group", "vector").mapInPandas(placed(probes), kind)
    sizes = stored(
        members.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks")), "sizes"
    )
    members = members.join(sizes, "list").withColumn(
        "chunk", F.pmod(F.xxhash64("group"), F.col("chunks")).cast("int")
    ).drop("chunks")
    placed_in = F.posexplode("list").alias("near", "list")
    probing = stored(probing.select("group", placed_in, "turned"), "probes")
    wanted = stored(
        probing.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / ASKING).cast("int").alias("parts")), "asking"
    )
    probing = probing.join(wanted, "list").join(sizes, "list")
    probing = probing.withColumn("part", F.pmod(F.xxhash64("group"), F.col("parts")).cast("int"))
    probing = probing.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    members = members.join(wanted, "list").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    # Under names of their own: both sides come from the same tables.
    members = members.select(*(F.col(c).alias(c) for c in ("list", "chunk", "part", "group", "turned")))

    def compare(queries: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"query": [], "found": [], "far": []}
        if len(queries) and len(others):
            table = np.stack(others["turned"].to_numpy())
            names = others["group"].to_numpy()
            for name, query, bound in zip(queries["group"], queries["turned"], queries["bound"], strict=True):
                near = scan(query, table, k + 1, doubt, bound)
                distance = ((table[near] - query) ** 2).sum(1)
                first = np.argsort(distance, kind="stable")[: 2 * (k + 1)]
                out["query"] += [name] * len(first)
                out["found"] += names[near[first]].tolist()
                out["far"] += distance[first].tolist()
        return pd.DataFrame(out).astype({"query": "int64", "found": "int64", "far": "float64"})

    key = ["list", "chunk", "part"]

    def scanned(queries: DataFrame, name: str) -> DataFrame:
        """What the lists of these rows hold for the queries, twice as many as can be needed: rotated
        distances may be off in their last digits. The cut happens before the shuffle and after."""
        named = queries.select(*(F.col(c).alias(c) for c in (*key, "group", "turned", "bound")))
        found = named.groupBy(*key).cogroup(members.groupBy(*key)).applyInPandas(
            compare, "query long, found long, far double"
        )
        place = F.rank().over(Window.partitionBy("query").orderBy(F.col("far").cast("float")))
        return stored(found.withColumn("place", place).filter(F.col("place") <= 2 * (k + 1)).drop("place"), name)

    unbound = F.lit(float("inf"))
    first = scanned(probing.filter(F.col("near") < LEAST_PROBES).withColumn("bound", unbound), "first")
    # The k-th best of the nearest lists, the query itself being one more.
    bounds = first.groupBy("query").agg(F.array_sort(F.collect_list("far")).alias("far"))
    bounds = bounds.select("query", F.get("far", F.lit(k)).alias("best"))
    others = probing.filter(F.col("near") >= LEAST_PROBES).join(bounds, F.col("group") == F.col("query"), "left")
    found = first.union(scanned(others.withColumn("bound", F.coalesce("best", unbound)), "others"))
    place = F.rank().over(Window.partitionBy("query").orderBy(F.col("far").cast("float")))
    found = found.withColumn("place", place).filter(F.col("place") <= 2 * (k + 1)).drop("place", "far")
    # Exact distances on the original vectors, for the few that are left.
    asked = asked.select("group", F.col("vector").alias("mine"))
    pairs = found.join(asked, F.col("query") == F.col("group")).drop("group")
    pairs = pairs.join(groups, F.col("found") == F.col("group")).select("query", "mine", "vector", "ids")
    square = F.aggregate(
        F.zip_with("mine", "vector", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x
    )
    pairs = pairs.select("query", F.sqrt(square).alias("score"), "ids")
    best = F.row_number().over(Window.partitionBy("query").orderBy("score", F.col("ids")[0]))
    pairs = stored(pairs.withColumn("place", best).filter(F.col("place") <= k + 1).drop("place"), "nearest")
    # Back from groups of equal vectors to rows, on both sides.
    same = asking.groupBy("vector").agg(F.collect_list("vec_id").alias("queries"), F.min("vec_id").alias("query"))
    answers = same.select("query", F.explode("queries").alias("query_id")).join(pairs, "query")
    answers = answers.select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    order = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    ranked = answers.withColumn("rank", order).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
