"""Starting and draining streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable, Collection, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.joins import lookup_entries, lookup_join


@contextmanager
def uncounted(spark: SparkSession):
    """For queries that start within: a state store does not count its rows, which takes a read before
    each write. Their progress then tells no total number of rows."""
    name = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _run(spark: SparkSession, writer, start: Callable, steps: Sequence[Callable[[], None]]) -> None:
    """Process all there is, then what each of ``steps`` brings, and stop.

    With steps one query goes on, so its state stays where it is: a restart would open new stores beside
    the old ones and replay into them all changes since the last snapshot.
    """
    with uncounted(spark):
        query = start(writer if steps else writer.trigger(availableNow=True))
    if not steps:
        query.awaitTermination()
        return
    try:
        query.processAllAvailable()
        for step in steps:
            step()
            query.processAllAvailable()
    finally:
        query.stop()


def run_available(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    mode: str = "append",
    steps: Sequence[Callable[[], None]] = (),
    options: Mapping[str, str] | None = None,
) -> str:
    """Process everything there is now, write files, and stop. Restarts go on from the checkpoint.

    Each of ``steps`` is called when all before it is processed; what it brings is processed too.
    ``options`` are those of the format.
    """
    writer = df.writeStream.format(fmt).outputMode(mode).options(**(options or {}))
    _run(df.sparkSession, writer.option("checkpointLocation", checkpoint), lambda w: w.start(path), steps)
    return path


def run_batches(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    steps: Sequence[Callable[[], None]] = (),
) -> None:
    """Process everything there is now with a batch writer, and stop; ``steps`` as in ``run_available``."""
    writer = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    _run(df.sparkSession, writer, lambda w: w.start(), steps)


class Lookup:
    """A dictionary with a life time, as a running stream uses it.

    A snapshot serves micro-batches for ``max_age`` seconds. It is read anew when it is older, and at
    once when a micro-batch has a code that it lacks: a new code is found whatever the age, a changed
    name after ``max_age`` at the latest. With an age of 0 each micro-batch reads.
    """

    def __init__(
        self,
        read: Callable[[], DataFrame],
        max_age: float = 0.0,
        clock: Callable[[], float] = time.monotonic,
    ):
        self.read, self.max_age, self.clock = read, max_age, clock
        self.held: DataFrame | None = None
        self.since = 0.0

    def _renewed(self) -> DataFrame:
        if self.held is not None:
            self.held.unpersist()
        self.since = self.clock()
        self.held = lookup_entries(self.read())
        if self.max_age:
            self.held = self.held.persist()
        return self.held

    def is_old(self) -> bool:
        """Whether the next micro-batch reads anew, whatever its codes are."""
        return self.held is None or self.clock() - self.since >= self.max_age

    def entries(self, facts: DataFrame, codes: Collection[str]) -> DataFrame:
        """The dictionary for a micro-batch with codes in the given columns."""
        if self.is_old():
            return self._renewed()
        used = facts.select(F.explode(F.array(*codes)).alias("dic_code")).where("dic_code IS NOT NULL")
        unknown = used.join(self.held, "dic_code", "left_anti")
        return self.held if unknown.isEmpty() else self._renewed()


def with_lookups(
    write: Callable[[DataFrame, int], None],
    read: Callable[[], DataFrame],
    names: Mapping[str, str],
    how: str = "inner",
    max_age: float = 0.0,
) -> Callable[[DataFrame, int], None]:
    """Batch writer that adds dictionary names (``{code column: name column}``) before ``write``.

    ``read`` gives the dictionary as it is now; it is called when the snapshot is ``max_age`` seconds
    old or lacks a code of the micro-batch (see ``Lookup``), so codes that came after the stream was
    started are found, and the join is planned by today's size. Stateful joins go before, on the codes.
    """
    lookup = Lookup(read, max_age)

    def run(df: DataFrame, batch_id: int) -> None:
        # With a snapshot that still lives the rows are looked at twice: for codes that are new, and to be written.
        twice = not lookup.is_old()
        df = df.persist() if twice else df
        entries = lookup.entries(df, names)
        named = df
        for code, name in names.items():
            named = lookup_join(named, entries, code, name, how)
        write(named, batch_id)
        if twice:
            df.unpersist()

    return run


def start(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str = "10 seconds",
    mode: str = "append",
):
    """A running query with a micro-batch every ``every``."""
    return (
        df.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )


def stream_of(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """A parquet folder as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
