"""Session helpers: settings the library relies on, and where scratch data may live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# State on local disk with only changes uploaded per batch, and one store per join partition. The files
# of a store take the space that they fill.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def build_session(app: str = "tidemart", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession, tz: str = "UTC") -> SparkSession:
    """Runtime settings only, so it also works on a session made by somebody else.

    AQE re-plans joins from measured sizes and splits skewed join partitions. Shuffle
    partitions are left to the session.
    """
    conf = spark.conf
    conf.set("spark.sql.session.timeZone", tz)
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    for key, value in STATE_STORE.items():
        conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for stream checkpoints and intermediate tables.

    It lies under the shared folder named by ``spark.checkpoint.dir``. Only a local session
    without that setting falls back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tidemart-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
