"""Session settings and the shared folder jobs may write to."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# AQE carries the skew handling and the partition coalescing every operator relies on.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# For stateful streams: state on local disk with small uploads per batch, not in the executor heap.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def shuffle_partitions(shuffled_bytes: int, cores: int, target: int = 200 << 20) -> int:
    """Partitions that keep each one near ``target`` bytes, at least one per core.

    AQE merges small partitions but never creates more than the plan started with, so the starting
    number has to suit the largest shuffle.
    """
    return max(cores, math.ceil(shuffled_bytes / target))


def build_session(app: str = "flowlantern", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """STREAM_CONF for the streams that start inside, in a session that was built without it."""
    before = {name: spark.conf.get(name, None) for name in STREAM_CONF}
    try:
        for name, value in STREAM_CONF.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for ``name`` below ``spark.checkpoint.dir``.

    Only a local master may go without that setting: there one machine holds every task, so a
    temporary folder is visible to all of them.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="flowlantern-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(table: DataFrame, name: str) -> DataFrame:
    """``table`` written below ``spark.checkpoint.dir`` and read back: what follows starts from the files, so that
    neither a lost executor nor a second use runs its plan again."""
    path = shared_dir(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
