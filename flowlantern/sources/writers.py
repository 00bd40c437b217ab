"""Batch sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(
    table: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    dynamic: bool = False,
    rebalance: bool = False,
) -> None:
    """Parquet table. ``dynamic`` overwrites only the partitions present in ``table``.

    ``rebalance`` adds a shuffle by the partition columns in which adaptive execution splits large
    partitions, so a VLAN with most of the rows becomes many well-sized files instead of one task.
    """
    if rebalance and partition_by:
        table = table.hint("rebalance", *partition_by)
    writer = table.write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed(table: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Catalogue table bucketed and sorted by ``key``: joins and aggregates on it need no shuffle."""
    writer = table.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def compact(spark: SparkSession, source: str, target: str, partition_by: Sequence[str] = ("vlan",)) -> None:
    """Rewrites the many small files of a streamed table into few at a new path."""
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("compact into a new path; the source is being read")
    write_table(spark.read.parquet(source), target, partition_by, rebalance=True)


def write_jdbc(
    table: DataFrame,
    url: str,
    name: str,
    mode: str = "append",
    properties: dict[str, str] | None = None,
    partitions: int = 16,
    batch_size: int = 10_000,
) -> None:
    """Relational append. ``partitions`` caps the connections; each partition is one transaction, so
    pair it with ``insert_new`` to make a repeated run harmless."""
    writer = table.write.format("jdbc").mode(mode).options(**(properties or {}))
    writer = writer.option("url", url).option("dbtable", name)
    writer.option("numPartitions", partitions).option("batchsize", batch_size).save()


def encode_json(table: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON messages in ``value``, with ``key`` as text when given."""
    value = F.to_json(F.struct("*")).alias("value")
    return table.select(value) if key is None else table.select(F.col(key).cast("string").alias("key"), value)


def s3a_conf(
    endpoint: str, region: str, ssl: bool = True, path_style: bool = True, committer: str = "magic"
) -> dict[str, str]:
    """Spark settings for an S3-compatible store. Credentials come from the S3A provider chain.

    The magic committer makes a task's files visible only on job commit, so a lost executor leaves
    nothing half-written; ``committer="file"`` falls back to the plain algorithm 1.
    """
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.endpoint.region": region,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.change.detection.mode": "none",
        "spark.hadoop.fs.s3a.change.detection.source": "none",
        "spark.hadoop.fs.s3a.directory.marker.retention": "keep",
        "spark.hadoop.fs.s3a.fast.upload": "true",
        "spark.hadoop.fs.s3a.fast.upload.buffer": "disk",
    }
    if committer == "magic":
        conf["spark.hadoop.fs.s3a.committer.name"] = "magic"
        conf["spark.hadoop.fs.s3a.committer.magic.enabled"] = "true"
    else:
        conf["spark.hadoop.mapreduce.fileoutputcommitter.algorithm.version"] = "1"
    return conf
