"""Batch and streaming readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlantern.operators import catalogues
from flowlantern.schemas import EVE_FILE


def read_flow_stream(
    spark: SparkSession,
    servers: str,
    topic: str = "ipfix-network-flow",
    starting: str = "earliest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Kafka topic of flow messages (needs the spark-sql-kafka package on the class path).

    ``max_offsets`` bounds a micro-batch and leaves the backlog in Kafka; ``min_partitions`` splits
    topic partitions over more tasks.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load()


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet table with partition discovery; a given schema saves reading file footers first."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def spread(table: DataFrame, *key: str) -> DataFrame:
    """Deals the rows out to as many tasks as the session asks for in ``spark.flowlantern.input.tasks``, for tables that are
    stored as one block; without that setting they stay as read."""
    tasks = int(table.sparkSession.conf.get("spark.flowlantern.input.tasks", "0"))
    return table.repartition(tasks, *key) if tasks else table


def read_table_stream(
    spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None, max_files: int | None = None
) -> DataFrame:
    """A parquet table ``folder/name.parquet`` as a file stream, whether it is a file or a directory."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # A file source takes a plain path for a directory; as a pattern it may match one file too.
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def read_eve(spark: SparkSession, path: str, schema: T.StructType = EVE_FILE) -> DataFrame:
    """IDS log (JSON lines). The declared schema saves the inference scan and keeps ``alert`` in a log
    that holds no alert; unreadable lines end up in ``_corrupt_record``."""
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )


def read_eve_stream(
    spark: SparkSession, folder: str, schema: T.StructType = EVE_FILE, max_files: int | None = None
) -> DataFrame:
    """The log as a file stream: each rotated file is read once, at most ``max_files`` per micro-batch."""
    reader = (
        spark.readStream.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(folder)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_col: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 32,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Relational table. With ``partition_col`` and ``bounds`` the read is split into range queries;
    otherwise one connection reads it all, which only suits small tables."""
    reader = spark.read.format("jdbc").options(**(properties or {}))
    reader = reader.option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    if partition_col is not None:
        if bounds is None:
            raise ValueError("partition_col needs bounds")
        reader = (
            reader.option("partitionColumn", partition_col)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()


CATALOGUES = {
    "classification": catalogues.classification_dim,
    "reference": catalogues.reference_dim,
    "threshold": catalogues.threshold_dim,
    "rule_files": catalogues.rule_file_names,
    "lines": lambda lines: lines,
}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file as ``line_no`` (increasing within the file) and ``line``."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))


def read_catalogue(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A text catalogue as the table of its kind, see ``CATALOGUES``; ``lines`` gives rule text as is."""
    return CATALOGUES[kind](read_lines(spark, path))


_SMOKE_ALERTS = [
    ("VLAN_7", "10.7.0.15", "many closed ports", "low"),
    ("VLAN_8", "10.8.0.23", "repeated failed logins", "high"),
]


def alerts_smoke(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_SMOKE_ALERTS, "origem_vlan string, ip_origem string, evento string, severidade string")
