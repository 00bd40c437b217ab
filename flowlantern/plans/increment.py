"""Silver and gold kept up to date by what was added to bronze since the last run.

Bronze is read as a stream of files, so its checkpoint is the list of files taken. Each micro-batch stores its new silver
rows and what they add to gold: sums, and the distinct values behind the distinct counts. Both can be merged in any
grouping, so gold is their sum over the batches and no earlier row is read for it.

Every batch writes folders of its own, replaced when it is repeated, and reads only folders of earlier batches. Each
``FOLD``-th batch stores all it finds in the folders since the last such batch together with its own, so a reader needs
at most ``FOLD`` folders and a group is rewritten once in ``FOLD`` batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowlantern.functions.measures import bytes_per_packet, utc_parts
from flowlantern.operators import flows
from flowlantern.sources.writers import write_table
from flowlantern.streaming import jobs

FOLD = 16
SUMS = "src_ip string, vlan int, packets bigint, bytes bigint"
VALUES = "src_ip string, vlan int, kind string, value string"


def _with_period(rows: DataFrame, unit: str) -> DataFrame:
    """Adds the start of the ``unit`` (UTC) in which a row was ingested as ``period``; rows without that time share the
    first one."""
    day = F.coalesce(utc_parts(F.col("ingestion_time"))["event_date"], F.lit("1970-01-01").cast("date"))
    return rows.withColumn("period", F.date_trunc(unit, day.cast("timestamp")).cast("date"))


def silver_table(spark: SparkSession, root: str, schema: T.StructType, batch_id: int | None = None) -> DataFrame:
    """The silver rows stored below ``root``, with ``period`` and ``batch_id``; of one batch if it is given."""
    layout = T.StructType([*schema.fields, *T._parse_datatype_string("period date, batch_id bigint").fields])
    reader = spark.read.schema(layout).option("basePath", f"{root}/silver")
    return reader.parquet(f"{root}/silver" if batch_id is None else f"{root}/silver/batch_id={batch_id}")


def _new_silver(batch: DataFrame, root: str, batch_id: int, unit: str) -> DataFrame:
    """Clean rows no earlier batch holds. Equal rows are of the same period, so only the periods of the batch are read
    back, and they share one shuffle with its rows."""
    if batch_id == 0:
        return _with_period(flows.clean_flows(batch), unit)
    earlier = silver_table(batch.sparkSession, root, batch.schema).where(F.col("batch_id") < batch_id)
    known = earlier.join(_with_period(batch, unit).select("period").distinct(), "period", "left_semi")
    return _with_period(flows.clean_flows(batch, known=known.select(batch.columns)), unit)


def _state(spark: SparkSession, root: str, name: str, layout: str, last: int, fold: int) -> DataFrame:
    """The rows of a state table that say all about the batches up to ``last``."""
    table = spark.read.schema(f"{layout}, batch_id bigint").parquet(f"{root}/{name}")
    first = (last + 1) // fold * fold - 1
    return table.where(F.col("batch_id").between(max(first, 0), last)).drop("batch_id")


def _added_sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("src_ip", "vlan").agg(F.sum("packets").alias("packets"), F.sum("bytes").alias("bytes"))


def _values(rows: DataFrame) -> DataFrame:
    counted = [("target", F.col("dst_ip")), ("port", F.col("dst_port").cast("string"))]
    pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), value.alias("value")) for kind, value in counted])
    return rows.select("src_ip", "vlan", F.inline(pairs)).where(F.col("value").isNotNull()).distinct()


def take_batch(batch: DataFrame, batch_id: int, root: str, fold: int = FOLD, unit: str = "day") -> None:
    """Stores what one micro-batch of bronze rows adds to silver and to the state of gold."""
    spark = batch.sparkSession
    batch.persist()  # read once for the periods and the rows
    try:
        fresh = _new_silver(batch, root, batch_id, unit)
        write_table(fresh, f"{root}/silver/batch_id={batch_id}", ["period", "vlan"], rebalance=True)
    finally:
        batch.unpersist()
    rows = silver_table(spark, root, batch.schema, batch_id)
    values, sums = _values(rows), _added_sums(rows)
    if batch_id and (batch_id + 1) % fold == 0:
        values = values.union(_state(spark, root, "values", VALUES, batch_id - 1, fold)).distinct()
        sums = _added_sums(sums.union(_state(spark, root, "sums", SUMS, batch_id - 1, fold)))
    # The sums come last: a batch counts for readers once they are there.
    values.write.mode("overwrite").parquet(f"{root}/values/batch_id={batch_id}")
    sums.write.mode("overwrite").parquet(f"{root}/sums/batch_id={batch_id}")


def run_refine(
    spark: SparkSession,
    bronze: str,
    root: str,
    max_files: int = 10_000,
    fold: int = FOLD,
    unit: str = "day",
    trigger: str | None = None,
) -> StreamingQuery:
    """Takes the bronze files not taken yet into the tables below ``root``. One run at a time; ``fold`` and ``unit``, the
    span of time of a silver folder, stay the same over the runs."""
    # VLAN folders are typed by the layout, so a table without a single VLAN has the same one.
    layout = spark.read.parquet(bronze).withColumn("vlan", F.col("vlan").cast("int")).schema
    files = spark.readStream.schema(layout).option("maxFilesPerTrigger", max_files).parquet(bronze)
    writer = files.writeStream.option("checkpointLocation", f"{root}/checkpoint")
    return jobs._triggered(writer.foreachBatch(lambda batch, n: take_batch(batch, n, root, fold, unit)), trigger).start()


def gold_table(spark: SparkSession, root: str, fold: int = FOLD) -> DataFrame:
    """Gold features as ``flows.gold_features`` computes them from all silver rows, from the stored state alone."""
    sums = spark.read.schema(f"{SUMS}, batch_id bigint").parquet(f"{root}/sums")
    last = sums.agg(F.max("batch_id")).first()[0] or 0
    none = F.lit(0).cast("bigint")
    added = _state(spark, root, "sums", SUMS, last, fold)
    added = added.select("src_ip", "vlan", "packets", "bytes", none.alias("targets"), none.alias("ports"))
    # Hashed on the value too, so the values of a hot source are spread over all tasks.
    values = _state(spark, root, "values", VALUES, last, fold).distinct()
    counted = [(F.col("kind") == kind).cast("bigint").alias(name) for kind, name in (("target", "targets"), ("port", "ports"))]
    values = values.select("src_ip", "vlan", none.alias("packets"), none.alias("bytes"), *counted)
    gold = added.union(values).groupBy("src_ip", "vlan").agg(
        F.sum("packets").alias("total_packets"),
        F.sum("bytes").alias("total_bytes"),
        F.sum("targets").alias("unique_targets"),
        F.sum("ports").alias("unique_ports"),
    )
    return gold.withColumn("bytes_per_packet", bytes_per_packet("total_bytes", "total_packets"))
