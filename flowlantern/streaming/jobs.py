"""Streaming jobs: run helpers, sinks and the two ingest pipelines."""

from __future__ import annotations

import datetime
import json
import threading
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from flowlantern.operators import flows, ids
from flowlantern.sources import growing, readers, writers

BatchWriter = Callable[[DataFrame, int], None]


def _triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """``trigger`` is an interval such as ``"1 minute"``; None takes what is there and stops."""
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)


def finish(query: StreamingQuery, timeout: int | None = None) -> StreamingQuery:
    """Waits for the query and stops it on timeout or interrupt; its error is raised, not printed."""
    try:
        query.awaitTermination(timeout) if timeout is not None else query.awaitTermination()
    finally:
        query.stop()
    return query


def progress(query: StreamingQuery) -> dict:
    """Is the query running, and what its last micro-batch did."""
    last = query.lastProgress
    report = {"is_active": query.isActive, "id": str(query.id), "name": query.name}
    if last is not None:
        report.update(
            batch_id=last["batchId"],
            num_input_rows=last["numInputRows"],
            input_rows_per_second=last["inputRowsPerSecond"],
            processed_rows_per_second=last["processedRowsPerSecond"],
            duration_ms=dict(last["durationMs"]),
        )
    return report


class HealthListener(StreamingQueryListener):
    """Appends a line of JSON for every micro-batch of every query of a session to ``sink`` while it runs.

    Register with ``spark.streams.addListener``. ``sink`` takes one text, for example ``print`` or the ``info`` of a
    logger whose files are collected.
    """

    def __init__(self, sink: Callable[[str], object] = print) -> None:
        self.sink = sink

    def onQueryStarted(self, event) -> None:
        self.sink(json.dumps({"event": "started", "id": str(event.id), "name": event.name}))

    def onQueryProgress(self, event) -> None:
        last = event.progress
        report = {"event": "progress", "id": str(last.id), "name": last.name, "batch_id": last.batchId}
        report |= {"num_input_rows": last.numInputRows, "trigger_ms": dict(last.durationMs).get("triggerExecution")}
        self.sink(json.dumps(report))

    def onQueryIdle(self, event) -> None:
        self.sink(json.dumps({"event": "idle", "id": str(event.id)}))

    def onQueryTerminated(self, event) -> None:
        self.sink(json.dumps({"event": "terminated", "id": str(event.id), "error": event.exception}))


HISTORY = "id string, run_id string, name string, batch_id bigint, input_rows bigint, trigger_ms bigint, moment timestamp"


class StreamHistory(StreamingQueryListener):
    """Appends a row for every micro-batch of every query of a session to a table, which outlives the session.

    Rows are stored ``every`` so many and when a query ends. ``read_history`` reads them back, ``writers.compact`` makes
    few files of many. A row that is stored twice counts once.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100) -> None:
        self.spark, self.path, self.every = spark, path, every
        self.rows: list[tuple] = []
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self.ended[str(event.runId)] = threading.Event()

    def onQueryProgress(self, event) -> None:
        last = event.progress
        moment = datetime.datetime.fromisoformat(last.timestamp)
        spent = dict(last.durationMs).get("triggerExecution")
        self.rows.append((str(last.id), str(last.runId), last.name, last.batchId, last.numInputRows, spent, moment))
        if len(self.rows) >= self.every:
            self.store()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.store()
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def store(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, HISTORY).coalesce(1).write.mode("append").parquet(self.path)

    def wait(self, query: StreamingQuery, timeout: float = 60) -> bool:
        """Events arrive after the batches they tell of: waits until those of an ended query are stored."""
        return self.ended.setdefault(str(query.runId), threading.Event()).wait(timeout)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The micro-batches stored by ``StreamHistory``, each once: the run that ended it last."""
    table = spark.read.schema(HISTORY).parquet(path)
    last = F.max_by(F.struct("run_id", "name", "input_rows", "trigger_ms", "moment"), F.struct("moment", "input_rows"))
    return table.groupBy("id", "batch_id").agg(last.alias("last")).select("id", "batch_id", "last.*")


def stream_health(history: DataFrame) -> DataFrame:
    """How far each stream got and how long its micro-batches took."""
    return history.groupBy("id").agg(
        F.count(F.lit(1)).alias("batches"),
        F.countDistinct("run_id").alias("runs"),
        F.max("batch_id").alias("last_batch"),
        F.sum("input_rows").alias("input_rows"),
        F.max("trigger_ms").alias("longest_ms"),
        F.max("moment").alias("last_moment"),
    )


def recent_progress(query: StreamingQuery) -> list[dict]:
    """The newest micro-batches the engine still holds, oldest first; ``HealthListener`` reports all of them."""
    return [
        {
            "batch_id": entry["batchId"],
            "num_input_rows": entry["numInputRows"],
            "trigger_ms": dict(entry["durationMs"]).get("triggerExecution"),
        }
        for entry in query.recentProgress
    ]


def write_stream(
    table: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), trigger: str | None = None
) -> StreamingQuery:
    """Append to parquet, exactly once: a checkpoint belongs to one query and one path."""
    writer = table.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _triggered(writer, trigger).start()


def write_bronze(bronze: DataFrame, path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    return write_stream(bronze, path, checkpoint, ["vlan"], trigger)


LAYOUTS = {
    "narrow": lambda messages: flows.bronze_flows(flows.decode_envelope(messages, wide=False)),
    "wide": lambda messages: flows.bronze_flows(flows.decode_envelope(messages), wide=True),
    "basic": lambda messages: flows.bronze_basic(flows.decode_envelope(messages, wide=False)),
}


def run_bronze(
    messages: DataFrame, path: str, checkpoint: str, layout: str = "narrow", trigger: str | None = None
) -> StreamingQuery:
    """Kafka-shaped stream to the bronze table in one of the ``LAYOUTS``."""
    return write_bronze(LAYOUTS[layout](messages), path, checkpoint, trigger)


def run_rejected(messages: DataFrame, path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """The messages ``run_bronze`` leaves out, as they came, in a table and checkpoint of their own."""
    rejected = flows.rejected_flows(flows.decode_envelope(messages))
    return write_stream(rejected, path, checkpoint, trigger=trigger)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def new_rows(batch: DataFrame, stored: DataFrame | None, key: str = "hash_id") -> DataFrame:
    """Rows of ``batch`` whose key ``stored`` lacks."""
    return batch if stored is None else batch.join(stored.select(key), key, "left_anti")


def insert_new(
    batch: DataFrame,
    path: str,
    key: str = "hash_id",
    partition: str = "event_date",
    dedupe: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Appends the rows whose key is new to a parquet table partitioned by ``partition``.

    Equal keys mean equal dates, because the time is part of the key, so the join is by date and key and
    reads back only the partitions of the dates in the batch (dynamic partition pruning); that of rows
    without date only if the batch has any. ``dedupe`` leaves one row per key (any of them by default).
    Running a batch twice adds nothing; there must be one writer per table.
    """
    stored = _stored(batch.sparkSession, path)
    once = batch.dropDuplicates([key]) if dedupe is None else dedupe(batch)

    def append(rows: DataFrame) -> None:
        rows.hint("rebalance", partition).write.mode("append").partitionBy(partition).parquet(path)

    if stored is None:
        append(once)
        return
    # Made once for the dates and the rows; the count fills it in one pass over all partitions.
    once.persist()
    try:
        undated = F.col(partition).isNull()
        dates = once.filter(~undated).select(partition).distinct()
        # Each date is a folder, which the driver lists anyway. Joined by a shuffle, the stored keys would meet in a task
        # for each date.
        known = stored.select(key, partition).join(F.broadcast(dates), partition, "left_semi")
        dated = once.filter(~undated).join(known, [key, partition], "left_anti")
        if once.agg(F.count_if(undated)).first()[0]:
            dated = dated.unionByName(new_rows(once.filter(undated), stored.filter(undated), key).select(dated.columns))
        append(dated.select(once.columns))
    finally:
        once.unpersist()


def ingest_log(
    spark: SparkSession,
    folder: str,
    table: str,
    checkpoint: str,
    rejected: str | None = None,
    pattern: str = "*",
    trigger: str | None = None,
) -> StreamingQuery:
    """Takes the events of logs that are still being written to into the traffic table, each once.

    Only what was added since the last run is read: the checkpoint holds a position for every file, rotated ones
    included (``sources.growing``). Without ``trigger`` it takes what is there and stops, so it may run as often as wanted.
    """
    events = ids.parse_eve(growing.read_growing_log(spark, folder, pattern))
    return finish(run_eve_ingest(events, table, checkpoint, rejected, trigger))


def insert_new_jdbc(
    batch: DataFrame, url: str, name: str, key: str = "hash_id", properties: dict[str, str] | None = None, **read: object
) -> None:
    """The same for a relational table, whose keys are read back; ``read`` splits that read by range."""
    stored = readers.read_jdbc(batch.sparkSession, url, name, properties, **read)
    writers.write_jdbc(new_rows(batch.dropDuplicates([key]), stored, key), url, name, properties=properties)


def run_eve_ingest(
    events: DataFrame, path: str, checkpoint: str, rejected: str | None = None, trigger: str | None = None
) -> StreamingQuery:
    """IDS event stream to the traffic table, each event once however often it is delivered.

    ``rejected`` names a folder for events the table cannot hold.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        if not rejected:
            insert_new(ids.to_trafego(batch), path, dedupe=ids.dedupe_trafego)
            return
        # Parsed once for the rows and the rejects.
        batch.persist()
        try:
            insert_new(ids.to_trafego(batch), path, dedupe=ids.dedupe_trafego)
            # A folder per batch, overwritten when the batch is repeated.
            ids.rejected_events(batch).write.mode("overwrite").parquet(f"{rejected}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return _triggered(writer, trigger).start()


def folder_writer(path: str, output: str = "parquet") -> BatchWriter:
    """Writer for ``fan_out``: one folder per micro-batch, replaced when the batch is repeated."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(output).save(f"{path}/batch_id={batch_id}")

    return write


def kafka_writer(servers: str, topic: str, key: str | None = None) -> BatchWriter:
    """Writer for ``fan_out``: rows as JSON messages (needs the spark-sql-kafka package). A repeated batch is sent
    again, so receivers have to drop copies."""

    def write(batch: DataFrame, batch_id: int) -> None:
        messages = writers.encode_json(batch, key).write.format("kafka")
        messages.option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return write


def console_writer(rows: int = 20) -> BatchWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.show(rows, truncate=False)

    return write


def fan_out(table: DataFrame, checkpoint: str, *writers: BatchWriter, trigger: str | None = None) -> StreamingQuery:
    """Sends each micro-batch to several sinks, computing it once.

    Writers must be repeatable by batch id, because a failed batch is run again for all of them.
    """

    def write_all(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            batch.unpersist()

    return _triggered(table.writeStream.foreachBatch(write_all).option("checkpointLocation", checkpoint), trigger).start()


def dedupe_stream(table: DataFrame, key: Sequence[str], horizon: str, time: str = "event_time") -> DataFrame:
    """Drops rows whose key was seen within ``horizon``; state older than that is released."""
    return table.withWatermark(time, horizon).dropDuplicatesWithinWatermark(list(key))
