"""IDS events to the traffic table and the normal-versus-anomalous dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlantern.functions.measures import row_hash, utc_parts
from flowlantern.schemas import EVE_JSON, TRAFFIC_COLUMNS, TRAFFIC_COUNTERS

EVENT_TYPES = ("alert", "flow", "dns", "http")  # fixed values: what the sensor is set to log
REQUIRED = ("flow_id", "src_ip", "dest_ip", "proto")  # NOT NULL text columns of the stored table


def parse_eve(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON lines to typed events; unreadable text becomes an event of NULLs with the text kept."""
    event = F.inline(F.array(F.from_json(column, EVE_JSON)))
    return lines.select(F.col(column).alias("_corrupt_record"), event).withColumn(
        "_corrupt_record", F.when(F.coalesce("event_type", "timestamp", "src_ip").isNull(), F.col("_corrupt_record"))
    )


def select_events(events: DataFrame, types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    return events.filter(F.col("event_type").isin(*types))


def alerts(events: DataFrame) -> DataFrame:
    return select_events(events, ["alert"])


def flatten_eve(events: DataFrame) -> DataFrame:
    """Nested event to flat columns with the parsed time ``ts`` (NULL for malformed text)."""
    return events.select(
        "event_type",
        "timestamp",
        "flow_id",
        "src_ip",
        "dest_ip",
        "src_port",
        "dest_port",
        "proto",
        F.try_to_timestamp("timestamp").alias("ts"),
        "tx_id",
        F.col("alert.gid").alias("gid"),
        F.col("alert.signature_id").alias("signature_id"),
        F.col("alert.category").alias("category"),
        F.col("alert.severity").alias("severity"),
        *[F.col(f"flow.{name}").alias(name) for name in TRAFFIC_COUNTERS],
    )


def with_time_parts(flat: DataFrame) -> DataFrame:
    """Replaces ``ts`` by hour, minute, seconds and event_date, all in UTC."""
    return flat.withColumns(utc_parts(F.col("ts"))).drop("ts")


def fill_zero(flat: DataFrame) -> DataFrame:
    """NULL numbers become 0; NULL texts stay."""
    numeric = ["src_port", "dest_port", "hour", "minute", "seconds", "severity", *TRAFFIC_COUNTERS]
    return flat.fillna(0, subset=[name for name in numeric if name in flat.columns])


# Every parsed field: one packet may raise several alerts, and one flow logs several events at a time.
HASHED = [
    "flow_id", "event_type", "timestamp", "src_ip", "dest_ip", "src_port", "dest_port", "proto", "tx_id", "gid",
    "signature_id", "category", "severity", *TRAFFIC_COUNTERS,
]


def with_hash_id(flat: DataFrame) -> DataFrame:
    """Adds ``hash_id`` over all parsed fields, so that only copies of one event share it."""
    return flat.withColumn("hash_id", row_hash(*HASHED))


def normalise(events: DataFrame) -> DataFrame:
    """All traffic columns with ``hash_id`` and ``event_date``, before the NOT NULL check."""
    # The hash is taken before zero filling, so an absent port and port 0 stay different.
    filled = fill_zero(with_hash_id(with_time_parts(flatten_eve(events))))
    return filled.select("hash_id", *TRAFFIC_COLUMNS, "event_date")


def _complete() -> Column:
    check = F.lit(True)
    for name in REQUIRED:
        check = check & F.col(name).isNotNull()
    return check


def to_trafego(events: DataFrame, key: bool = True) -> DataFrame:
    """Traffic rows in the stored order. ``key=False`` leaves out ``hash_id`` and ``event_date``."""
    rows = normalise(events).filter(_complete())
    return rows if key else rows.select(*TRAFFIC_COLUMNS)


def rejected_events(events: DataFrame) -> DataFrame:
    """Events the stored table cannot hold because a required text is missing."""
    return events.filter(~_complete())


def dedupe_trafego(trafego: DataFrame) -> DataFrame:
    """One row per ``hash_id``. Rows of one hash are equal in every column, so this is a hash aggregate that
    combines copies before the shuffle."""
    return trafego.dropDuplicates()


def to_classificados(rows: DataFrame) -> DataFrame:
    """Classified rows with the column default ``processado = 0``."""
    done = F.coalesce("processado", F.lit(0)) if "processado" in rows.columns else F.lit(0)
    return rows.withColumn("processado", done.cast("int"))


def pending(classificados: DataFrame) -> DataFrame:
    return classificados.filter(F.col("processado") == 0)


def _classified_keys(classificados: DataFrame) -> DataFrame:
    # Two rows of one hash on this side would count the traffic twice.
    return classificados.select("hash_id").distinct()


def traffic_dashboard(trafego: DataFrame, classificados: DataFrame) -> DataFrame:
    """Volume per hour and minute (of every day), split into normal and classified traffic.

    The two volumes are added up before the join, so that the shuffle carries the key, the minute and
    two numbers. Which join is used follows from the measured size of the classified side; tables
    written with ``write_bucketed`` on ``hash_id`` need no shuffle at all.
    """
    volume = trafego.select(
        "hash_id",
        "hour",
        "minute",
        (F.col("bytes_toserver").cast("bigint") + F.col("bytes_toclient")).alias("n_bytes"),
        (F.col("pkts_toserver").cast("bigint") + F.col("pkts_toclient")).alias("n_pkts"),
    )
    flagged = volume.join(_classified_keys(classificados).withColumn("anomalous", F.lit(True)), "hash_id", "left")
    normal, anomalous = F.col("anomalous").isNull(), F.col("anomalous").isNotNull()

    def total(value: str, when: Column | None = None) -> Column:
        return F.sum(value if when is None else F.when(when, F.col(value)).otherwise(0))

    return flagged.groupBy("hour", "minute").agg(
        total("n_bytes").alias("volume_bytes_total"),
        total("n_pkts").alias("volume_pkts_total"),
        total("n_bytes", normal).alias("bytes_normais"),
        total("n_bytes", anomalous).alias("bytes_anomalos"),
        total("n_pkts", normal).alias("pkts_normais"),
        total("n_pkts", anomalous).alias("pkts_anomalos"),
    )


def split_traffic(trafego: DataFrame, classificados: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(normal, anomalous) rows of the traffic table."""
    keys = _classified_keys(classificados)
    return trafego.join(keys, "hash_id", "left_anti"), trafego.join(keys, "hash_id", "left_semi")
