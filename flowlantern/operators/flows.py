"""Flow messages to bronze, silver and gold tables. Every function works on batches and streams alike
unless it aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlantern.functions.measures import behaviour_label, bytes_per_packet
from flowlantern.schemas import (
    BRONZE_NARROW,
    BRONZE_WIDE,
    DELIVERY_COLUMNS,
    FLOW_ALIASES,
    FLOW_BASIC_JSON,
    FLOW_JSON,
    FLOW_PARSED,
)


def decode_envelope(messages: DataFrame, wide: bool = True) -> DataFrame:
    """Kafka record to text payload; ``wide`` keeps key, time, partition and offset."""
    columns = [F.col("value").cast("string").alias("value")]
    if wide:
        columns += [
            F.col("key").cast("string").alias("kafka_key"),
            F.col("timestamp").alias("kafka_timestamp"),
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
        ]
    return messages.select(*columns)


def _expand(record: Column) -> Column:
    # A generator is a barrier for predicate pushdown: without it a later filter would parse the
    # text a second time.
    return F.inline(F.array(record))


def parse_flows(messages: DataFrame, column: str = "value") -> DataFrame:
    """Adds one column per known message field; a bad or wrong-typed field becomes NULL.

    Field names that differ in case only cannot be told apart by name in a case-insensitive session,
    so the parsed struct is renamed by position with a cast. The text is parsed once.
    """
    return messages.select("*", _expand(F.from_json(column, FLOW_JSON).cast(FLOW_PARSED)))


def parse_flows_basic(messages: DataFrame, column: str = "value") -> DataFrame:
    """Six-field messages. Unreadable text stays as a row of NULLs, as this variant has no filter."""
    return messages.select(_expand(F.from_json(column, FLOW_BASIC_JSON)))


def reconcile(parsed: DataFrame, aliases: Mapping[str, Sequence[str]] = FLOW_ALIASES) -> DataFrame:
    """Replaces the candidate columns of each output by their first non-null value."""
    candidates = {name for names in aliases.values() for name in names}
    kept = [name for name in parsed.columns if name not in candidates]
    return parsed.select(*kept, *[F.coalesce(*names).alias(output) for output, names in aliases.items()])


def to_bronze(reconciled: DataFrame, wide: bool = False, ingestion_time: Column | None = None) -> DataFrame:
    """Bronze layout, without the check for a source address."""
    moment = F.current_timestamp() if ingestion_time is None else ingestion_time
    return reconciled.select(*(BRONZE_WIDE if wide else BRONZE_NARROW), moment.alias("ingestion_time"))


def valid_flows(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("src_ip").isNotNull())


def bronze_flows(messages: DataFrame, wide: bool = False, ingestion_time: Column | None = None) -> DataFrame:
    """Messages (``value`` text, plus the delivery columns when ``wide``) to bronze rows."""
    return valid_flows(to_bronze(reconcile(parse_flows(messages)), wide, ingestion_time))


def bronze_basic(messages: DataFrame, ingestion_time: Column | None = None) -> DataFrame:
    """Six-field messages to bronze rows, unreadable ones included."""
    moment = F.current_timestamp() if ingestion_time is None else ingestion_time
    return parse_flows_basic(messages).withColumn("ingestion_time", moment)


def rejected_flows(messages: DataFrame) -> DataFrame:
    """Raw messages bronze leaves out: unreadable text or no source address."""
    return reconcile(parse_flows(messages)).filter(F.col("src_ip").isNull()).select(*messages.columns)


def nonzero_flows(flows: DataFrame) -> DataFrame:
    return flows.filter((F.col("packets") > 0) & (F.col("bytes") > 0))


def without_broadcast(flows: DataFrame, broadcast_address: str = "255.255.255.255") -> DataFrame:
    """Drops limited-broadcast targets; a NULL target is unknown and dropped as well."""
    return flows.filter(F.col("dst_ip") != broadcast_address)


def clean_flows(bronze: DataFrame, dedupe: str = "row", known: DataFrame | None = None) -> DataFrame:
    """Silver rows: real traffic only, without duplicates and, with ``"row"``, without those that ``known`` holds.

    ``dedupe="row"`` compares all columns. ``"key"`` ignores how and when a message arrived, so a
    replay in a later micro-batch collapses too; the earliest delivery is kept. Copies are combined before
    the shuffle, so a hot group of them shrinks map-side. Where a delivery is one column, and without a key,
    that is a hash aggregate; the several columns of the wide layout have to come from one message, which
    costs a sort on both sides of the shuffle.
    """
    flows = without_broadcast(nonzero_flows(bronze))
    if dedupe == "row" and known is not None:
        both = flows.withColumn("known", F.lit(False)).unionByName(known.withColumn("known", F.lit(True)))
        return both.groupBy(*flows.columns).agg(F.max("known").alias("known")).where(~F.col("known")).drop("known")
    if dedupe == "row":
        return flows.dropDuplicates()
    if known is not None:
        raise ValueError("known rows are compared whole")
    if dedupe != "key":
        raise ValueError(f"dedupe must be 'row' or 'key', not {dedupe!r}")
    delivery = [name for name in DELIVERY_COLUMNS if name in flows.columns]
    key = [name for name in flows.columns if name not in delivery]
    if not delivery:
        return flows.dropDuplicates()
    if len(delivery) == 1:
        return flows.groupBy(*key).agg(F.min(delivery[0]).alias(delivery[0])).select(*flows.columns)
    first = flows.groupBy(*key).agg(F.min(F.struct(*delivery)).alias("first"))
    return first.select(*key, "first.*").select(*flows.columns)


def gold_features(silver: DataFrame, approx: bool = False, rsd: float = 0.02) -> DataFrame:
    """Traffic features per source and VLAN (a NULL VLAN is a group of its own).

    The exact distinct counts are planned as an expand whose first shuffle hashes on source, VLAN and
    the counted value, so one hot source is spread over all tasks; the second shuffle carries one row
    per task and group. ``approx`` replaces them by sketches: one shuffle, relative error ``rsd``.
    """
    if approx:
        targets, ports = F.approx_count_distinct("dst_ip", rsd), F.approx_count_distinct("dst_port", rsd)
    else:
        targets, ports = F.count_distinct("dst_ip"), F.count_distinct("dst_port")
    sums = silver.groupBy("src_ip", "vlan").agg(
        F.sum("packets").alias("total_packets"),
        F.sum("bytes").alias("total_bytes"),
        targets.alias("unique_targets"),
        ports.alias("unique_ports"),
    )
    return sums.withColumn("bytes_per_packet", bytes_per_packet("total_bytes", "total_packets"))


def daily_sketches(silver: DataFrame, lg_k: int = 12) -> DataFrame:
    """Sums and sketches of the distinct targets and ports per day, source and VLAN: small rows to be stored, from which
    the features of any span of days follow without its flows. Relative standard error 1.04 / sqrt(2 ** ``lg_k``)."""
    day = F.floor(F.col("time_received") / 86400).cast("bigint").alias("event_day")
    return silver.groupBy(day, "src_ip", "vlan").agg(
        F.sum("packets").alias("packets"),
        F.sum("bytes").alias("bytes"),
        F.hll_sketch_agg("dst_ip", lg_k).alias("targets"),
        F.hll_sketch_agg("dst_port", lg_k).alias("ports"),
    )


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """Gold features of the days in ``sketches``, their distinct counts estimated."""
    merged = sketches.groupBy("src_ip", "vlan").agg(
        F.sum("packets").alias("total_packets"),
        F.sum("bytes").alias("total_bytes"),
        F.hll_sketch_estimate(F.hll_union_agg("targets")).alias("unique_targets"),
        F.hll_sketch_estimate(F.hll_union_agg("ports")).alias("unique_ports"),
    )
    return merged.withColumn("bytes_per_packet", bytes_per_packet("total_bytes", "total_packets"))


def label_behaviour(features: DataFrame, min_ports: int = 10, max_bpp: float = 100) -> DataFrame:
    label = behaviour_label(F.col("unique_ports"), F.col("bytes_per_packet"), min_ports, max_bpp)
    return features.withColumn("comportamento", label)


def bronze_total(bronze: DataFrame) -> DataFrame:
    return bronze.agg(F.count(F.lit(1)).alias("total_records"))


def volume_by_vlan(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("vlan").agg(F.count(F.lit(1)).alias("count")).orderBy("vlan")


def latest(bronze: DataFrame, n: int = 20, by: str = "ingestion_time") -> DataFrame:
    """The ``n`` newest rows; the other columns break ties so that the answer is stable."""
    rest = [F.col(name).asc_nulls_last() for name in bronze.columns if name != by]
    return bronze.orderBy(F.col(by).desc_nulls_last(), *rest).limit(n)


def sample_rows(table: DataFrame, n: int, *order: str) -> DataFrame:
    """A look at ``n`` rows, the first ones by ``order`` when given."""
    return (table.orderBy(*order) if order else table).limit(n)


def with_event_time(flows: DataFrame) -> DataFrame:
    """Adds ``event_time`` from the epoch seconds the collector stamped."""
    return flows.withColumn("event_time", F.timestamp_seconds("time_received"))
