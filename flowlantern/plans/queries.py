"""Named queries: each operator applied to whole tables. Times are returned as epoch numbers, so the
results do not depend on the session time zone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlantern.functions.net import direction, direction_by_networks, in_port_group
from flowlantern.operators import actions, alerts, catalogues, flows, ids, rules, sessions
from flowlantern.plans import increment, medallion
from flowlantern.schemas import BRONZE_NARROW
from flowlantern.session import shared_dir, state_store, stored
from flowlantern.sources import derived, readers, writers
from flowlantern.streaming import jobs, stateful

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = 86400
SESSION_IDLE = 6 * 3600
FLOW_LIFE = 24 * 3600
LIMIT_SECONDS = 3 * DAY
STREAM_LATE = "1 hour"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _seconds(name: str) -> Column:
    return F.unix_seconds(name).alias(name)


def _micros(name: str) -> Column:
    return F.unix_micros(name).alias(name)


def _times(table: DataFrame, convert: Callable[[str], Column], *names: str) -> DataFrame:
    return table.select(*[convert(name) if name in names else name for name in table.columns])


# --- flows ---------------------------------------------------------------------------------------


def _messages(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    return flows.decode_envelope(derived.flow_messages(derived.table(spark, sf_dir, "lineitem")), wide)


def _bronze(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return derived.flows(spark, sf_dir, spread=spread)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.clean_flows(_bronze(spark, sf_dir, spread=True))


@query
def parse_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.parse_flows(_messages(spark, sf_dir)).drop("value")


@query
def parse_flows_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.parse_flows_basic(_messages(spark, sf_dir))


@query
def reconcile_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    reconciled = flows.reconcile(flows.parse_flows(derived.mixed_messages(spark, sf_dir)))
    outputs = ["src_ip", "dst_ip", "src_port", "dst_port", "bytes", "packets", "vlan"]
    return reconciled.select("l_orderkey", "l_linenumber", *outputs)


@query
def bronze_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.bronze_flows(_messages(spark, sf_dir)).drop("ingestion_time")


@query
def bronze_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = flows.bronze_flows(_messages(spark, sf_dir, wide=True), wide=True).drop("ingestion_time")
    return _times(bronze, _seconds, "kafka_timestamp")


@query
def bronze_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source address present, on messages that carry either spelling or none."""
    bronze = flows.to_bronze(flows.reconcile(flows.parse_flows(derived.mixed_messages(spark, sf_dir))))
    return flows.valid_flows(bronze).drop("ingestion_time")


@query
def bronze_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = flows.rejected_flows(_messages(spark, sf_dir, wide=True))
    return _times(rejected, _seconds, "kafka_timestamp")


@query
def silver_nonzero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times(flows.nonzero_flows(_bronze(spark, sf_dir)), _seconds, "ingestion_time")


@query
def silver_no_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times(flows.without_broadcast(_bronze(spark, sf_dir)), _seconds, "ingestion_time")


@query
def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times(_silver(spark, sf_dir), _seconds, "ingestion_time")


@query
def silver_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies arrive a minute later, so only the key mode removes them."""
    replayed = derived.flows(spark, sf_dir, replay_delay=60, spread=True)
    return _times(flows.clean_flows(replayed, dedupe="key"), _seconds, "ingestion_time")


@query
def silver_by_key_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message is sent again a minute later."""
    sent = flows.bronze_flows(_messages(spark, sf_dir, wide=True), wide=True)
    sent = sent.withColumn("ingestion_time", F.col("kafka_timestamp"))
    later = F.col("kafka_timestamp") + F.expr("INTERVAL 1 MINUTE")
    again = sent.withColumns(
        {"kafka_timestamp": later, "ingestion_time": later, "kafka_offset": F.col("kafka_offset") + 1_000_000_000}
    )
    kept = flows.clean_flows(sent.unionByName(again), dedupe="key")
    return _times(kept.drop("ingestion_time"), _seconds, "kafka_timestamp")


@query
def gold_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.gold_features(_silver(spark, sf_dir))


@query
def gold_behaviour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.label_behaviour(flows.gold_features(_silver(spark, sf_dir)))


@query
def gold_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.sample_rows(gold_behaviour(spark, sf_dir), 10, "src_ip", "vlan")


@query
def bronze_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.bronze_total(_bronze(spark, sf_dir))


@query
def volume_by_vlan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.volume_by_vlan(_bronze(spark, sf_dir))


@query
def latest_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times(flows.latest(_bronze(spark, sf_dir)), _seconds, "ingestion_time")


@query
def flow_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_day = flows.with_event_time(_bronze(spark, sf_dir)).withColumn(
        "event_day", F.floor(F.unix_seconds("event_time") / DAY).cast("bigint")
    )
    return per_day.groupBy("event_day").agg(
        F.count(F.lit(1)).alias("records"), F.max(F.unix_seconds("event_time")).alias("last_second")
    )


@query
def encode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows encoded as messages and decoded again."""
    rows = _bronze(spark, sf_dir, spread=True).select(*BRONZE_NARROW)
    decoded = F.from_json("value", rows.schema)
    return writers.encode_json(rows, "src_ip").select("key", F.inline(F.array(decoded)))


@query
def medallion_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze, silver and gold as stored tables."""
    root = shared_dir(spark, "medallion")
    writers.write_table(_bronze(spark, sf_dir, spread=True), f"{root}/bronze", ["vlan"])
    return medallion.refine(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold")


@query
def medallion_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of three runs, each over what bronze got since the one before. The last delivers rows of the first again."""
    root = shared_dir(spark, "increment")
    bronze = _bronze(spark, sf_dir, spread=True)
    third = F.pmod("src_port", F.lit(3))
    for part in (third == 0, third == 1, third != 1):
        # No rebalance: the tasks that read the table write a file for each of its few VLANs.
        writers.write_table(bronze.where(part), f"{root}/bronze", ["vlan"], mode="append")
        # The test table spans years, not the few days of a run.
        jobs.finish(increment.run_refine(spark, f"{root}/bronze", f"{root}/refined", fold=2, unit="year"))
    return flows.label_behaviour(increment.gold_table(spark, f"{root}/refined", fold=2))


@query
def gold_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct counts, and whether the estimates from stored daily sketches are within three standard errors."""
    silver = _silver(spark, sf_dir)
    estimates = flows.merged_sketches(stored(flows.daily_sketches(silver), "sketches"))
    exact, about = flows.gold_features(silver).alias("e"), estimates.alias("a")
    same = (F.col("e.src_ip") == F.col("a.src_ip")) & F.col("e.vlan").eqNullSafe(F.col("a.vlan"))

    def near(name: str) -> Column:
        return F.abs(F.col(f"e.{name}") - F.col(f"a.{name}")) <= F.col(f"e.{name}") * (3 * 1.04 / 2**6) + 0.5

    counts = [F.col(f"e.{name}") for name in ("src_ip", "vlan", "total_bytes", "unique_targets", "unique_ports")]
    checks = [near("unique_targets").alias("targets_hold"), near("unique_ports").alias("ports_hold")]
    return exact.join(about, same, "left").select(*counts, *checks)


@query
def compacted_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "compact")
    writers.write_table(_bronze(spark, sf_dir, spread=True), f"{root}/bronze", ["vlan"])
    writers.compact(spark, f"{root}/bronze", f"{root}/compacted")
    return flows.volume_by_vlan(readers.read_table(spark, f"{root}/compacted"))


# --- network predicates --------------------------------------------------------------------------


@query
def flow_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _bronze(spark, sf_dir, spread=True).withColumn("direction", direction("src_ip", "dst_ip"))
    return labelled.groupBy("direction").agg(F.count(F.lit(1)).alias("flows"), F.sum("bytes").alias("bytes"))


# A home of both families with holes, and a part of a hole that belongs to it again.
HOME_LISTS = (
    "[2001:db8::/32, ![2001:db8:3::/48, !2001:db8:3::40/123], [192.168.30.0/24, !192.168.30.0/25, !192.168.30.192/26],"
    " 192.168.40.0/24, !192.168.40.16/28]"
)


@query
def flow_direction_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows between ends of both address families, by the side of a home list on which they are."""
    ends = derived.table(spark, sf_dir, "lineitem").select(*[F.expr(text).alias(name) for name, text in derived.MIXED_ENDS.items()])
    labelled = ends.withColumn("direction", direction_by_networks("a", "b", HOME_LISTS))
    return labelled.groupBy("direction").agg(F.count(F.lit(1)).alias("flows"), F.countDistinct("a").alias("sources"))


@query
def event_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("flow_id", direction("src_ip", "dest_ip").alias("direction"))


@query
def http_port_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    http = _bronze(spark, sf_dir).filter(in_port_group("dst_port"))
    return _times(http, _seconds, "ingestion_time")


# --- IDS events ----------------------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    return ids.parse_eve(derived.eve_lines(derived.table(spark, sf_dir, "events"), dirty))


def _trafego(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.to_trafego(_events(spark, sf_dir)).drop("event_date")


def _classificados(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of severity 1 (already handled) and 2, labelled by severity."""
    rows = _trafego(spark, sf_dir).filter(F.col("severity").isin(1, 2))
    first = F.col("severity") == 1
    labelled = rows.withColumns(
        {"class": F.when(first, "bruteforce").otherwise("portscan"), "processado": F.when(first, 1)}
    )
    return ids.to_classificados(labelled)


@query
def eve_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times(ids.flatten_eve(_events(spark, sf_dir)), _micros, "ts")


@query
def eve_time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ids.with_time_parts(ids.flatten_eve(_events(spark, sf_dir, dirty=True)))
    return parts.select("flow_id", "hour", "minute", "seconds", F.unix_date("event_date").alias("event_day"))


@query
def eve_fill_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = ids.fill_zero(ids.with_time_parts(ids.flatten_eve(_events(spark, sf_dir, dirty=True))))
    return filled.drop("event_date", "timestamp", "tx_id", "gid", "signature_id", "category")


@query
def eve_event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    selected = ids.select_events(_events(spark, sf_dir))
    return selected.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@query
def eve_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.rejected_events(_events(spark, sf_dir, dirty=True)).select("_corrupt_record", "flow_id")


@query
def alerts_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.alerts(_events(spark, sf_dir)).select("flow_id", "src_ip", "dest_ip", "alert.*")


@query
def trafego(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.to_trafego(_events(spark, sf_dir), key=False)


@query
def trafego_from_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from JSON-lines files, read with the declared schema."""
    log = shared_dir(spark, "log")
    derived.eve_lines(derived.table(spark, sf_dir, "events")).write.text(log)
    return ids.to_trafego(readers.read_eve(spark, log), key=False)


@query
def trafego_hash_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trafego(spark, sf_dir).select("flow_id", "hash_id")


@query
def trafego_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log read twice, as a job without memory would; packets that raise an alert raise a second one."""
    lines = derived.eve_lines(derived.table(spark, sf_dir, "events"), paired=True)
    twice = ids.to_trafego(ids.parse_eve(lines)).drop("event_date")
    return ids.dedupe_trafego(twice.unionByName(twice))


@query
def growing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs taken in while they grow: three deliveries, the files renamed by rotation after the second."""
    root = shared_dir(spark, "growing")
    # Dealt out for the texts, which cost more than the rows; written once for the three deliveries.
    events = derived.table(spark, sf_dir, "events", spread=False).repartition(*derived.ROW_KEY["events"])
    lines = stored(derived.eve_lines(events, paired=True), "growing-lines")
    sensors = derived.sensors(lines)
    part = F.crc32("value") % 3
    for number in range(3):
        if number == 2:
            derived.rotate(f"{root}/log")
        derived.append_lines(lines.filter(part == number), f"{root}/log", sensors)
        jobs.ingest_log(spark, f"{root}/log", f"{root}/table", f"{root}/checkpoint")
    return readers.read_table(spark, f"{root}/table").drop("event_date")


@query
def classified_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classificados(spark, sf_dir)


@query
def classified_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.pending(_classificados(spark, sf_dir))


@query
def traffic_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.traffic_dashboard(_trafego(spark, sf_dir), _classificados(spark, sf_dir))


@query
def traffic_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.split_traffic(_trafego(spark, sf_dir), _classificados(spark, sf_dir))[0]


@query
def traffic_anomalous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.split_traffic(_trafego(spark, sf_dir), _classificados(spark, sf_dir))[1]


# --- alerts --------------------------------------------------------------------------------------


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_table(_events(spark, sf_dir))


@query
def alert_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = catalogues.classification_dim(derived.text_lines(spark, sf_dir, derived.ALERT_CLASS_LINE))
    return alerts.enrich_class(_alerts(spark, sf_dir), dim).select("alert_id", "category", "shortname", "priority")


@query
def alerts_suppressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts that remain."""
    suppressions = catalogues.threshold_dim(derived.text_lines(spark, sf_dir, derived.SUPPRESS_LINE))
    left = alerts.suppress(_alerts(spark, sf_dir), suppressions)
    return left.select("alert_id", "sig_id", "src_ip", "dest_ip")


@query
def alerts_limited_by_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = catalogues.threshold_dim(derived.text_lines(spark, sf_dir, derived.ALERT_LIMIT_LINE))
    return alerts.apply_limits(_alerts(spark, sf_dir), limits).select("alert_id", "gid", "sig_id")


def _limited(spark: SparkSession, sf_dir: str, kind: str, n: int, seconds: int, track: str = "by_src") -> DataFrame:
    kept = alerts.rate_limit(_alerts(spark, sf_dir), kind, n, seconds, track)
    return kept.select("alert_id", "sig_id", "src_ip", "dest_ip", _micros("ts"))


@query
def alerts_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _limited(spark, sf_dir, "limit", 1, DAY)


@query
def alerts_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _limited(spark, sf_dir, "threshold", 3, DAY, "by_dst")


@query
def alerts_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _limited(spark, sf_dir, "both", 2, DAY, "by_dst")


# --- catalogues and rules ------------------------------------------------------------------------


@query
def classification_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogues.classification_dim(derived.text_lines(spark, sf_dir, derived.CLASS_LINE)).drop("line_no")


@query
def reference_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogues.reference_dim(derived.text_lines(spark, sf_dir, derived.REFERENCE_LINE))


@query
def threshold_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogues.threshold_dim(derived.text_lines(spark, sf_dir, derived.THRESHOLD_LINE))


@query
def reference_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reference per event, some to systems the catalogue lacks."""
    cited = derived.table(spark, sf_dir, "events").select(
        "event_id", F.expr("'SYS' || CAST((user_id + event_id % 2 * 100000000) AS STRING) || ',' || CAST(event_id AS STRING)").alias("reference")
    )
    return alerts.enrich_reference(cited, reference_dim(spark, sf_dir))


@query
def rules_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = rules.parse_rules(derived.text_lines(spark, sf_dir, derived.RULE_LINE))
    return parsed.withColumn("references", F.concat_ws(" ", "references"))


@query
def rules_unparsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other rule of one kind has lost its arrow."""
    lines = derived.text_lines(spark, sf_dir, derived.RULE_LINE)
    cut = F.when(F.col("line_no") % 16 == 2, F.replace("line", F.lit(" -> "), F.lit(" "))).otherwise(F.col("line"))
    return rules.unparsed_rules(lines.withColumn("line", cut))


@query
def rule_reference_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rule_references(rules.parse_rules(derived.text_lines(spark, sf_dir, derived.RULE_LINE)))


@query
def rules_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.prune_rules(derived.text_lines(spark, sf_dir, derived.RULE_LINE))


@query
def rules_disabled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.disable_rules(derived.text_lines(spark, sf_dir, derived.RULE_LINE))


@query
def rule_files_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogues.distinct_rule_files(derived.text_lines(spark, sf_dir, derived.RULE_FILE_LINE))


@query
def catalogue_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A class catalogue against a version with other priorities, lost and doubled entries."""
    old = catalogues.classification_dim(derived.text_lines(spark, sf_dir, derived.CLASS_LINE))
    changed = old.withColumn("priority", F.when(F.col("line_no") % 10 == 0, 9).otherwise(F.col("priority")))
    new = changed.filter(F.col("line_no") % 11 != 0)
    new = new.unionByName(changed.filter(F.col("line_no") % 13 == 0))
    return catalogues.catalogue_diff(old, new, ["shortname", "description", "priority"])


# --- actions -------------------------------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.valid_actions(derived.action_documents(spark, sf_dir))


@query
def actions_valid_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir)


@query
def actions_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.actions(_documents(spark, sf_dir))


@query
def actions_odd_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.odd_items(_documents(spark, sf_dir))


@query
def actions_undo(spark: SparkSession, sf_dir: str) -> DataFrame:
    undo = actions.action_verdict(actions.actions(_documents(spark, sf_dir)), "prefix", "desfazer")
    return undo.select("doc_id", "pos", "desfazer", "verdict")


@query
def action_verdict_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = actions.action_verdict(actions.actions(_documents(spark, sf_dir)), "prefix")
    return judged.select("doc_id", "pos", "comando", "verdict")


@query
def action_verdict_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = actions.action_verdict(actions.actions(_documents(spark, sf_dir)), "word")
    return judged.select("doc_id", "pos", "comando", "verdict")


@query
def actions_strict_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.strict_prefix(_documents(spark, sf_dir))


# --- flow assembly and streams -------------------------------------------------------------------


def flow_records(events: DataFrame) -> DataFrame:
    """Flow records from event rows (batch or stream), one client port per user."""
    return events.select(
        F.expr(derived.EVE["src_ip"]).alias("src_ip"),
        F.expr(derived.EVE["dest_ip"]).alias("dest_ip"),
        F.expr("CAST(1024 + user_id % 60000 AS INT)").alias("src_port"),
        F.expr(derived.EVE["dest_port"]).alias("dest_port"),
        F.expr(derived.EVE["proto"]).alias("proto"),
        F.timestamp_micros(F.expr(derived.EVENT_MICROS)).alias("event_time"),
        F.expr("CAST(1 + event_id % 40 AS BIGINT)").alias("packets"),
        F.expr("CAST(60 * (1 + event_id % 40) AS BIGINT)").alias("bytes"),
    )


def _assembled(found: DataFrame) -> DataFrame:
    return _times(found, _micros, "start_time", "end_time")


@query
def flow_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assembled(sessions.assemble_flows(flow_records(derived.table(spark, sf_dir, "events")), SESSION_IDLE))


@query
def flow_life(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows cut by idle time and by age."""
    records = flow_records(derived.table(spark, sf_dir, "events"))
    return _assembled(sessions.assemble_flows(records, SESSION_IDLE * 4, max_life=FLOW_LIFE))


def _run(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Takes a stream through the exactly-once parquet sink and returns the stored rows."""
    root = shared_dir(spark, name)
    with state_store(spark):
        jobs.finish(jobs.write_stream(stream, f"{root}/table", f"{root}/checkpoint"))
    return readers.read_table(spark, f"{root}/table")


@query
def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as ``bronze_narrow``, streamed into the table partitioned by VLAN."""
    root = shared_dir(spark, "bronze")
    messages = derived.flow_messages(derived.table_stream(spark, sf_dir, "lineitem"))
    jobs.finish(jobs.run_bronze(messages, f"{root}/table", f"{root}/checkpoint"))
    return readers.read_table(spark, f"{root}/table").select(*BRONZE_NARROW)


@query
def eve_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log delivered by two runs; the second one adds nothing."""
    root = shared_dir(spark, "eve")
    for run in ("first", "second"):
        events = ids.parse_eve(derived.eve_lines(derived.table_stream(spark, sf_dir, "events"), dirty=True))
        jobs.finish(jobs.run_eve_ingest(events, f"{root}/table", f"{root}/{run}", f"{root}/rejected-{run}"))
    return readers.read_table(spark, f"{root}/table").drop("event_date")


@query
def fan_out_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages sent to two sinks, each counted by source."""
    root = shared_dir(spark, "fan")
    messages = derived.flow_messages(derived.table_stream(spark, sf_dir, "lineitem"))
    bronze = flows.bronze_flows(flows.decode_envelope(messages, wide=False))
    jobs.finish(
        jobs.fan_out(
            bronze,
            f"{root}/checkpoint",
            jobs.folder_writer(f"{root}/lake"),
            lambda batch, batch_id: jobs.folder_writer(f"{root}/messages", "json")(writers.encode_json(batch), batch_id),
        )
    )
    lake = spark.read.parquet(f"{root}/lake").select("src_ip", F.lit("lake").alias("sink"))
    sent = spark.read.schema("value string").json(f"{root}/messages")
    sent = sent.select(F.get_json_object("value", "$.src_ip").alias("src_ip"), F.lit("messages").alias("sink"))
    return lake.unionByName(sent).groupBy("sink", "src_ip").agg(F.count(F.lit(1)).alias("messages"))


@query
def dedupe_flow_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages delivered twice within the horizon, stored once."""
    lines = derived.table_stream(spark, sf_dir, "lineitem")
    key = [name for name in BRONZE_NARROW if name != "flow_type"]
    records = lines.select(
        F.expr(derived.SHIP_SECONDS).alias("time_received"),
        *[F.expr(derived.FLOW[name]).alias(name) for name in derived.FLOW_COLUMNS],
        F.explode(F.array(F.lit(0), F.lit(1))).alias("delivery"),
    )
    timed = flows.with_event_time(records)
    return _run(spark, jobs.dedupe_stream(timed, key, STREAM_LATE), "dedupe").select(*key)


def _in_batches(spark: SparkSession, sf_dir: str, batches: int = 4, files: int = 4) -> DataFrame:
    """The events as a stream of several micro-batches. Events come up to 50 minutes out of order, across batches
    too; each batch is written after the one before, in ``files`` files."""
    root = shared_dir(spark, "delivered")
    moment = F.expr(f"{derived.EVENT_MICROS} + event_id * 7919 % 3000 * 1000000")
    events = derived.table(spark, sf_dir, "events", spread=False).withColumn("arrival", moment)
    cuts = events.approxQuantile("arrival", [i / batches for i in range(1, batches)], 0.01)
    for low, high in zip([None, *cuts], [*cuts, None]):
        after = F.lit(True) if low is None else F.col("arrival") >= low
        before = F.lit(True) if high is None else F.col("arrival") < high
        part = events.filter(after & before).drop("arrival").repartition(files)
        part.write.mode("append").parquet(f"{root}/events.parquet")
    return readers.read_table_stream(spark, root, "events", max_files=files)


@query
def stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stored history tells of a stream in four micro-batches that two runs took."""
    root = shared_dir(spark, "history")
    history = jobs.StreamHistory(spark, f"{root}/history", every=3)
    spark.streams.addListener(history)
    try:
        events = _in_batches(spark, sf_dir)
        for kept in (events, events):
            run = jobs.write_stream(kept, f"{root}/table", f"{root}/checkpoint")
            jobs.finish(run)
            history.wait(run)
    finally:
        spark.streams.removeListener(history)
    writers.compact(spark, f"{root}/history", f"{root}/compacted", ())
    found = jobs.read_history(spark, f"{root}/compacted").where(F.col("input_rows") > 0)
    return jobs.stream_health(found).select("batches", "last_batch", "input_rows")


@query
def flow_session_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows that were over when the stream ended."""
    records = flow_records(_in_batches(spark, sf_dir))
    over = stateful.assemble_flows_stream(records, SESSION_IDLE, None, late=STREAM_LATE)
    return _assembled(_run(spark, over, "sessions"))


@query
def flow_life_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows cut by idle time and by age, as far as they were over when the stream ended."""
    records = flow_records(_in_batches(spark, sf_dir))
    over = stateful.assemble_flows_stream(records, SESSION_IDLE * 4, FLOW_LIFE, late=STREAM_LATE)
    return _assembled(_run(spark, over, "life"))


@query
def rate_limit_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two alerts per signature, source and period; a period starts with its first alert."""
    lines = derived.eve_lines(_in_batches(spark, sf_dir))
    limited = stateful.rate_limit_stream(
        alerts.alert_table(ids.parse_eve(lines)), "limit", 2, LIMIT_SECONDS, "by_src", STREAM_LATE
    )
    return _times(_run(spark, limited, "limit"), _micros, "ts")
