"""Security inputs derived from the general test tables, row for row.

Flows come from ``lineitem``, IDS events, alerts, rules, catalogues and actions from ``events``. The
expressions are plain SQL text because the oracle evaluates the same ones; where the two engines spell
a function differently there are two texts. Nothing depends on the session time zone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlantern.sources import readers

# --- flows, one per lineitem ---------------------------------------------------------------------

SHIP_SECONDS = (
    "(CAST(unix_date(CAST(l_shipdate AS DATE)) AS BIGINT) * 86400 + hour(l_shipdate) * 3600"
    " + minute(l_shipdate) * 60 + CAST(second(l_shipdate) AS BIGINT))"
)
_NET = "CAST(30 + 10 * (l_suppkey % 2) AS STRING)"
_PACKETS = "CASE WHEN l_discount < 0.005 THEN 0 ELSE CAST(l_quantity AS BIGINT) END"

FLOW = {
    "src_ip": f"'192.168.' || {_NET} || '.' || CAST(l_suppkey % 250 + 1 AS STRING)",
    "dst_ip": "CASE WHEN l_partkey % 97 = 0 THEN '255.255.255.255' WHEN l_partkey % 89 = 0 THEN NULL"
    " ELSE '172.28.' || CAST(l_partkey % 4 AS STRING) || '.' || CAST(l_partkey % 50 + 10 AS STRING) END",
    "src_port": "CAST(1024 + l_orderkey % 60000 AS INT)",
    "dst_port": "CAST(CASE WHEN l_suppkey % 7 = 0 OR l_suppkey % 11 = 0 THEN l_partkey % 1024 + 1"
    " WHEN l_partkey % 5 = 0 THEN 22 WHEN l_partkey % 5 = 1 THEN 23 WHEN l_partkey % 5 = 2 THEN 53"
    " WHEN l_partkey % 5 = 3 THEN 80 ELSE 443 END AS INT)",
    "protocol": "CAST(CASE l_returnflag WHEN 'A' THEN 6 WHEN 'N' THEN 17 ELSE 1 END AS INT)",
    "packets": f"CAST({_PACKETS} AS BIGINT)",
    "bytes": f"CAST(({_PACKETS}) * (CASE WHEN l_suppkey % 7 = 0 OR l_suppkey % 13 = 0 THEN 40 + l_partkey % 50"
    " ELSE 200 + l_partkey % 1200 END) AS BIGINT)",
    "vlan": "CASE WHEN l_linenumber = 7 AND l_orderkey % 10 = 0 THEN NULL ELSE CAST(30 + 10 * (l_suppkey % 2) AS INT) END",
}
FLOW_EXTRA = {
    "sequence_num": "CAST(l_orderkey * 8 + l_linenumber AS BIGINT)",
    "sampling_rate": "CAST(1 + l_partkey % 3 AS INT)",
    "flow_direction": "CAST(l_suppkey % 2 AS INT)",
    "tcp_flags": "CAST(l_partkey % 64 AS INT)",
    "sampler_address": "'10.0.0.' || CAST(l_suppkey % 4 + 1 AS STRING)",
    "kafka_partition": "CAST(l_orderkey % 3 AS INT)",
    "kafka_offset": "CAST(l_orderkey * 8 + l_linenumber AS BIGINT)",
}
FLOW_COLUMNS = ["src_ip", "dst_ip", "src_port", "dst_port", "protocol", "bytes", "packets", "vlan"]


ROW_KEY = {"lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"]}


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """A base table. ``spread`` suits queries that spend more on a row than reading it."""
    rows = readers.read_table(spark, f"{sf_dir}/{name}.parquet")
    return readers.spread(rows, *ROW_KEY[name]) if spread else rows


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return readers.spread(readers.read_table_stream(spark, sf_dir, name), *ROW_KEY[name])


def flows(spark: SparkSession, sf_dir: str, replay_delay: int = 0, spread: bool = False) -> DataFrame:
    """Bronze rows. Every order divisible by 20 arrives twice, the copy ``replay_delay`` seconds later."""
    copies = F.explode(F.expr("CASE WHEN l_orderkey % 20 = 0 THEN array(0, 1) ELSE array(0) END")).alias("copy")
    base = table(spark, sf_dir, "lineitem", spread).select(
        F.lit("NETFLOW_V9").alias("flow_type"),
        F.expr(SHIP_SECONDS).alias("time_received"),
        *[F.expr(FLOW[name]).alias(name) for name in FLOW_COLUMNS],
        copies,
    )
    arrived = F.timestamp_seconds(F.col("time_received") + F.col("copy") * replay_delay)
    return base.select("flow_type", "time_received", *FLOW_COLUMNS, arrived.alias("ingestion_time"))


def flow_messages(lines: DataFrame) -> DataFrame:
    """Kafka-shaped JSON messages from lineitem rows (batch or stream).

    Odd line numbers use the collector's field names, even ones the hand-made names; every order
    divisible by 50 is unreadable text.
    """
    # Each field is computed once, in an operator of its own: in one expression the generated method
    # would outgrow what the JVM compiles.
    parts = {**FLOW, **FLOW_EXTRA, "time_received": SHIP_SECONDS}
    fields = lines.select(
        "l_orderkey", "l_linenumber", "l_suppkey", *[F.expr(text).alias(name) for name, text in parts.items()]
    )
    collector = F.struct(
        F.lit("NETFLOW_V9").alias("Type"),
        F.col("time_received").alias("TimeReceived"),
        F.col("sequence_num").alias("SequenceNum"),
        F.col("sampling_rate").alias("SamplingRate"),
        F.col("flow_direction").alias("FlowDirection"),
        F.col("src_ip").alias("SrcAddr"),
        F.col("dst_ip").alias("DstAddr"),
        F.col("src_port").alias("SrcPort"),
        F.col("dst_port").alias("DstPort"),
        F.col("protocol").alias("Proto"),
        F.col("tcp_flags").alias("TcpFlags"),
        F.col("bytes").alias("Bytes"),
        F.col("packets").alias("Packets"),
        F.col("vlan").alias("VlanId"),
        F.col("sampler_address").alias("SamplerAddress"),
    )
    manual = F.struct("vlan", "src_ip", "dst_ip", "src_port", "dst_port", "packets", "bytes")
    value = (
        F.when(F.expr("l_orderkey % 50 = 0"), F.lit("not json"))
        .when(F.expr("l_linenumber % 2 = 1"), F.to_json(collector))
        .otherwise(F.to_json(manual))
    )
    return fields.select(
        F.col("l_suppkey").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.timestamp_seconds("time_received").alias("timestamp"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
    )


# Both spellings of each field in one message, each present in some rows only.
MIXED = {
    "SrcAddr": "CASE WHEN l_linenumber % 3 <> 0 THEN 'c' || CAST(l_suppkey AS STRING) END",
    "src_ip": "CASE WHEN l_linenumber % 6 <> 0 THEN 'm' || CAST(l_suppkey AS STRING) END",
    "DstAddr": "CASE WHEN l_partkey % 2 = 0 THEN 'c' || CAST(l_partkey AS STRING) END",
    "dst_ip": "'m' || CAST(l_partkey AS STRING)",
    "SrcPort": "CASE WHEN l_orderkey % 2 = 0 THEN CAST(l_partkey % 1000 AS INT) END",
    "src_port": "CASE WHEN l_orderkey % 3 = 0 THEN CAST(l_partkey % 1000 + 1000 AS INT) END",
    "DstPort": "CASE WHEN l_suppkey % 2 = 0 THEN CAST(l_suppkey % 1000 AS INT) END",
    "dst_port": "CAST(l_suppkey % 1000 + 1000 AS INT)",
    "Bytes": "CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_orderkey % 1000 AS BIGINT) END",
    "bytes": "CAST(l_orderkey % 1000 + 1000 AS BIGINT)",
    "Packets": "CASE WHEN l_linenumber % 4 = 0 THEN CAST(l_linenumber AS BIGINT) END",
    "packets": "CASE WHEN l_partkey % 3 = 0 THEN CAST(l_linenumber + 10 AS BIGINT) END",
    "vlan": "CASE WHEN l_partkey % 4 = 0 THEN CAST(l_linenumber % 2 AS INT) END",
    "VlanId": "CASE WHEN l_partkey % 4 <= 1 THEN 10 END",
    "SrcVlan": "CASE WHEN l_partkey % 4 <= 2 THEN 20 END",
    "DstVlan": "CASE WHEN l_suppkey % 3 > 0 THEN 30 END",
}

# Ends of flows in both address families, some of them no addresses.
MIXED_ENDS = {
    "a": "CASE WHEN l_linenumber = 7 THEN 'sensor' WHEN l_partkey % 7 = 0 THEN '2001:db8:' || CAST(l_suppkey % 5 AS STRING)"
    " || '::' || CAST(l_partkey % 100 AS STRING) ELSE '192.168.' || CAST(30 + 10 * (l_suppkey % 2) AS STRING) || '.'"
    " || CAST(l_suppkey % 250 + 1 AS STRING) END",
    "b": "CASE l_partkey % 3 WHEN 0 THEN '::ffff:192.168.40.9' WHEN 1 THEN '2001:DB9:0:0:0:0:0:1' END",
}


def mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.expr(text).alias(name) for name, text in MIXED.items()]
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", F.to_json(F.struct(*fields)).alias("value"))


# --- IDS events, one per event -------------------------------------------------------------------

EVENT_MICROS = (
    "((CAST(unix_date(CAST(ts AS DATE)) AS BIGINT) * 86400 + hour(ts) * 3600 + minute(ts) * 60) * 1000000"
    " + CAST(extract(SECOND FROM ts) * 1000000 AS BIGINT))"
)
EVENT_TEXT = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || '+0000'"

CATEGORIES = [
    "Traffic of known malware",
    "Sweep over many ports",
    "Login under an odd account name",
]
EVE = {
    "flow_id": "CAST(event_id AS STRING)",
    "event_type": "CASE event_type WHEN 'error' THEN 'alert' WHEN 'signup' THEN 'dns' WHEN 'view' THEN 'http' ELSE 'flow' END",
    "src_ip": "'172.28.' || CAST(user_id % 3 AS STRING) || '.' || CAST(user_id % 60 + 1 AS STRING)",
    "dest_ip": "CASE WHEN event_id % 5 = 0 THEN '203.0.113.' || CAST(event_id % 250 + 1 AS STRING) ELSE '172.28.0.10' END",
    "src_port": "CAST(1024 + event_id % 60000 AS INT)",
    "dest_port": "CAST(CASE event_type WHEN 'view' THEN 80 WHEN 'signup' THEN 53 ELSE 22 END AS INT)",
    "proto": "CASE WHEN event_id % 3 = 0 THEN 'UDP' ELSE 'TCP' END",
    "tx_id": "CASE WHEN event_type = 'view' THEN CAST(event_id % 5 AS BIGINT) END",
}
EVE_ALERT = {
    "severity": "CASE WHEN event_type = 'error' THEN CAST(1 + event_id % 4 AS INT) END",
    "gid": "CASE WHEN event_type = 'error' THEN CAST(1 + event_id % 2 * 2 AS BIGINT) END",
    "signature_id": "CASE WHEN event_type = 'error' THEN CAST(2404000 + event_id % 3 AS BIGINT) END",
    "category": "CASE WHEN event_type = 'error' THEN CASE event_id % 3 "
    + " ".join(f"WHEN {i} THEN '{text}'" for i, text in enumerate(CATEGORIES))
    + " END END",
}
EVE_COUNTERS = {
    "pkts_toserver": "CASE WHEN event_type <> 'signup' THEN CAST(1 + event_id % 40 AS BIGINT) END",
    "pkts_toclient": "CASE WHEN event_type <> 'signup' THEN CAST(event_id % 30 AS BIGINT) END",
    "bytes_toserver": "CASE WHEN event_type <> 'signup' THEN CAST(60 * (1 + event_id % 40) AS BIGINT) END",
    "bytes_toclient": "CASE WHEN event_type <> 'signup' THEN CAST(100 * (event_id % 30) AS BIGINT) END",
}


# The second alert of a packet: another signature and severity, everything else alike.
SECOND_ALERT = {
    "severity": "CASE WHEN event_type = 'error' THEN CAST(1 + (event_id + 1) % 4 AS INT) END",
    "signature_id": "CASE WHEN event_type = 'error' THEN CAST(2404100 + event_id % 3 AS BIGINT) END",
}


def eve_lines(events: DataFrame, dirty: bool = False, paired: bool = False) -> DataFrame:
    """IDS log lines from event rows (batch or stream). ``dirty`` breaks some: unreadable text, a
    malformed time or no source address. ``paired`` logs a second alert for every packet that raises one."""
    flat = [F.expr(text).alias(name) for name, text in EVE.items()]
    moment = F.expr(EVENT_TEXT)
    if dirty:
        moment = F.when(F.expr("event_id % 31 = 1"), F.lit("yesterday")).otherwise(moment)
        flat[2] = F.when(F.expr("event_id % 29 <> 1"), F.expr(EVE["src_ip"])).alias("src_ip")
    counters = F.struct(*[F.expr(text).alias(name) for name, text in EVE_COUNTERS.items()]).alias("flow")

    def raised(alert: dict[str, str]) -> Column:
        return F.struct(*[F.expr(text).alias(name) for name, text in alert.items()])

    alert = raised(EVE_ALERT)
    if paired:
        both = F.array(alert, raised({**EVE_ALERT, **SECOND_ALERT}))
        # The alerts become rows before any text is written: with a text for each, the generated method would outgrow
        # what the JVM compiles.
        alert = F.explode(F.when(F.expr("event_type = 'error'"), both).otherwise(F.array(alert)))
        fields = events.select(moment.alias("timestamp"), *flat, counters, alert.alias("alert"))
        return fields.select(F.to_json(F.struct("timestamp", *EVE, "alert", "flow")).alias("value"))
    line = F.to_json(F.struct(moment.alias("timestamp"), *flat, alert.alias("alert"), counters))
    if dirty:
        line = F.when(F.expr("event_id % 23 = 1"), F.concat(F.lit("{cut "), F.col("event_id").cast("string"))).otherwise(line)
    return events.select(line.alias("value"))


# --- text tables, one line per event -------------------------------------------------------------

_ID = "CAST(event_id AS STRING)"
CLASS_LINE = (
    "CASE event_id % 5 WHEN 4 THEN '# config classification: off,Off,1' WHEN 3 THEN ''"
    f" ELSE 'config classification: class-' || {_ID} || ',Description of class ' || {_ID} || ','"
    " || CASE WHEN event_id % 2 = 0 THEN ' ' ELSE '' END || CAST(1 + event_id % 4 AS STRING) END"
)
REFERENCE_LINE = (
    "CASE WHEN event_id % 7 = 6 THEN '#' ELSE '' END || 'config reference: sys' || CAST(user_id AS STRING)"
    f" || CASE WHEN event_id % 2 = 0 THEN '   ' ELSE ' ' END || 'http://host' || {_ID} || '/?id='"
)
# Classes of the alerts' texts: many lines for few names and texts, one text without a class.
ALERT_CLASS_LINE = (
    "'config classification: k' || CAST(user_id % 97 AS STRING) || ',' || CASE event_id % 3"
    f" WHEN 0 THEN '{CATEGORIES[0]}' WHEN 1 THEN '{CATEGORIES[1]}' ELSE 'Text ' || {_ID} END"
    " || ',' || CAST(1 + event_id % 4 AS STRING)"
)
# Suppressions by generator and signature, by either alone, and by networks.
SUPPRESS_LINE = (
    "'suppress gen_id ' || CASE event_id % 6 WHEN 0 THEN '1, sig_id 2404001, track by_src, ip 172.28.1.0/24'"
    " WHEN 1 THEN '3, sig_id 2404000, track by_dst, ip 172.28.0.10' WHEN 2 THEN '0, sig_id 2404002, track by_src, ip [172.28.0.7, 172.28.2.0/25]'"
    " WHEN 3 THEN '3, sig_id 0, track by_dst, ip 203.0.113.' || CAST(event_id % 50 AS STRING)"
    " WHEN 4 THEN '0, sig_id 0, track by_src, ip 172.28.2.' || CAST(event_id % 9 AS STRING)"
    f" ELSE '1, sig_id ' || {_ID} END"
)
# Limits for two of the alerts' signatures of generator 1, for any of generator 3, and for the rest.
ALERT_LIMIT_LINE = (
    "CASE WHEN event_id % 2 = 0 THEN 'threshold' ELSE 'event_filter' END || ' gen_id ' || CASE event_id % 5"
    " WHEN 0 THEN '1, sig_id 2404000, type limit, track by_src, count 2, seconds 86400'"
    " WHEN 1 THEN '1, sig_id 2404001, type threshold, track by_dst, count 3, seconds 3600'"
    " WHEN 2 THEN '3, sig_id 0, type both, track by_dst, count 2, seconds 86400'"
    " WHEN 3 THEN '0, sig_id 0, type limit, track by_src, count 1, seconds 600'"
    f" ELSE '7, sig_id ' || {_ID} || ', type limit, track by_src, count 1, seconds 1' END"
)
_SIG = "'gen_id 1, sig_id ' || CAST(2404000 + event_id AS STRING)"
_LIMIT = (
    ", type ' || CASE event_id % 3 WHEN 0 THEN 'limit' WHEN 1 THEN 'threshold' ELSE 'both' END || ', track '"
    " || CASE WHEN event_id % 2 = 0 THEN 'by_src' ELSE 'by_dst' END || ', count ' || CAST(1 + event_id % 10 AS STRING)"
    " || ', seconds ' || CAST(10 * (1 + user_id % 6) AS STRING)"
)
THRESHOLD_LINE = (
    f"CASE event_id % 5 WHEN 0 THEN 'threshold ' || {_SIG} || '{_LIMIT}"
    f" WHEN 1 THEN 'event_filter ' || {_SIG} || '{_LIMIT}"
    f" WHEN 2 THEN 'suppress ' || {_SIG}"
    f" WHEN 3 THEN 'suppress ' || {_SIG} || ', track by_src, ip 172.28.' || CAST(user_id % 3 AS STRING) || '.0/24'"
    f" ELSE '#threshold ' || {_SIG} || ', type limit, track by_src, count 10, seconds 10' END"
)
RULE_LINE = (
    "CASE event_id % 8"
    " WHEN 0 THEN 'alert tcp $EXTERNAL_NET any -> 172.28.0.0/16 22 (msg:\"SSH probe ' || " + _ID + " || '\";"
    " reference:cve,2024-' || " + _ID + " || '; reference:url,example.org/' || " + _ID + " || '; classtype:network-scan; sid:'"
    " || " + _ID + " || '; rev:' || CAST(1 + user_id % 9 AS STRING) || ';)'"
    " WHEN 1 THEN 'alert dnp3 any any -> any 20000 (msg:\"control ' || " + _ID + " || '\"; sid:' || " + _ID + " || '; rev:1;)'"
    " WHEN 2 THEN 'alert tcp any any -> any any (msg:\"carries dnp3 here\"; sid:' || " + _ID + " || '; rev:2;)'"
    " WHEN 3 THEN '#alert udp any any -> any 53 (msg:\"off\"; sid:' || " + _ID + " || '; rev:1;)'"
    " WHEN 4 THEN '# how to alert on dnp3 traffic'"
    " WHEN 5 THEN ''"
    " WHEN 6 THEN 'alert udp ![10.0.0.0/8, 172.28.0.0/16] any <> any 53 (msg:\"name lookup\"; rev:3; sid:' || " + _ID + " || ';)'"
    " ELSE 'drop http any any -> any [80,443] (msg:\"quoted ' || chr(92) || '\"word' || chr(92) || '\"' || chr(92) || '; end\"; sid:'"
    " || " + _ID + " || '; rev:4;)' END"
)
RULE_FILE_LINE = (
    "CASE WHEN event_id % 50 = 0 THEN '%YAML 1.1' WHEN event_id % 50 = 1 THEN 'rule-files:'"
    " ELSE '  - emerging-' || CAST(user_id AS STRING) || '.rules' END"
)


def text_lines(spark: SparkSession, sf_dir: str, line: str) -> DataFrame:
    """``line_no``, ``line`` with one of the line expressions above."""
    # The generator keeps filters on the text from evaluating the expression again, as if it were stored.
    text = F.explode(F.array(F.expr(line))).alias("line")
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("line_no"), text)


# --- actions, six events per document ------------------------------------------------------------

DOC_ID = "CAST(floor(event_id / 6) AS BIGINT)"
ACTION_CODE = "((event_id * 7 + user_id) % 8)"
ACTION_ITEM = (
    f"CASE {ACTION_CODE}"
    " WHEN 0 THEN '{\"comando\":\"nft add rule x\",\"desfazer\":\"nft delete rule x\"}'"
    " WHEN 1 THEN '{\"comando\":\"iptables -A INPUT\",\"desfazer\":\"iptables -D INPUT\"}'"
    " WHEN 2 THEN '{\"comando\":\"killall sshd\",\"desfazer\":\"\"}'"
    " WHEN 3 THEN '{\"comando\":\"kill -9 1\",\"desfazer\":\"systemctl start x\"}'"
    " WHEN 4 THEN '{\"comando\":\"\",\"desfazer\":\"chmod 600 x\"}'"
    " WHEN 5 THEN '{\"note\":1}' WHEN 6 THEN '\"x\"' ELSE '17' END"
)


def action_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id``, ``body``. A document has the six items of its event ids, as an array or in an object; some are
    cut short."""
    items = table(spark, sf_dir, "events").select(
        F.expr(DOC_ID).alias("doc_id"), F.struct("event_id", F.expr(ACTION_ITEM).alias("item")).alias("entry")
    )
    # At most six entries per document by construction of the id.
    ordered = F.array_sort(F.collect_list("entry")).alias("entries")
    grouped = items.groupBy("doc_id").agg(ordered)
    listed = F.concat_ws(",", F.transform("entries", lambda entry: entry["item"]))
    named = F.concat_ws(
        ",", F.transform("entries", lambda e: F.concat(F.lit('"k'), e["event_id"].cast("string"), F.lit('":'), e["item"]))
    )
    end = F.when(F.col("doc_id") % 25 == 0, "").otherwise("]")
    body = F.when(F.col("doc_id") % 25 == 1, F.concat(F.lit("{"), named, F.lit("}")))
    return grouped.select("doc_id", body.otherwise(F.concat(F.lit("["), listed, end)).alias("body"))


# --- logs that grow ------------------------------------------------------------------------------


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


SENSOR_LINES = 1_000_000


def sensors(lines: DataFrame) -> int:
    """How many logs share ``lines``: four, and one more for every million, so that no log takes longer on large tables."""
    return 4 + lines.count() // SENSOR_LINES


def append_lines(lines: DataFrame, folder: str, files: int = 4) -> None:
    """Appends ``value`` to the logs of ``files`` sensors, each written by a task of its own."""
    store, root = _store(folder)
    store.create_dir(root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        count = 0
        with store.open_append_stream(f"{root}/eve-{TaskContext.get().partitionId()}.json") as log:
            for batch in batches:
                log.write("".join(f"{line}\n" for line in batch["value"].to_pylist()).encode())
                count += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([count])], names=["lines"])

    lines.select("value").repartition(files, F.crc32("value")).mapInArrow(write, "lines long").agg(F.sum("lines")).collect()


def rotate(folder: str) -> None:
    """Renames the logs in use, as rotation does; the sensors start new files."""
    store, root = _store(folder)
    for info in store.get_file_info(fs.FileSelector(root)):
        if info.base_name.endswith(".json"):
            store.move(info.path, f"{info.path}.1")
