"""DuckDB SQL with the expected result of each query, written against the base tables.

Input rows use the expressions of ``sources.derived``; everything an operator does is restated here
without its help (no JSON parsing, no rule regexes, no Spark functions).
"""

from __future__ import annotations

from flowlantern.plans import queries as q
from flowlantern.schemas import FLOW_FIELDS
from flowlantern.sources import derived as d

_SHIP = "CAST(floor(epoch(l_shipdate)) AS BIGINT)"
_FLOW_LIST = ", ".join(f"{text} AS {name}" for name, text in d.FLOW.items())
_EXTRA_LIST = ", ".join(f"{text} AS {name}" for name, text in d.FLOW_EXTRA.items())


def _with(**tables: str) -> str:
    return "WITH " + ", ".join(f"{name} AS ({sql})" for name, sql in tables.items()) + " "


# --- flows ---

_BASE = (
    f"SELECT l_orderkey, l_linenumber, l_suppkey, 'NETFLOW_V9' AS flow_type, {_SHIP} AS time_received,"
    f" {_FLOW_LIST}, {_EXTRA_LIST} FROM lineitem"
)
_NARROW = "flow_type, time_received, src_ip, dst_ip, src_port, dst_port, protocol, bytes, packets, vlan"


def _flows(delay: int = 0) -> str:
    return (
        f"SELECT {_NARROW}, time_received AS ingestion_time FROM base UNION ALL"
        f" SELECT {_NARROW}, time_received + {delay} AS ingestion_time FROM base WHERE l_orderkey % 20 = 0"
    )


_FLOWS = {"base": _BASE, "flows": _flows()}
_CLEAN = "packets > 0 AND bytes > 0 AND dst_ip <> '255.255.255.255'"
_SILVER = {**_FLOWS, "silver": f"SELECT DISTINCT * FROM flows WHERE {_CLEAN}"}
_FEATURES = (
    "SELECT src_ip, vlan, CAST(sum(packets) AS BIGINT) AS total_packets, CAST(sum(bytes) AS BIGINT) AS total_bytes,"
    " count(DISTINCT dst_ip) AS unique_targets, count(DISTINCT dst_port) AS unique_ports,"
    " round(CAST(sum(bytes) AS DOUBLE) / CAST(sum(packets) AS DOUBLE), 2) AS bytes_per_packet"
    " FROM silver GROUP BY src_ip, vlan"
)
_GOLD = {**_SILVER, "features": _FEATURES}
_LABELLED = (
    "SELECT *, CASE WHEN unique_ports > 10 AND bytes_per_packet < 100 THEN 'ANOMALIA_BOTNET' ELSE 'NORMAL' END"
    " AS comportamento FROM features"
)

# Message fields: the collector's on odd line numbers, the hand-made ones on even, none in bad text.
_ODD = "l_orderkey % 50 <> 0 AND l_linenumber % 2 = 1"
_EVEN = "l_orderkey % 50 <> 0 AND l_linenumber % 2 = 0"
_PARSED = {
    "vlan_of_source": "CAST(NULL AS INT)",
    "vlan_of_target": "CAST(NULL AS INT)",
    "vlan_id": f"CASE WHEN {_ODD} THEN vlan END",
    "manual_vlan": f"CASE WHEN {_EVEN} THEN vlan END",
}
for _name in ("src_ip", "dst_ip", "src_port", "dst_port", "bytes", "packets"):
    _PARSED[f"collector_{_name}"] = f"CASE WHEN {_ODD} THEN {_name} END"
    _PARSED[f"manual_{_name}"] = f"CASE WHEN {_EVEN} THEN {_name} END"
for _, _, _own in FLOW_FIELDS:
    _PARSED.setdefault(_own, f"CASE WHEN {_ODD} THEN {_own} END")
_BASIC = ", ".join(
    f"CASE WHEN {_EVEN} THEN {name} END AS {name}" for name in ("vlan", "src_ip", "dst_ip", "dst_port", "packets", "bytes")
)
_COLLECTOR_ONLY = (
    "flow_type", "time_received", "protocol", "sequence_num", "sampling_rate", "flow_direction", "tcp_flags", "sampler_address",
)


def _bronze(columns: str) -> str:
    listed = [
        f"CASE WHEN l_linenumber % 2 = 1 THEN {name} END AS {name}" if name in _COLLECTOR_ONLY else name
        for name in (part.strip() for part in columns.split(","))
    ]
    return _with(base=_BASE) + f"SELECT {', '.join(listed)} FROM base WHERE l_orderkey % 50 <> 0"


_WIDE = (
    _NARROW + ", sequence_num, sampling_rate, flow_direction, tcp_flags, sampler_address, kafka_partition, kafka_offset"
)
_BRONZE_WIDE = _bronze(_WIDE).replace(" FROM base WHERE", ", base.time_received AS kafka_timestamp FROM base WHERE")
_M = ", ".join(
    f"{text} AS {('c_' if name[0].isupper() else 'm_') + name.lower()}" for name, text in d.MIXED.items()
)
_MIXED = {
    "mixed": f"SELECT l_orderkey, l_linenumber, {_M} FROM lineitem",
    "reconciled": "SELECT l_orderkey, l_linenumber, coalesce(c_srcaddr, m_src_ip) AS src_ip,"
    " coalesce(c_dstaddr, m_dst_ip) AS dst_ip, coalesce(c_srcport, m_src_port) AS src_port,"
    " coalesce(c_dstport, m_dst_port) AS dst_port, coalesce(c_bytes, m_bytes) AS bytes,"
    " coalesce(c_packets, m_packets) AS packets,"
    " CAST(coalesce(m_vlan, c_vlanid, c_srcvlan, c_dstvlan) AS INT) AS vlan FROM mixed",
}
_VLAN_VOLUME = _with(**_FLOWS) + "SELECT vlan, count(*) AS count FROM flows GROUP BY vlan"
_GOLD_LABELLED = _with(**_GOLD) + _LABELLED
_DIRECTION = (
    "CASE WHEN {0} LIKE '172.28.%' THEN CASE WHEN {1} LIKE '172.28.%' THEN 'internal' WHEN {1} IS NOT NULL THEN 'outbound' END"
    " WHEN {0} IS NOT NULL THEN CASE WHEN {1} LIKE '172.28.%' THEN 'inbound' WHEN {1} IS NOT NULL THEN 'external' END END"
)

# --- IDS events ---

_EVE_LIST = ", ".join(f"{text} AS {name}" for name, text in {**d.EVE, **d.EVE_ALERT, **d.EVE_COUNTERS}.items()).replace(
    " AS event_type", " AS eve_type"
)
_TEXT = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+0000'"
_EVE = {
    "eve": f"SELECT event_id, user_id, epoch_us(ts) AS us, ts, {_TEXT} AS eve_time, {_EVE_LIST} FROM events",
}
# The dirty variant: unreadable lines, malformed times, lost source addresses.
_DIRTY = {
    **_EVE,
    "dirty": "SELECT event_id, event_id % 23 = 1 AS cut, CASE WHEN event_id % 31 <> 1 THEN ts END AS ts,"
    " CASE WHEN event_id % 29 <> 1 THEN src_ip END AS src_ip, flow_id, eve_type, dest_ip, src_port, dest_port, proto,"
    " tx_id, gid, signature_id, category,"
    " severity, pkts_toserver, pkts_toclient, bytes_toserver, bytes_toclient,"
    " CASE WHEN event_id % 31 = 1 THEN 'yesterday' ELSE eve_time END AS eve_time FROM eve",
}
_CLOCK = (
    "CAST(hour({0}) AS INT) AS hour, CAST(minute({0}) AS INT) AS minute, CAST(second({0}) AS INT) AS seconds"
)
_CLOCK_ZERO = (
    "CAST(coalesce(hour({0}), 0) AS INT) AS hour, CAST(coalesce(minute({0}), 0) AS INT) AS minute,"
    " CAST(coalesce(second({0}), 0) AS INT) AS seconds"
)
_COUNTERS = ("pkts_toserver", "pkts_toclient", "bytes_toserver", "bytes_toclient")
_ZERO = ", ".join(f"coalesce({name}, 0) AS {name}" for name in ("severity", *_COUNTERS))
_HASHED = (
    "flow_id", "eve_type", "eve_time", "src_ip", "dest_ip", "src_port", "dest_port", "proto", "tx_id", "gid",
    "signature_id", "category", "severity", *_COUNTERS,
)
_HASH = "sha256(" + " || ".join(
    f"coalesce(CAST(length(CAST({name} AS VARCHAR)) AS VARCHAR) || ':' || CAST({name} AS VARCHAR), '-')" for name in _HASHED
) + ")"
_TRAFFIC = (
    f"SELECT {_HASH} AS hash_id, flow_id, src_ip, dest_ip, src_port, dest_port, proto, {_CLOCK_ZERO.format('ts')}, {_ZERO}"
)
_TRAFEGO = {**_EVE, "trafego": f"{_TRAFFIC} FROM eve"}
_PAIRED = {
    **_EVE,
    "pairs": "SELECT * FROM eve UNION ALL SELECT * REPLACE (CAST(1 + (event_id + 1) % 4 AS INT) AS severity,"
    " CAST(2404100 + event_id % 3 AS BIGINT) AS signature_id) FROM eve WHERE eve_type = 'alert'",
    "trafego": f"{_TRAFFIC} FROM pairs",
}
_CLASSIFIED = {
    **_TRAFEGO,
    "classificados": "SELECT *, CASE severity WHEN 1 THEN 'bruteforce' ELSE 'portscan' END AS class,"
    " CAST(CASE severity WHEN 1 THEN 1 ELSE 0 END AS INT) AS processado FROM trafego WHERE severity IN (1, 2)",
}


def _volume(kind: str, name: str, condition: str) -> str:
    value = f"t.{kind}_toserver + t.{kind}_toclient"
    return f"CAST(sum(CASE WHEN {condition} THEN {value} ELSE 0 END) AS BIGINT) AS {name}"


_DASHBOARD = ", ".join(
    [
        _volume("bytes", "volume_bytes_total", "TRUE"),
        _volume("pkts", "volume_pkts_total", "TRUE"),
        _volume("bytes", "bytes_normais", "c.hash_id IS NULL"),
        _volume("bytes", "bytes_anomalos", "c.hash_id IS NOT NULL"),
        _volume("pkts", "pkts_normais", "c.hash_id IS NULL"),
        _volume("pkts", "pkts_anomalos", "c.hash_id IS NOT NULL"),
    ]
)

# --- alerts ---

_ALERTS = {
    **_EVE,
    "alerts": f"SELECT {_HASH} AS alert_id, gid, signature_id AS sig_id, category, severity, src_ip, dest_ip, us AS ts"
    " FROM eve WHERE eve_type = 'alert'",
}


def _limited(address: str, keep: str) -> str:
    period = f"floor(ts / {q.DAY * 1_000_000})"
    ranked = (
        f"SELECT *, row_number() OVER (PARTITION BY sig_id, {address}, {period} ORDER BY ts, alert_id) AS rn FROM alerts"
    )
    return _with(**_ALERTS, ranked=ranked) + f"SELECT alert_id, sig_id, src_ip, dest_ip, ts FROM ranked WHERE {keep}"


# --- catalogues, rules, actions: what each line means, by event id ---

_CLASS_DIM = (
    "SELECT event_id, 'class-' || CAST(event_id AS STRING) AS shortname,"
    " 'Description of class ' || CAST(event_id AS STRING) AS description, CAST(1 + event_id % 4 AS INT) AS priority"
    " FROM events WHERE event_id % 5 < 3"
)
_REFERENCE_DIM = (
    "SELECT 'sys' || CAST(user_id AS STRING) AS system,"
    " 'http://host' || CAST(max(event_id) AS STRING) || '/?id=' AS url FROM events WHERE event_id % 7 <> 6 GROUP BY user_id"
)
_RULES = f"SELECT event_id AS line_no, {d.RULE_LINE} AS line FROM events"
_HAS_LIMIT = "event_id % 5 < 2"
_RULE_REFS = (
    "SELECT event_id, 1 AS ord, 'cve,2024-' || CAST(event_id AS STRING) AS reference FROM events WHERE event_id % 8 = 0"
    " UNION ALL SELECT event_id, 2, 'url,example.org/' || CAST(event_id AS STRING) FROM events WHERE event_id % 8 = 0"
)


def _by_kind(*values: str) -> str:
    """Value for the rule kinds 0, 1, 2, 6 and 7 of the derived rule lines."""
    cases = " ".join(f"WHEN {kind} THEN {value}" for kind, value in zip((0, 1, 2, 6, 7), values))
    return f"CASE event_id % 8 {cases} END"


_PARSED_RULES = (
    "SELECT event_id AS line_no,"
    f" {_by_kind(*[repr(v) for v in ('alert', 'alert', 'alert', 'alert', 'drop')])} AS action,"
    f" {_by_kind(*[repr(v) for v in ('tcp', 'dnp3', 'tcp', 'udp', 'http')])} AS proto,"
    f" {_by_kind(*[repr(v) for v in ('$EXTERNAL_NET', 'any', 'any', '![10.0.0.0/8, 172.28.0.0/16]', 'any')])} AS src,"
    " 'any' AS sport,"
    f" {_by_kind(*[repr(v) for v in ('->', '->', '->', '<>', '->')])} AS direction,"
    f" {_by_kind(*[repr(v) for v in ('172.28.0.0/16', 'any', 'any', 'any', 'any')])} AS dst,"
    f" {_by_kind(*[repr(v) for v in ('22', '20000', 'any', '53', '[80,443]')])} AS dport,"
    " CASE event_id % 8 WHEN 0 THEN 'SSH probe ' || CAST(event_id AS STRING)"
    " WHEN 1 THEN 'control ' || CAST(event_id AS STRING) WHEN 2 THEN 'carries dnp3 here' WHEN 6 THEN 'name lookup'"
    " ELSE 'quoted ' || chr(92) || '\"word' || chr(92) || '\"' || chr(92) || '; end' END AS msg,"
    f" event_id AS sid, CAST({_by_kind('1 + user_id % 9', '1', '2', '3', '4')} AS INT) AS rev,"
    " CASE WHEN event_id % 8 = 0 THEN 'network-scan' END AS classtype,"
    " CASE WHEN event_id % 8 = 0 THEN 'cve,2024-' || CAST(event_id AS STRING) || ' url,example.org/'"
    " || CAST(event_id AS STRING) ELSE '' END AS references"
    " FROM events WHERE event_id % 8 IN (0, 1, 2, 6, 7)"
)
_ACTIONS = {
    "docs": f"SELECT {d.DOC_ID} AS doc_id, string_agg({d.ACTION_ITEM}, ',' ORDER BY event_id) AS items,"
    f" string_agg('\"k' || CAST(event_id AS STRING) || '\":' || {d.ACTION_ITEM}, ',' ORDER BY event_id) AS named"
    " FROM events GROUP BY 1",
    "items": f"SELECT {d.DOC_ID} AS doc_id, {d.ACTION_CODE} AS code,"
    f" CAST(row_number() OVER (PARTITION BY {d.DOC_ID} ORDER BY event_id) - 1 AS INT) AS pos FROM events",
    "good": "SELECT *, CASE code WHEN 0 THEN 'nft add rule x' WHEN 1 THEN 'iptables -A INPUT' WHEN 2 THEN 'killall sshd'"
    " WHEN 3 THEN 'kill -9 1' WHEN 4 THEN '' ELSE 'null' END AS comando,"
    " CASE code WHEN 0 THEN 'nft delete rule x' WHEN 1 THEN 'iptables -D INPUT' WHEN 2 THEN ''"
    " WHEN 3 THEN 'systemctl start x' WHEN 4 THEN 'chmod 600 x' ELSE 'null' END AS desfazer"
    " FROM items WHERE doc_id % 25 <> 0 AND code < 6",
}


def _verdict(codes: str) -> str:
    return f"CASE WHEN code IN ({codes}) THEN 'allowed' ELSE 'denied' END AS verdict"


# --- flow assembly ---

_KEY = "src_ip, dest_ip, src_port, dest_port, proto"
_RECORDS = (
    f"SELECT {d.EVE['src_ip']} AS src_ip, {d.EVE['dest_ip']} AS dest_ip, CAST(1024 + user_id % 60000 AS INT) AS src_port,"
    f" {d.EVE['dest_port']} AS dest_port, {d.EVE['proto']} AS proto, epoch_us(ts) AS us,"
    " 1 + event_id % 40 AS packets, 60 * (1 + event_id % 40) AS bytes FROM events"
)
_FLOW_SUMS = (
    "min(us) AS start_time, max(us) AS end_time, CAST(sum(packets) AS BIGINT) AS packets,"
    " CAST(sum(bytes) AS BIGINT) AS bytes, count(*) AS records"
)


def _islands(idle: int) -> dict[str, str]:
    return {
        "records": _RECORDS,
        "marked": f"SELECT *, CASE WHEN us - lag(us) OVER w <= {idle * 1_000_000} THEN 0 ELSE 1 END AS starts FROM records"
        f" WINDOW w AS (PARTITION BY {_KEY} ORDER BY us)",
        "islands": f"SELECT *, sum(starts) OVER (PARTITION BY {_KEY} ORDER BY us) AS island FROM marked",
    }


_LATE_MS = 3_600_000
_SESSIONS = {
    **_islands(q.SESSION_IDLE),
    "sessions": f"SELECT {_KEY}, {_FLOW_SUMS} FROM islands GROUP BY {_KEY}, island",
}
_WATERMARK_MS = f"(SELECT max(us) // 1000 - {_LATE_MS} FROM records)"

# Greedy cuts: each record points to the one that would open the next flow or period; a recursive walk
# from the first record of a key visits the real openings.
_IDLE_US, _LIFE_US = 4 * q.SESSION_IDLE * 1_000_000, q.FLOW_LIFE * 1_000_000
_LIFE = (
    "WITH RECURSIVE "
    + ", ".join(f"{name} AS ({sql})" for name, sql in _islands(4 * q.SESSION_IDLE).items())
    + f", keyed AS (SELECT *, concat_ws('|', {_KEY}) AS k FROM islands)"
    ", points AS (SELECT k, us, min(island) AS island FROM keyed GROUP BY k, us)"
    ", nexts AS (SELECT k, us, island, min(us) OVER (PARTITION BY k ORDER BY us"
    f" RANGE BETWEEN {_LIFE_US + 1} FOLLOWING AND UNBOUNDED FOLLOWING) AS by_life FROM points)"
    ", island_starts AS (SELECT k, island, min(us) AS us FROM points GROUP BY k, island)"
    ", ptr AS (SELECT n.k, n.us, least(n.by_life, i.us) AS nxt FROM nexts n"
    " LEFT JOIN island_starts i ON i.k = n.k AND i.island = n.island + 1)"
    ", walk AS (SELECT k, min(us) AS us FROM points GROUP BY k UNION ALL"
    " SELECT p.k, p.nxt FROM walk w JOIN ptr p ON p.k = w.k AND p.us = w.us WHERE p.nxt IS NOT NULL)"
    ", opened AS (SELECT r.*, max(w.us) OVER (PARTITION BY r.k ORDER BY r.us) AS opening FROM keyed r"
    " LEFT JOIN walk w ON r.k = w.k AND r.us = w.us)"
    f", flows AS (SELECT k, {_KEY}, opening, {_FLOW_SUMS} FROM opened GROUP BY k, {_KEY}, opening)"
    " SELECT src_ip, dest_ip, src_port, dest_port, proto, start_time, end_time, packets, bytes, records FROM flows"
)
_LIFE_OVER = (
    f" WHERE (least(end_time + {_IDLE_US}, start_time + {_LIFE_US}) + 1000) // 1000 < {_WATERMARK_MS}"
)
_ANCHORED = (
    "WITH RECURSIVE "
    + ", ".join(f"{name} AS ({sql})" for name, sql in _ALERTS.items())
    + ", keyed AS (SELECT *, CAST(sig_id AS STRING) || '|' || src_ip AS k FROM alerts)"
    ", points AS (SELECT DISTINCT k, ts FROM keyed)"
    ", ptr AS (SELECT k, ts, min(ts) OVER (PARTITION BY k ORDER BY ts"
    f" RANGE BETWEEN {q.LIMIT_SECONDS * 1_000_000} FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM points)"
    ", walk AS (SELECT k, min(ts) AS ts FROM points GROUP BY k UNION ALL"
    " SELECT p.k, p.nxt FROM walk w JOIN ptr p ON p.k = w.k AND p.ts = w.ts WHERE p.nxt IS NOT NULL)"
    ", opened AS (SELECT r.*, max(w.ts) OVER (PARTITION BY r.k ORDER BY r.ts) AS opening FROM keyed r"
    " LEFT JOIN walk w ON r.k = w.k AND r.ts = w.ts)"
    ", ranked AS (SELECT *, row_number() OVER (PARTITION BY k, opening ORDER BY ts, alert_id) AS rn FROM opened)"
    f" SELECT sig_id, src_ip, ts, alert_id FROM ranked WHERE rn <= 2"
    f" AND ts // 1000 < (SELECT max(ts) // 1000 - {_LATE_MS} FROM alerts)"
)

ORACLE: dict[str, str] = {
    "parse_flows": _with(base=_BASE) + "SELECT " + ", ".join(f"{sql} AS {own}" for own, sql in _PARSED.items()) + " FROM base",
    "parse_flows_basic": _with(base=_BASE) + f"SELECT {_BASIC} FROM base",
    "reconcile_aliases": _with(**_MIXED) + "SELECT * FROM reconciled",
    "bronze_narrow": _bronze(_NARROW),
    "bronze_wide": _BRONZE_WIDE,
    "bronze_valid": _with(**_MIXED)
    + "SELECT CAST(NULL AS STRING) AS flow_type, CAST(NULL AS BIGINT) AS time_received, src_ip, dst_ip, src_port, dst_port,"
    " CAST(NULL AS INT) AS protocol, bytes, packets, vlan FROM reconciled WHERE src_ip IS NOT NULL",
    "bronze_rejected": _with(base=_BASE)
    + "SELECT 'not json' AS value, CAST(l_suppkey AS STRING) AS kafka_key, time_received AS kafka_timestamp,"
    " kafka_partition, kafka_offset FROM base WHERE l_orderkey % 50 = 0",
    "silver_nonzero": _with(**_FLOWS) + "SELECT * FROM flows WHERE packets > 0 AND bytes > 0",
    "silver_no_broadcast": _with(**_FLOWS) + "SELECT * FROM flows WHERE dst_ip <> '255.255.255.255'",
    "silver": _with(**_SILVER) + "SELECT * FROM silver",
    "silver_by_key": _with(base=_BASE, flows=_flows(60))
    + f"SELECT {_NARROW}, min(ingestion_time) AS ingestion_time FROM flows WHERE {_CLEAN} GROUP BY ALL",
    "silver_by_key_wide": f"SELECT * FROM ({_BRONZE_WIDE}) WHERE {_CLEAN} QUALIFY row_number() OVER (PARTITION BY"
    f" {_WIDE.replace(', kafka_partition, kafka_offset', '')} ORDER BY kafka_timestamp, kafka_partition, kafka_offset) = 1",
    "gold_features": _with(**_GOLD) + "SELECT * FROM features",
    "gold_behaviour": _GOLD_LABELLED,
    "gold_sample": _GOLD_LABELLED + " ORDER BY src_ip, vlan NULLS FIRST LIMIT 10",
    "bronze_total": _with(**_FLOWS) + "SELECT count(*) AS total_records FROM flows",
    "volume_by_vlan": _VLAN_VOLUME,
    "compacted_bronze": _VLAN_VOLUME,
    "latest_flows": _with(**_FLOWS)
    + "SELECT * FROM flows ORDER BY ingestion_time DESC, "
    + ", ".join(f"{name} NULLS LAST" for name in _NARROW.split(", "))
    + " LIMIT 20",
    "flow_event_time": _with(**_FLOWS)
    + "SELECT time_received // 86400 AS event_day, count(*) AS records, max(time_received) AS last_second FROM flows GROUP BY 1",
    "encode_json": _with(**_FLOWS) + f"SELECT src_ip AS key, {_NARROW} FROM flows",
    "medallion_tables": _GOLD_LABELLED,
    "medallion_increment": _GOLD_LABELLED,
    "gold_estimates": _with(**_GOLD)
    + "SELECT src_ip, vlan, total_bytes, unique_targets, unique_ports, TRUE AS targets_hold, TRUE AS ports_hold FROM features",
    "stream_history": "SELECT CAST(4 AS BIGINT) AS batches, CAST(3 AS BIGINT) AS last_batch, count(*) AS input_rows FROM events",
    "flow_direction": _with(**_FLOWS)
    + f"SELECT {_DIRECTION.format('src_ip', 'dst_ip')} AS direction, count(*) AS flows,"
    " CAST(sum(bytes) AS BIGINT) AS bytes FROM flows GROUP BY 1",
    "event_direction": _with(**_EVE) + f"SELECT flow_id, {_DIRECTION.format('src_ip', 'dest_ip')} AS direction FROM eve",
    "flow_direction_lists": _with(
        ends=f"SELECT {d.MIXED_ENDS['a']} AS a, {d.MIXED_ENDS['b']} AS b, l_suppkey % 5 AS s6, l_partkey % 100 AS s6h,"
        " l_partkey % 7 AS v6, l_suppkey % 250 + 1 AS s4, l_suppkey % 2 AS net, l_partkey % 3 AS o FROM lineitem",
        # The home lists written out by hand, for the forms that the ends of a flow take.
        homes="SELECT a, b, CASE WHEN a IS NULL OR a = 'sensor' THEN NULL WHEN v6 = 0 THEN s6 <> 3 OR s6h BETWEEN 40 AND 59"
        " WHEN net = 0 THEN s4 BETWEEN 128 AND 191 ELSE s4 NOT BETWEEN 16 AND 31 END AS ha,"
        " CASE o WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS hb FROM ends",
    )
    + "SELECT CASE WHEN ha AND hb THEN 'internal' WHEN ha AND NOT hb THEN 'outbound' WHEN NOT ha AND hb THEN 'inbound'"
    " WHEN NOT ha AND NOT hb THEN 'external' END AS direction, count(*) AS flows, count(DISTINCT a) AS sources FROM homes GROUP BY 1",
    "http_port_flows": _with(**_FLOWS) + "SELECT * FROM flows WHERE dst_port IN (80, 443)",
    "eve_flatten": _with(**_EVE)
    + "SELECT eve_type AS event_type, eve_time AS timestamp, flow_id, src_ip, dest_ip, src_port, dest_port, proto, us AS ts,"
    f" tx_id, gid, signature_id, category, severity, {', '.join(_COUNTERS)} FROM eve",
    "eve_time_parts": _with(**_DIRTY)
    + "SELECT CASE WHEN NOT cut THEN flow_id END AS flow_id, hour, minute, seconds, event_day FROM (SELECT *,"
    f" {_CLOCK.format('(CASE WHEN NOT cut THEN ts END)')},"
    " CAST(epoch_us(CASE WHEN NOT cut THEN ts END) // 86400000000 AS INT) AS event_day FROM dirty)",
    "eve_fill_zero": _with(**_DIRTY)
    + "SELECT "
    + ", ".join(
        f"CASE WHEN NOT cut THEN {name} END AS {alias}"
        for name, alias in [("eve_type", "event_type"), *[(n, n) for n in ("flow_id", "src_ip", "dest_ip", "proto")]]
    )
    + ", "
    + ", ".join(
        f"CASE WHEN NOT cut THEN coalesce({name}, 0) ELSE 0 END AS {name}"
        for name in ("src_port", "dest_port", "severity", *_COUNTERS)
    )
    + f", {_CLOCK_ZERO.format('(CASE WHEN NOT cut THEN ts END)')} FROM dirty",
    "eve_event_types": _with(**_EVE) + "SELECT eve_type AS event_type, count(*) AS events FROM eve GROUP BY 1",
    "eve_rejected": _with(**_DIRTY)
    + "SELECT CASE WHEN cut THEN '{cut ' || CAST(event_id AS STRING) END AS _corrupt_record,"
    " CASE WHEN NOT cut THEN flow_id END AS flow_id FROM dirty WHERE cut OR src_ip IS NULL",
    "alerts_only": _with(**_EVE)
    + "SELECT flow_id, src_ip, dest_ip, severity, gid, signature_id, category FROM eve WHERE eve_type = 'alert'",
    "trafego": _with(**_TRAFEGO) + "SELECT * EXCLUDE (hash_id) FROM trafego",
    "trafego_from_log": _with(**_TRAFEGO) + "SELECT * EXCLUDE (hash_id) FROM trafego",
    "trafego_hash_id": _with(**_TRAFEGO) + "SELECT flow_id, hash_id FROM trafego",
    "trafego_unique": _with(**_PAIRED) + "SELECT * FROM trafego",
    "growing_log": _with(**_PAIRED) + "SELECT * FROM trafego",
    "classified_default": _with(**_CLASSIFIED) + "SELECT * FROM classificados",
    "classified_pending": _with(**_CLASSIFIED) + "SELECT * FROM classificados WHERE processado = 0",
    "traffic_dashboard": _with(**_CLASSIFIED)
    + f"SELECT t.hour, t.minute, {_DASHBOARD} FROM trafego t LEFT JOIN classificados c ON t.hash_id = c.hash_id"
    " GROUP BY t.hour, t.minute",
    "traffic_normal": _with(**_CLASSIFIED) + "SELECT * FROM trafego WHERE hash_id NOT IN (SELECT hash_id FROM classificados)",
    "traffic_anomalous": _with(**_CLASSIFIED) + "SELECT * FROM trafego WHERE hash_id IN (SELECT hash_id FROM classificados)",
    "alert_classification": _with(
        **_ALERTS,
        named="SELECT 'k' || CAST(user_id % 97 AS STRING) AS shortname, max(event_id) AS event_id FROM events GROUP BY 1",
        last=f"SELECT CASE event_id % 3 WHEN 0 THEN '{d.CATEGORIES[0]}' ELSE '{d.CATEGORIES[1]}' END AS category,"
        " max(event_id) AS event_id FROM named WHERE event_id % 3 < 2 GROUP BY 1",
    )
    + "SELECT alert_id, a.category, shortname, CAST(1 + n.event_id % 4 AS INT) AS priority"
    " FROM alerts a LEFT JOIN last l ON l.category = a.category LEFT JOIN named n ON n.event_id = l.event_id",
    "alerts_suppressed": _with(
        **_ALERTS,
        away="SELECT DISTINCT '203.0.113.' || CAST(event_id % 50 AS STRING) AS ip FROM events WHERE event_id % 6 = 3",
        here="SELECT DISTINCT '172.28.2.' || CAST(event_id % 9 AS STRING) AS ip FROM events WHERE event_id % 6 = 4",
    )
    + "SELECT alert_id, sig_id, src_ip, dest_ip FROM alerts"
    " WHERE NOT (gid = 1 AND sig_id = 2404001 AND src_ip LIKE '172.28.1.%')"
    " AND NOT (gid = 3 AND sig_id = 2404000 AND dest_ip = '172.28.0.10')"
    " AND NOT (sig_id = 2404002 AND (src_ip = '172.28.0.7' OR (src_ip LIKE '172.28.2.%' AND CAST(split_part(src_ip, '.', 4) AS INT) < 128)))"
    " AND NOT (gid = 3 AND dest_ip IN (SELECT ip FROM away)) AND src_ip NOT IN (SELECT ip FROM here)",
    "alerts_limited_by_catalogue": _with(
        **_ALERTS,
        ruled="SELECT *, CASE WHEN gid = 1 AND sig_id = 2404000 THEN 'a' WHEN gid = 1 AND sig_id = 2404001 THEN 'b'"
        " WHEN gid = 3 THEN 'c' ELSE 'd' END AS rule FROM alerts",
        ranked="SELECT *, row_number() OVER (PARTITION BY gid, sig_id,"
        " CASE WHEN rule IN ('a', 'd') THEN src_ip ELSE dest_ip END,"
        " ts // (CASE rule WHEN 'b' THEN 3600000000 WHEN 'd' THEN 600000000 ELSE 86400000000 END) ORDER BY ts, alert_id) AS rn FROM ruled",
    )
    + "SELECT alert_id, gid, sig_id FROM ranked WHERE CASE rule WHEN 'a' THEN rn <= 2 WHEN 'b' THEN rn % 3 = 0"
    " WHEN 'c' THEN rn = 2 ELSE rn <= 1 END",
    "alerts_limit": _limited("src_ip", "rn <= 1"),
    "alerts_threshold": _limited("dest_ip", "rn % 3 = 0"),
    "alerts_both": _limited("dest_ip", "rn = 2"),
    "classification_dim": f"SELECT shortname, description, priority FROM ({_CLASS_DIM})",
    "reference_dim": _REFERENCE_DIM,
    "threshold_dim": "SELECT event_id AS line_no, CASE event_id % 5 WHEN 0 THEN 'threshold' WHEN 1 THEN 'event_filter'"
    " ELSE 'suppress' END AS kind, CAST(1 AS BIGINT) AS gen_id, CAST(2404000 + event_id AS BIGINT) AS sig_id,"
    f" CASE WHEN {_HAS_LIMIT} THEN CASE event_id % 3 WHEN 0 THEN 'limit' WHEN 1 THEN 'threshold' ELSE 'both' END END AS type,"
    f" CASE WHEN event_id % 5 = 3 OR ({_HAS_LIMIT} AND event_id % 2 = 0) THEN 'by_src' WHEN {_HAS_LIMIT} THEN 'by_dst' END AS track,"
    f" CAST(CASE WHEN {_HAS_LIMIT} THEN 1 + event_id % 10 END AS INT) AS count,"
    f" CAST(CASE WHEN {_HAS_LIMIT} THEN 10 * (1 + user_id % 6) END AS INT) AS seconds,"
    " CASE WHEN event_id % 5 = 3 THEN '172.28.' || CAST(user_id % 3 AS STRING) || '.0/24' END AS ip"
    " FROM events WHERE event_id % 5 <> 4",
    "reference_urls": _with(dim=_REFERENCE_DIM)
    + "SELECT event_id, 'SYS' || CAST(user_id + event_id % 2 * 100000000 AS STRING) || ',' || CAST(event_id AS STRING) AS reference,"
    " url || CAST(event_id AS STRING) AS reference_url FROM events"
    " LEFT JOIN dim ON event_id % 2 = 0 AND system = 'sys' || CAST(user_id AS STRING)",
    "rules_parsed": _PARSED_RULES,
    "rules_unparsed": f"SELECT line_no, replace(line, ' -> ', ' ') AS line FROM ({_RULES}) WHERE line_no % 16 = 2",
    "rule_reference_rows": f"SELECT event_id AS sid, reference FROM ({_RULE_REFS})",
    "rules_pruned": f"SELECT * FROM ({_RULES}) WHERE line_no % 8 NOT IN (1, 2, 4)",
    "rules_disabled": "SELECT line_no, CASE WHEN line_no % 8 = 1 THEN '#' || line ELSE line END AS line"
    f" FROM ({_RULES})",
    "rule_files_dup": "SELECT 'emerging-' || CAST(user_id AS STRING) || '.rules' AS name, count(*) AS copies FROM events"
    " WHERE event_id % 50 > 1 GROUP BY user_id",
    "catalogue_diff": _with(
        old=_CLASS_DIM,
        changed="SELECT event_id, shortname, description, CAST(CASE WHEN event_id % 10 = 0 THEN 9 ELSE priority END AS INT)"
        " AS priority FROM old",
        new="SELECT * FROM changed WHERE event_id % 11 <> 0 UNION ALL SELECT * FROM changed WHERE event_id % 13 = 0",
        o="SELECT shortname, description, priority FROM old",
        n="SELECT shortname, description, priority FROM new",
    )
    + "SELECT *, 'removed' AS change, count(*) AS copies FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM n) GROUP BY ALL"
    " UNION ALL SELECT *, 'added' AS change, count(*) AS copies FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM o) GROUP BY ALL",
    "actions_valid_docs": _with(**_ACTIONS) + "SELECT doc_id, CASE WHEN doc_id % 25 = 1"
    " THEN '{' || named || '}' ELSE '[' || items || ']' END AS body FROM docs WHERE doc_id % 25 <> 0",
    "actions_odd_items": _with(**_ACTIONS)
    + "SELECT doc_id, pos, CASE code WHEN 6 THEN 'x' ELSE '17' END AS text FROM items WHERE doc_id % 25 <> 0 AND code > 5",
    "actions_exploded": _with(**_ACTIONS) + "SELECT doc_id, pos, comando, desfazer FROM good",
    "actions_undo": _with(**_ACTIONS) + f"SELECT doc_id, pos, desfazer, {_verdict('1, 4')} FROM good WHERE desfazer <> ''",
    "action_verdict_prefix": _with(**_ACTIONS)
    + f"SELECT doc_id, pos, comando, {_verdict('1, 2, 3')} FROM good WHERE comando <> ''",
    "action_verdict_word": _with(**_ACTIONS)
    + f"SELECT doc_id, pos, comando, {_verdict('0, 1, 3')} FROM good WHERE comando <> ''",
    "actions_strict_prefix": _with(
        **_ACTIONS, first="SELECT doc_id, min(pos) AS stop FROM good WHERE code IN (2, 5) GROUP BY doc_id"
    )
    + "SELECT g.doc_id, pos, comando FROM good g LEFT JOIN first f ON f.doc_id = g.doc_id"
    " WHERE comando <> '' AND (stop IS NULL OR pos < stop)",
    "flow_sessions": _with(**_SESSIONS) + "SELECT * FROM sessions",
    "bronze_stream": _bronze(_NARROW),
    "eve_ingest_stream": _with(**_DIRTY)
    + f"{_TRAFFIC} FROM dirty WHERE NOT cut AND src_ip IS NOT NULL",
    "fan_out_stream": _with(base=_BASE, sinks="SELECT unnest(['lake', 'messages']) AS sink")
    + "SELECT sink, src_ip, count(*) AS messages FROM base, sinks WHERE l_orderkey % 50 <> 0 GROUP BY 1, 2",
    "dedupe_flow_stream": _with(base=_BASE) + f"SELECT DISTINCT {_NARROW.replace('flow_type, ', '')} FROM base",
    "flow_session_stream": _with(**_SESSIONS)
    + f"SELECT * FROM sessions WHERE end_time + {q.SESSION_IDLE * 1_000_000} <= {_WATERMARK_MS} * 1000",
    "flow_life_stream": _LIFE + _LIFE_OVER,
    "flow_life": _LIFE,
    "rate_limit_stream": _ANCHORED,
}
