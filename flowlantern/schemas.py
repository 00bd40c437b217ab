"""Record layouts. The names and types below are fixed by the producers and the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

_STR, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Flow message fields as the collector and the hand-made messages spell them, with
# the name used after parsing. Two pairs differ in case only, hence the own names.
FLOW_FIELDS = [
    ("Type", _STR, "flow_type"),
    ("TimeReceived", _LONG, "time_received"),
    ("SequenceNum", _LONG, "sequence_num"),
    ("SamplingRate", _INT, "sampling_rate"),
    ("FlowDirection", _INT, "flow_direction"),
    ("Bytes", _LONG, "collector_bytes"),
    ("Packets", _LONG, "collector_packets"),
    ("bytes", _LONG, "manual_bytes"),
    ("packets", _LONG, "manual_packets"),
    ("SrcAddr", _STR, "collector_src_ip"),
    ("DstAddr", _STR, "collector_dst_ip"),
    ("src_ip", _STR, "manual_src_ip"),
    ("dst_ip", _STR, "manual_dst_ip"),
    ("SrcPort", _INT, "collector_src_port"),
    ("DstPort", _INT, "collector_dst_port"),
    ("src_port", _INT, "manual_src_port"),
    ("dst_port", _INT, "manual_dst_port"),
    ("Proto", _INT, "protocol"),
    ("TcpFlags", _INT, "tcp_flags"),
    ("SrcVlan", _INT, "vlan_of_source"),
    ("DstVlan", _INT, "vlan_of_target"),
    ("VlanId", _INT, "vlan_id"),
    ("vlan", _INT, "manual_vlan"),
    ("SamplerAddress", _STR, "sampler_address"),
]
FLOW_JSON = _struct(*[(name, kind) for name, kind, _ in FLOW_FIELDS])
FLOW_PARSED = _struct(*[(own, kind) for _, kind, own in FLOW_FIELDS])

# The first non-null candidate wins. Addresses, ports and counters prefer the
# collector's name; the VLAN prefers the hand-made one.
FLOW_ALIASES = {
    "src_ip": ["collector_src_ip", "manual_src_ip"],
    "dst_ip": ["collector_dst_ip", "manual_dst_ip"],
    "src_port": ["collector_src_port", "manual_src_port"],
    "dst_port": ["collector_dst_port", "manual_dst_port"],
    "bytes": ["collector_bytes", "manual_bytes"],
    "packets": ["collector_packets", "manual_packets"],
    "vlan": ["manual_vlan", "vlan_id", "vlan_of_source", "vlan_of_target"],
}

# Six-field messages; counters are widened to LONG so that both parsers feed one table.
FLOW_BASIC_JSON = _struct(
    ("vlan", _INT), ("src_ip", _STR), ("dst_ip", _STR), ("dst_port", _INT), ("packets", _LONG), ("bytes", _LONG)
)

BRONZE_NARROW = [
    "flow_type", "time_received", "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "bytes", "packets", "vlan",
]
BRONZE_WIDE = [
    "flow_type", "time_received", "sequence_num", "sampling_rate", "flow_direction", "src_ip", "dst_ip", "src_port",
    "dst_port", "protocol", "tcp_flags", "bytes", "packets", "vlan", "sampler_address", "kafka_timestamp",
    "kafka_partition", "kafka_offset",
]
# Columns that describe the delivery of a message and not the flow in it.
DELIVERY_COLUMNS = ["ingestion_time", "kafka_timestamp", "kafka_partition", "kafka_offset"]

# IDS event. The four counters are LONG because a flow may exceed 2 GiB.
EVE_JSON = _struct(
    ("timestamp", _STR),
    ("event_type", _STR),
    ("flow_id", _STR),
    ("src_ip", _STR),
    ("src_port", _INT),
    ("dest_ip", _STR),
    ("dest_port", _INT),
    ("proto", _STR),
    ("tx_id", _LONG),
    ("alert", _struct(("severity", _INT), ("gid", _LONG), ("signature_id", _LONG), ("category", _STR))),
    (
        "flow",
        _struct(
            ("pkts_toserver", _LONG), ("pkts_toclient", _LONG), ("bytes_toserver", _LONG), ("bytes_toclient", _LONG)
        ),
    ),
)
EVE_FILE = T.StructType([*EVE_JSON.fields, T.StructField("_corrupt_record", _STR, True)])

TRAFFIC_COUNTERS = ["pkts_toserver", "pkts_toclient", "bytes_toserver", "bytes_toclient"]
TRAFFIC_COLUMNS = [
    "flow_id", "src_ip", "dest_ip", "src_port", "dest_port", "proto", "hour", "minute", "seconds", "severity",
    *TRAFFIC_COUNTERS,
]

ACTION_JSON = _struct(("comando", _STR), ("desfazer", _STR))
