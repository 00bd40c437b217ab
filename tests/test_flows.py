"""Golden rows and edge cases of the flow path."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, plan, rows
from flowlantern.operators import flows
from flowlantern.plans import medallion, queries
from flowlantern.sources import readers, writers

TWO_MESSAGES = [
    '{"vlan": 7, "src_ip": "10.7.0.15", "dst_ip": "10.7.0.1", "dst_port": 8443, "packets": 20, "bytes": 1700}',
    '{"vlan": 8, "src_ip": "10.8.0.23", "dst_ip": "10.9.0.4", "dst_port": 25, "packets": 3, "bytes": 1000}',
]
TWO_GOLD = [
    ("10.7.0.15", 7, 20, 1700, 1, 1, 85.0, "NORMAL"),
    ("10.8.0.23", 8, 3, 1000, 1, 1, 333.33, "NORMAL"),
]


def messages(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def test_two_messages_to_gold(spark):
    bronze = flows.bronze_flows(messages(spark, *TWO_MESSAGES))
    silver = flows.clean_flows(bronze)
    assert (bronze.count(), silver.count()) == (2, 2)
    assert rows(flows.label_behaviour(flows.gold_features(silver))) == TWO_GOLD


@pytest.mark.parametrize(
    ("text", "column", "value"),
    [
        ('{"SrcAddr":"a","src_ip":"b"}', "src_ip", "a"),
        ('{"src_ip":"a","vlan":0,"VlanId":9}', "vlan", 0),
        ('{"src_ip":"a","VlanId":9,"SrcVlan":5}', "vlan", 9),
        ('{"src_ip":"a","SrcVlan":5,"DstVlan":6}', "vlan", 5),
        ('{"src_ip":"a","DstVlan":6}', "vlan", 6),
        ('{"src_ip":"a","Bytes":1,"bytes":2}', "bytes", 1),
        ('{"src_ip":"a","bytes":2}', "bytes", 2),
        ('{"src_ip":"a","bytes":1.5}', "bytes", None),
        ('{"src_ip":"a","bytes":"9"}', "bytes", None),
        ('{"src_ip":"a","bytes":5000000000}', "bytes", 5_000_000_000),
    ],
)
def test_field_precedence_and_types(spark, text, column, value):
    assert rows(flows.bronze_flows(messages(spark, text)), column) == [(value,)]


def test_unreadable_messages_are_rejected_and_kept(spark):
    texts = ["{}", "not json", '{"dst_ip":"x"}', '{"src_ip":"a"}', None]
    assert flows.bronze_flows(messages(spark, *texts)).count() == 1
    assert flows.rejected_flows(messages(spark, *texts)).count() == 4
    # The six-field variant has no filter.
    assert flows.parse_flows_basic(messages(spark, *texts)).count() == 5


def test_text_is_parsed_once(spark):
    assert plan(flows.bronze_flows(messages(spark, "{}"))).count("from_json") == 1


def test_third_name_set_is_one_more_alias(spark):
    table = spark.createDataFrame([(None, "b"), ("a", "c")], "first string, second string")
    assert rows(flows.reconcile(table, {"out": ["first", "second"]})) == [("a",), ("b",)]


BRONZE = "src_ip string, dst_ip string, dst_port int, bytes long, packets long, vlan int, ingestion_time timestamp"
T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def test_silver_edges(spark):
    bad = [
        ("s", "d", 1, 10, 0, 1, T0),
        ("s", "d", 1, 0, 5, 1, T0),
        ("s", "d", 1, 10, None, 1, T0),
        ("s", None, 1, 10, 5, 1, T0),
        ("s", "255.255.255.255", 1, 10, 5, 1, T0),
    ]
    copies = [("s", "d", 1, 10, 5, 1, T0), ("s", "d", 1, 10, 5, 1, T0), ("s", "d", 1, 10, 5, 1, T1)]
    table = spark.createDataFrame(bad + copies, BRONZE)
    assert flows.clean_flows(table).count() == 2
    by_key = flows.clean_flows(table, dedupe="key")
    assert rows(by_key, "ingestion_time") == [(T0,)]
    assert by_key.columns == table.columns
    with pytest.raises(ValueError):
        flows.clean_flows(table, dedupe="other")


def test_key_mode_keeps_the_delivery_of_one_message(spark):
    table = spark.createDataFrame(
        [("s", "d", 1, 1, T1, 0, 9), ("s", "d", 1, 1, T0, 2, 5), ("s", "d", 1, 1, T0, 1, 7)],
        "src_ip string, dst_ip string, bytes long, packets long, ingestion_time timestamp, kafka_partition int, kafka_offset long",
    )
    assert rows(flows.clean_flows(table, "key"), "kafka_partition", "kafka_offset") == [(1, 7)]


def test_silver_is_idempotent_and_gold_keeps_the_totals(spark):
    bronze = queries._bronze(spark, SF_DIR)
    silver = flows.clean_flows(bronze)
    assert flows.clean_flows(silver).count() == silver.count()
    wanted = silver.agg(F.sum("bytes"), F.sum("packets")).first()
    found = flows.gold_features(silver).agg(F.sum("total_bytes"), F.sum("total_packets")).first()
    assert tuple(found) == tuple(wanted)


def scan(ports, total_bytes, packets):
    """One source with ``ports`` target ports and the given totals."""
    first = ("s", "d", 0, total_bytes - (ports - 1), packets - (ports - 1), 1, T0)
    return [first] + [("s", "d", port, 1, 1, 1, T0) for port in range(1, ports)]


@pytest.mark.parametrize(
    ("ports", "total_bytes", "packets", "label"),
    [
        (10, 5000, 100, "NORMAL"),
        (11, 9999, 100, "ANOMALIA_BOTNET"),
        (11, 10000, 100, "NORMAL"),
        (11, 99996, 1000, "NORMAL"),  # 99.996 is rounded to 100.0 first
        (11, 99994, 1000, "ANOMALIA_BOTNET"),
    ],
)
def test_label_bounds_are_strict(spark, ports, total_bytes, packets, label):
    gold = flows.label_behaviour(flows.gold_features(spark.createDataFrame(scan(ports, total_bytes, packets), BRONZE)))
    assert rows(gold, "unique_ports", "comportamento") == [(ports, label)]


def test_gold_groups_null_vlan_apart_and_survives_zero_packets(spark):
    table = spark.createDataFrame(
        [("s", "d", 1, 10, 0, None, T0), ("s", "d", 2, 10, 5, 7, T0), ("s", None, None, 10, 5, 7, T0)], BRONZE
    )
    features = flows.label_behaviour(flows.gold_features(table))
    found = rows(features, "vlan", "unique_targets", "unique_ports", "bytes_per_packet", "comportamento")
    assert found == [(7, 1, 1, 2.0, "NORMAL"), (None, 1, 1, None, "NORMAL")]


def test_approximate_distinct_is_close(spark):
    silver = queries._silver(spark, SF_DIR)
    both = flows.gold_features(silver).alias("e").join(flows.gold_features(silver, approx=True).alias("a"), "src_ip")
    far = both.filter(F.col("e.vlan").eqNullSafe(F.col("a.vlan"))).filter(
        F.abs(F.col("e.unique_ports") - F.col("a.unique_ports")) > 0.1 * F.col("e.unique_ports") + 1
    )
    assert far.count() == 0


def test_hot_source_is_spread_before_it_is_counted(spark):
    text = plan(flows.gold_features(spark.createDataFrame(scan(3, 10, 10), BRONZE)))
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 2
    assert "dst_ip" in shuffles[1] and "dst_port" in shuffles[1]
    assert "partial_" in text


def test_one_pass_over_stored_tables(spark, tmp_path):
    bronze = queries._bronze(spark, SF_DIR)
    writers.write_table(bronze, f"{tmp_path}/bronze", ["vlan"])
    gold = medallion.refine(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/gold")
    assert rows(gold) == rows(flows.label_behaviour(flows.gold_features(flows.clean_flows(bronze))))
    stored = readers.read_table(spark, f"{tmp_path}/bronze")
    assert stored.filter("vlan is null").count() == bronze.filter("vlan is null").count() > 0
    text = plan(flows.gold_features(flows.nonzero_flows(stored).filter("vlan = 30")))
    assert "PartitionFilters: [isnotnull(vlan" in text
    assert "GreaterThan(packets,0)" in text
    # Six columns are needed, the VLAN is a folder name.
    assert "ReadSchema: struct<src_ip:string,dst_ip:string,dst_port:int,bytes:bigint,packets:bigint>" in text


def test_dynamic_overwrite_leaves_other_partitions(spark, tmp_path):
    path = f"{tmp_path}/table"
    writers.write_table(spark.createDataFrame([(1, 30), (2, 40)], "a int, vlan int"), path, ["vlan"])
    writers.write_table(spark.createDataFrame([(3, 40)], "a int, vlan int"), path, ["vlan"], dynamic=True)
    assert rows(spark.read.parquet(path), "a", "vlan") == [(1, 30), (3, 40)]


def test_compact_makes_few_files(spark, tmp_path):
    source, target = f"{tmp_path}/many", f"{tmp_path}/few"
    spark.range(400).selectExpr("id", "id % 2 AS vlan").repartition(40).write.partitionBy("vlan").parquet(source)
    writers.compact(spark, source, target)
    stored = spark.read.parquet(target)
    assert len(stored.inputFiles()) <= 4 < len(spark.read.parquet(source).inputFiles())
    assert rows(stored) == rows(spark.read.parquet(source))
    with pytest.raises(ValueError):
        writers.compact(spark, source, source + "/")


def test_encode_json_round_trip(spark):
    table = spark.createDataFrame([("a", 1, None), ("b", None, 2.5)], "k string, n int, x double")
    encoded = writers.encode_json(table, "k")
    assert [json.loads(text) for _, text in rows(encoded)] == [{"k": "a", "n": 1}, {"k": "b", "x": 2.5}]


def test_latest_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(flows.latest(queries._bronze(spark, SF_DIR)))


def test_smoke_alerts_round_trip(spark, tmp_path):
    alerts = readers.alerts_smoke(spark)
    writers.write_table(alerts, f"{tmp_path}/alerts")
    assert rows(readers.read_table(spark, f"{tmp_path}/alerts")) == rows(alerts)
    assert alerts.columns == ["origem_vlan", "ip_origem", "evento", "severidade"] and alerts.count() == 2
