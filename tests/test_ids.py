"""Golden rows and edge cases of the IDS path."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, plan, rows
from flowlantern.functions.measures import row_hash
from flowlantern.operators import ids
from flowlantern.plans import queries
from flowlantern.schemas import TRAFFIC_COLUMNS
from flowlantern.sources import readers, writers


def event(**fields):
    base = {
        "timestamp": "2025-04-28T12:50:07.123456+0000",
        "event_type": "flow",
        "flow_id": 17,
        "src_ip": "10.0.0.1",
        "src_port": 1,
        "dest_ip": "10.0.0.2",
        "dest_port": 2,
        "proto": "TCP",
        "flow": {"pkts_toserver": 1, "pkts_toclient": 2, "bytes_toserver": 3, "bytes_toclient": 4},
    }
    base.update(fields)
    return json.dumps({key: value for key, value in base.items() if value is not None})


def log(tmp_path, *lines):
    path = tmp_path / "eve.json"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_log_without_alerts_has_severity_zero(spark, tmp_path):
    traffic = ids.to_trafego(readers.read_eve(spark, log(tmp_path, event(), event(flow_id=18))))
    assert rows(traffic, "flow_id", "severity") == [("17", 0), ("18", 0)]


def test_stored_layout(spark, tmp_path):
    events = readers.read_eve(spark, log(tmp_path, event()))
    assert ids.to_trafego(events, key=False).columns == TRAFFIC_COLUMNS
    assert rows(ids.to_trafego(events, key=False)) == [("17", "10.0.0.1", "10.0.0.2", 1, 2, "TCP", 12, 50, 7, 0, 1, 2, 3, 4)]


@pytest.mark.parametrize(
    ("text", "clock"),
    [
        ("2025-04-28T12:50:07.123456-0300", (15, 50, 7)),
        ("2025-04-28T23:59:59.999999+0000", (23, 59, 59)),
        ("1969-12-31T23:00:01.500000+0000", (23, 0, 1)),
        ("soon", (0, 0, 0)),
    ],
)
def test_clock_is_utc(spark, tmp_path, text, clock):
    traffic = ids.to_trafego(readers.read_eve(spark, log(tmp_path, event(timestamp=text))))
    assert rows(traffic, "hour", "minute", "seconds") == [clock]


def test_event_date_travels_with_the_row(spark, tmp_path):
    late = event(timestamp="2025-04-28T23:30:00.000000-0300")
    assert rows(ids.to_trafego(readers.read_eve(spark, log(tmp_path, late))), "event_date") == [(dt.date(2025, 4, 29),)]


def test_bad_lines_go_to_the_rejected_table(spark, tmp_path):
    lines = [event(), "{broken", event(src_ip=None), event(proto=None), event(timestamp="soon")]
    for events in (
        readers.read_eve(spark, log(tmp_path, *lines)).cache(),
        ids.parse_eve(spark.createDataFrame([(line,) for line in lines], "value string")),
    ):
        assert ids.to_trafego(events).count() == 2
        rejected = ids.rejected_events(events)
        assert rejected.count() == 3
        assert [row[0] for row in rejected.select("_corrupt_record").collect() if row[0]] == ["{broken"]


def test_numbers_are_filled_and_texts_are_not(spark, tmp_path):
    events = readers.read_eve(spark, log(tmp_path, event(src_port=None, flow=None, flow_id=None)))
    filled = ids.fill_zero(ids.with_time_parts(ids.flatten_eve(events)))
    assert rows(filled, "src_port", "severity", "bytes_toclient", "flow_id") == [(0, 0, 0, None)]


def test_big_counters_survive(spark, tmp_path):
    big = {"pkts_toserver": 1, "pkts_toclient": 1, "bytes_toserver": 3_000_000_000, "bytes_toclient": 3_000_000_000}
    traffic = ids.to_trafego(readers.read_eve(spark, log(tmp_path, event(flow=big))))
    dash = ids.traffic_dashboard(traffic, traffic.limit(0))
    assert rows(dash, "volume_bytes_total") == [(6_000_000_000,)]


def test_hash_tells_events_of_one_flow_apart(spark, tmp_path):
    lines = [event(), event(event_type="dns"), event(timestamp="2025-04-28T12:50:08.123456+0000"), event(), event(src_port=None)]
    traffic = ids.to_trafego(readers.read_eve(spark, log(tmp_path, *lines)))
    assert traffic.select("hash_id").distinct().count() == 4
    assert ids.dedupe_trafego(traffic).count() == 4
    assert {len(row[0]) for row in traffic.select("hash_id").collect()} == {64}


def test_hash_is_taken_from_one_reading_only(spark):
    parts = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("", "c"), ("-", "c"), ("c", None), ("1:c", ""), ("", "1:c"), ("é🙂", "2:")]
    found = spark.createDataFrame(parts, "a string, b string").select(row_hash("a", "b")).distinct().count()
    assert found == len(parts)


def test_two_alerts_of_one_packet_stay_apart(spark, tmp_path):
    grave = {"severity": 1, "signature_id": 100, "gid": 1, "category": "c"}
    lines = [event(alert=grave), event(alert={**grave, "severity": 3, "signature_id": 200}), event(alert=grave)]
    traffic = ids.dedupe_trafego(ids.to_trafego(readers.read_eve(spark, log(tmp_path, *lines))))
    assert sorted(row[0] for row in traffic.select("severity").collect()) == [1, 3]
    assert traffic.select("hash_id").distinct().count() == 2
    text = plan(ids.dedupe_trafego(queries._trafego(spark, SF_DIR)))
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_dashboard_adds_up_and_ignores_double_classification(spark):
    traffic, classified = queries._trafego(spark, SF_DIR), queries._classificados(spark, SF_DIR)
    once = ids.traffic_dashboard(traffic, classified)
    assert rows(ids.traffic_dashboard(traffic, classified.unionByName(classified))) == rows(once)
    assert once.filter("bytes_normais + bytes_anomalos <> volume_bytes_total").count() == 0
    assert once.filter("pkts_normais + pkts_anomalos <> volume_pkts_total").count() == 0
    normal, anomalous = ids.split_traffic(traffic, classified)
    assert normal.count() + anomalous.count() == traffic.count()
    assert anomalous.count() == classified.count()


def test_dashboard_join_by_shuffle_gives_the_same(spark):
    traffic, classified = queries._trafego(spark, SF_DIR), queries._classificados(spark, SF_DIR)
    wanted = rows(ids.traffic_dashboard(traffic, classified))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = ids.traffic_dashboard(traffic, classified)
        assert "SortMergeJoin" in plan(shuffled)
        assert rows(shuffled) == wanted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_bucketed_tables_join_without_a_shuffle_on_the_key(spark, tmp_path):
    writers.write_bucketed(queries._trafego(spark, SF_DIR), "trafego_b", "hash_id", 4, f"{tmp_path}/t")
    writers.write_bucketed(queries._classificados(spark, SF_DIR), "classificados_b", "hash_id", 4, f"{tmp_path}/c")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dash = ids.traffic_dashboard(spark.table("trafego_b"), spark.table("classificados_b"))
        shuffles = [line for line in plan(dash).splitlines() if "Exchange hashpartitioning" in line]
        assert len(shuffles) == 1 and "hash_id" not in shuffles[0]
        assert rows(dash) == rows(queries.traffic_dashboard(spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_default_of_processado(spark):
    table = spark.createDataFrame([(1, None), (2, 1)], "id int, processado int")
    assert rows(ids.to_classificados(table)) == [(1, 0), (2, 1)]
    assert rows(ids.to_classificados(table.select("id")), "processado") == [(0,), (0,)]
    assert rows(ids.pending(ids.to_classificados(table)), "id") == [(1,)]
