"""Streams give the rows of the batch functions, also after a restart and with split input."""

import datetime as dt
import json
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_DIR, plan, rows
from flowlantern.operators import flows, ids, sessions
from flowlantern.plans import queries
from flowlantern.schemas import EVE_FILE
from flowlantern.sources import derived, readers
from flowlantern.streaming import jobs, stateful
from test_flows import TWO_GOLD, TWO_MESSAGES
from test_ids import event

MESSAGES = "key binary, value binary, timestamp timestamp, partition int, offset long"
T0 = dt.datetime(2024, 1, 1)


def write_messages(spark, path, texts, offset=0):
    table = [(None, text.encode(), T0, 0, offset + i) for i, text in enumerate(texts)]
    spark.createDataFrame(table, MESSAGES).coalesce(1).write.mode("append").parquet(path)


def message_stream(spark, path, max_files=None):
    reader = spark.readStream.schema(MESSAGES)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


def test_two_messages_through_the_stream(spark, tmp_path):
    write_messages(spark, f"{tmp_path}/in", TWO_MESSAGES)
    query = jobs.finish(jobs.run_bronze(message_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/check"))
    report = jobs.progress(query)
    assert report["is_active"] is False and report["num_input_rows"] == 2
    json.dumps(report)
    assert [entry["num_input_rows"] for entry in jobs.recent_progress(query)][:1] == [2]
    bronze = readers.read_table(spark, f"{tmp_path}/out")
    assert rows(flows.label_behaviour(flows.gold_features(flows.clean_flows(bronze)))) == TWO_GOLD


def test_restart_continues_after_the_last_file(spark, tmp_path):
    source, out, check = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/check"
    write_messages(spark, source, TWO_MESSAGES)
    jobs.finish(jobs.run_bronze(message_stream(spark, source), out, check, "wide"))
    write_messages(spark, source, [*TWO_MESSAGES, "not json"], offset=2)
    jobs.finish(jobs.run_bronze(message_stream(spark, source), out, check, "wide"))
    jobs.finish(jobs.run_bronze(message_stream(spark, source), out, check, "wide"))
    bronze = readers.read_table(spark, out)
    assert rows(bronze, "kafka_offset") == [(0,), (1,), (2,), (3,)]
    # The replay survives the row mode, as it arrived at another time, but not the key mode.
    assert flows.clean_flows(bronze).count() == 4
    assert flows.clean_flows(bronze, "key").count() == 2


def test_rejected_messages_have_their_own_table(spark, tmp_path):
    write_messages(spark, f"{tmp_path}/in", [*TWO_MESSAGES, "not json", "{}"])
    stream = message_stream(spark, f"{tmp_path}/in")
    jobs.finish(jobs.run_rejected(stream, f"{tmp_path}/bad", f"{tmp_path}/check"))
    assert rows(spark.read.parquet(f"{tmp_path}/bad"), "value", "kafka_offset") == [("not json", 2), ("{}", 3)]


def test_basic_layout_keeps_unreadable_messages(spark, tmp_path):
    write_messages(spark, f"{tmp_path}/in", [*TWO_MESSAGES, "not json"])
    stream = message_stream(spark, f"{tmp_path}/in")
    jobs.finish(jobs.run_bronze(stream, f"{tmp_path}/out", f"{tmp_path}/check", "basic"))
    bronze = readers.read_table(spark, f"{tmp_path}/out")
    assert rows(bronze, "src_ip", "bytes") == [("10.7.0.15", 1700), ("10.8.0.23", 1000), (None, None)]
    assert bronze.filter("ingestion_time is null").count() == 0


def test_bronze_stream_equals_batch_with_bounded_intake(spark, tmp_path):
    lines = derived.table(spark, SF_DIR, "lineitem", spread=False)
    derived.flow_messages(lines).repartition(5).write.parquet(f"{tmp_path}/in")
    stream = message_stream(spark, f"{tmp_path}/in", max_files=2)
    query = jobs.finish(jobs.run_bronze(stream, f"{tmp_path}/out", f"{tmp_path}/check"))
    assert len([entry for entry in query.recentProgress if entry["numInputRows"]]) == 3
    wanted = queries.bronze_narrow(spark, SF_DIR)
    assert rows(readers.read_table(spark, f"{tmp_path}/out").select(*wanted.columns)) == rows(wanted)


def test_finish_stops_a_running_query(spark, tmp_path):
    write_messages(spark, f"{tmp_path}/in", TWO_MESSAGES)
    stream = message_stream(spark, f"{tmp_path}/in")
    query = jobs.run_bronze(stream, f"{tmp_path}/out", f"{tmp_path}/check", trigger="1 second")
    assert query.isActive
    assert not jobs.finish(query, timeout=5).isActive


def test_finish_raises_the_error_of_the_query(spark, tmp_path):
    write_messages(spark, f"{tmp_path}/in", TWO_MESSAGES)

    def fail(batch, batch_id):
        raise RuntimeError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        jobs.finish(jobs.fan_out(message_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/check", fail))


def add_log(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_eve_ingest_is_incremental_and_idempotent(spark, tmp_path):
    folder, out, check = tmp_path / "log", f"{tmp_path}/out", f"{tmp_path}/check"
    yesterday = event(flow_id=1, timestamp="2025-04-27T12:00:00.000000+0000")

    def run(checkpoint=check):
        events = readers.read_eve_stream(spark, str(folder), EVE_FILE, max_files=1)
        jobs.finish(jobs.run_eve_ingest(events, out, checkpoint, f"{tmp_path}/rejected"))
        return rows(readers.read_table(spark, out), "flow_id")

    add_log(folder, "a.json", event(flow_id=1), event(flow_id=2), event(flow_id=2), "{broken", yesterday)
    assert run() == [("1",), ("1",), ("2",)]
    add_log(folder, "b.json", event(flow_id=2), event(flow_id=3))
    assert run() == [("1",), ("1",), ("2",), ("3",)]
    # A lost checkpoint reads everything again and adds nothing.
    assert run(f"{tmp_path}/other") == [("1",), ("1",), ("2",), ("3",)]
    assert spark.read.parquet(f"{tmp_path}/rejected").select("_corrupt_record").distinct().count() == 1
    stored = readers.read_table(spark, out)
    assert rows(stored.drop("event_date"), "hash_id") == rows(
        ids.dedupe_trafego(ids.to_trafego(readers.read_eve(spark, str(folder)))), "hash_id"
    )


def test_insert_new_adds_each_key_once(spark, tmp_path):
    path = f"{tmp_path}/table"
    schema = "hash_id string, event_date date, n int"
    days = [dt.date(2024, 1, day) for day in range(1, 6)]
    table = spark.createDataFrame([(f"h{i}", day, i) for i, day in enumerate(days)], schema)
    jobs.insert_new(table, path)
    jobs.insert_new(table, path)
    again = spark.createDataFrame([("h0", days[0], 9), ("h9", days[0], 9), ("h9", days[0], 9), ("x", None, 1)], schema)
    jobs.insert_new(again, path)
    jobs.insert_new(again, path)
    wanted = [("h0", 0), ("h1", 1), ("h2", 2), ("h3", 3), ("h4", 4), ("h9", 9), ("x", 1)]
    assert rows(spark.read.parquet(path), "hash_id", "n") == wanted
    jobs.insert_new(table, path)
    assert rows(spark.read.parquet(path), "hash_id", "n") == wanted


def test_relational_insert_takes_new_keys_only(spark, monkeypatch):
    written = []
    stored = spark.createDataFrame([("a", 1)], "hash_id string, n int")
    monkeypatch.setattr(jobs.readers, "read_jdbc", lambda *args, **options: stored)
    monkeypatch.setattr(jobs.writers, "write_jdbc", lambda table, url, name, **options: written.extend(rows(table)))
    batch = spark.createDataFrame([("a", 2), ("b", 3), ("b", 3)], "hash_id string, n int")
    jobs.insert_new_jdbc(batch, "jdbc:x", "trafego")
    assert written == [("b", 3)]


def test_fan_out_repeats_a_batch_without_doubling(spark, tmp_path):
    batch = spark.createDataFrame([(1,), (2,)], "a int")
    write = jobs.folder_writer(f"{tmp_path}/sink")
    write(batch, 0)
    write(batch, 0)
    write(batch, 1)
    assert spark.read.parquet(f"{tmp_path}/sink").count() == 4


def test_dedupe_stream_over_several_batches(spark, tmp_path):
    schema = "src_ip string, event_time timestamp"
    for i, minute in enumerate((0, 3, 5)):
        table = spark.createDataFrame([("a", T0 + dt.timedelta(minutes=minute)), (f"b{i}", T0)], schema)
        table.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    kept = jobs.dedupe_stream(stream, ["src_ip"], "10 minutes")
    jobs.finish(jobs.write_stream(kept, f"{tmp_path}/out", f"{tmp_path}/check"))
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "src_ip") == [("a",), ("b0",), ("b1",), ("b2",)]


RECORDS = "src_ip string, dest_ip string, src_port int, dest_port int, proto string, event_time timestamp, packets long, bytes long"


def record(second, src="a", proto="TCP", packets=1):
    return (src, "z", 1, 2, proto, T0 + dt.timedelta(seconds=second), packets, packets * 10)


def test_idle_bound_is_inclusive(spark):
    table = spark.createDataFrame([record(0), record(5), record(10.000001), record(30, proto=None)], RECORDS)
    found = rows(sessions.assemble_flows(table), "proto", "packets", "records")
    assert found == [("TCP", 1, 1), ("TCP", 2, 2), (None, 1, 1)]


@pytest.mark.parametrize("idle", [1, 5, 60])
def test_batch_flows_equal_session_windows(spark, idle):
    rng = random.Random(idle)
    # A third of the records belong to one tuple.
    table = [record(rng.random() * 500, "hot" if i % 3 == 0 else rng.choice("abcdef"), packets=i) for i in range(300)]
    frame = spark.createDataFrame(table, RECORDS).repartition(3)
    key = list(sessions.FIVE_TUPLE)
    merged = frame.groupBy(*key, F.session_window("event_time", f"{idle} seconds")).agg(
        F.min("event_time"), F.max("event_time"), F.sum("packets"), F.sum("bytes"), F.count(F.lit(1))
    )
    assert rows(sessions.assemble_flows(frame, idle)) == rows(merged.drop("session_window"))


def naive_flows(times, idle, life):
    """One record after the other."""
    found = []
    for at in sorted(times):
        if found and at - found[-1][-1] <= idle and at - found[-1][0] <= life:
            found[-1].append(at)
        else:
            found.append([at])
    return found


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=40), st.integers(1, 8), st.integers(1, 20), st.integers(0, 39))
def test_cut_flows_equals_naive(times, idle, life, split):
    times = sorted(times)
    head, tail = times[: split % len(times)], times[split % len(times) :]
    before = naive_flows(head, idle, life)
    opened = before[-1] if before else [tail[0]]
    cuts = stateful.cut_flows(np.array(tail), opened[0], opened[-1], idle, life)
    edges = [0, *cuts, len(tail)]
    parts = [tail[a:b] for a, b in zip(edges[:-1], edges[1:])]
    joined = before[:-1] + [(before[-1] if before else []) + parts[0]] + parts[1:]
    assert joined == naive_flows(times, idle, life)


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.integers(0, 100), max_size=40),
    st.sampled_from(["limit", "both", "threshold"]),
    st.integers(1, 5),
    st.integers(1, 30),
    st.integers(0, 40),
)
def test_limit_positions_equals_naive(times, kind, n, period, split):
    times = sorted(times)
    start, count, wanted = None, 0, []
    for at in times:
        if start is None or at >= start + period:
            start, count = at, 0
        count += 1
        wanted.append({"limit": count <= n, "both": count == n, "threshold": count % n == 0}[kind])
    first, start, count = stateful.limit_positions(np.array(times[:split], dtype=int), None, 0, kind, n, period)
    second, _, _ = stateful.limit_positions(np.array(times[split:], dtype=int), start, count, kind, n, period)
    assert [*first, *second] == wanted


def delivered(spark, path, table, schema, files, shuffled=False):
    """Files that are a micro-batch each: following each other in time, or all but the last row in any order."""
    table = sorted(table, key=lambda row: next(v for v in row if isinstance(v, dt.datetime)))
    if shuffled:
        first = table[:-1]
        random.Random(1).shuffle(first)
        table = [*first, table[-1]]
    size = -(-len(table) // files)
    for i in range(0, len(table), size):
        spark.createDataFrame(table[i : i + size], schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("shuffled", [False, True])
def test_flow_life_over_several_batches(spark, tmp_path, shuffled):
    rng = random.Random(7)
    table = [record(rng.random() * 200, "hot" if i % 3 == 0 else rng.choice("abcd"), packets=i) for i in range(300)]
    last = record(10_000, "late")
    stream = delivered(spark, f"{tmp_path}/in", [*table, last], RECORDS, 4, shuffled)
    found = stateful.assemble_flows_stream(stream, 5, 12, late="300 seconds" if shuffled else "2 seconds")
    jobs.finish(jobs.write_stream(found, f"{tmp_path}/out", f"{tmp_path}/check"))
    wanted = []
    for src in "abcd", "hot":
        for name in [src] if src == "hot" else src:
            mine = {}
            for row in table:
                if row[0] == name:
                    mine[row[5]] = row
            for part in naive_flows(mine, dt.timedelta(seconds=5), dt.timedelta(seconds=12)):
                wanted.append((name, part[0], part[-1], sum(mine[at][6] for at in part), len(part)))
    out = spark.read.parquet(f"{tmp_path}/out")
    assert rows(out, "src_ip", "start_time", "end_time", "packets", "records") == sorted(wanted, key=repr)
    assert dict(out.dtypes)["src_port"] == "int"


@pytest.mark.parametrize("split", [0, 400, 1000])
def test_assembled_equals_naive_for_many_keys_at_once(split):
    rng = random.Random(split)
    table = sorted((rng.randrange(300), rng.choice("abcdefghijklmnopqrst") + "é", i) for i in range(1000))
    columns = ["at", "key", "a"]
    entries = pd.DataFrame({"key": pd.Series(dtype=object), **{f"n{i}": pd.Series(dtype="int64") for i in range(5)}})
    done = []
    for part in (table[:split], table[split:]):
        rows = pd.DataFrame(part, columns=columns).astype({"at": "int64", "a": "int64"}).assign(b=2)
        over, entries = stateful.assembled(rows, entries, 4, 9)
        done.append(over)
    found = sorted(tuple(row) for row in pd.concat([*done, entries]).itertuples(index=False))
    wanted = []
    for key in {row[1] for row in table}:
        mine = [row for row in table if row[1] == key]
        for flow in naive_flows({row[0] for row in mine}, 4, 9):
            own = [row for row in mine if flow[0] <= row[0] <= flow[-1]]
            wanted.append((key, flow[0], flow[-1], sum(row[2] for row in own), 2 * len(own), len(own)))
    assert found == sorted(wanted)


def test_streams_call_python_for_buckets_and_leave_out_rows_without_time(spark, tmp_path):
    table = [record(i % 7, f"s{i}", packets=i) for i in range(2000)]
    table[5] = (*table[5][:6], None, None)
    for part in (table, [(*table[0][:5], None, *table[0][6:])], [record(10_000, "late")]):
        spark.createDataFrame(part, RECORDS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(RECORDS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    found = stateful.assemble_flows_stream(stream, 5, 12, late="2 seconds")
    assert "bucket" in found._jdf.queryExecution().analyzed().toString()
    jobs.finish(jobs.write_stream(found, f"{tmp_path}/out", f"{tmp_path}/check"))
    out = spark.read.parquet(f"{tmp_path}/out")
    assert rows(out, "src_ip", "packets", "records") == sorted(((f"s{i}", 0 if i == 5 else i, 1) for i in range(2000)), key=repr)


def test_flow_life_in_batch_equals_naive(spark):
    rng = random.Random(9)
    table = [record(rng.randrange(200), rng.choice("abcd"), packets=i) for i in range(300)]
    frame = spark.createDataFrame(table, RECORDS).repartition(3)
    found = sessions.assemble_flows(frame, 5, max_life=12)
    wanted = []
    for name in "abcd":
        mine = [row for row in table if row[0] == name]
        for part in naive_flows({row[5] for row in mine}, dt.timedelta(seconds=5), dt.timedelta(seconds=12)):
            own = [row for row in mine if part[0] <= row[5] <= part[-1]]
            wanted.append((name, part[0], part[-1], sum(row[6] for row in own), len(own)))
    assert rows(found, "src_ip", "start_time", "end_time", "packets", "records") == sorted(wanted, key=repr)


@pytest.mark.parametrize(("idle", "life", "slices"), [(5, 12, 4), (50, 3, 256), (7, 7, 1), (1000, 90, 8)])
def test_flow_life_of_a_hot_key_equals_naive(spark, monkeypatch, idle, life, slices):
    monkeypatch.setattr(sessions, "LIFE_SLICES", slices)
    rng = random.Random(idle)
    table = [record(rng.random() * 900, "hot" if i % 3 else rng.choice("abcdefgh"), packets=i) for i in range(900)]
    table += [record(x, "even") for x in range(0, 400, life)] + [record(x, "odd") for x in range(0, 400, life + 1)]
    found = sessions.assemble_flows(spark.createDataFrame(table, RECORDS), idle, max_life=life)
    wanted = []
    for name in sorted({row[0] for row in table}):
        mine = [row for row in table if row[0] == name]
        for part in naive_flows({row[5] for row in mine}, dt.timedelta(seconds=idle), dt.timedelta(seconds=life)):
            own = [row for row in mine if part[0] <= row[5] <= part[-1]]
            wanted.append((name, part[0], part[-1], sum(row[6] for row in own), len(own)))
    assert rows(found, "src_ip", "start_time", "end_time", "packets", "records") == sorted(wanted, key=repr)


def test_flow_life_of_odd_records(spark):
    whole = [record(1, "a"), record(500, "a")]
    odd = [(*row[:5], at, *row[6:]) for row in whole for at in (row[5], None)]
    odd += [(None, *row[1:]) for row in odd]
    found = sessions.assemble_flows(spark.createDataFrame(odd, RECORDS), 900, max_life=12)
    assert sorted(r[0] for r in rows(found, "records")) == [1, 1, 1, 1, 2, 2]
    assert found.filter("src_ip IS NULL").count() == 3 and dict(found.dtypes)["src_port"] == "int"
    assert sessions.assemble_flows(spark.createDataFrame([], RECORDS), 5, max_life=12).count() == 0


def test_flow_life_runs_without_python_and_splits_a_key(spark):
    found = sessions.assemble_flows(spark.createDataFrame([record(i, "a") for i in range(100)], RECORDS), 5, max_life=12)
    text = plan(found)
    assert "Arrow" not in text and "Python" not in text and "slice" in text


def test_idle_stream_equals_batch(spark, tmp_path):
    rng = random.Random(3)
    table = [record(rng.random() * 300, rng.choice("abc"), packets=i) for i in range(100)]
    stream = delivered(spark, f"{tmp_path}/in", [*table, record(10_000, "late")], RECORDS, 3)
    found = stateful.assemble_flows_stream(stream, 5, None, late="1 second")
    jobs.finish(jobs.write_stream(found, f"{tmp_path}/out", f"{tmp_path}/check"))
    wanted = sessions.assemble_flows(spark.createDataFrame(table, RECORDS), 5)
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(wanted)


@pytest.mark.parametrize("shuffled", [False, True])
@pytest.mark.parametrize("kind", ["limit", "threshold", "both"])
def test_anchored_limit_over_several_batches(spark, tmp_path, kind, shuffled):
    rng = random.Random(5)
    schema = "alert_id string, ts timestamp, sig_id long, src_ip string, dest_ip string"
    table = [
        (str(i), T0 + dt.timedelta(seconds=rng.random() * 300), rng.choice([1, 2]), "hot" if i % 3 == 0 else rng.choice(["a", None]), "z")
        for i in range(200)
    ]
    last = ("last", T0 + dt.timedelta(seconds=10_000), 9, "late", "z")
    stream = delivered(spark, f"{tmp_path}/in", [*table, last], schema, 3, shuffled)
    found = stateful.rate_limit_stream(stream, kind, 3, 20, "by_src", "400 seconds" if shuffled else "1 second")
    jobs.finish(jobs.write_stream(found, f"{tmp_path}/out", f"{tmp_path}/check"))
    wanted, state = [], {}
    for ident, at, sig, src, _ in sorted(table, key=lambda row: row[1]):
        start, count = state.get((sig, src), (None, 0))
        if start is None or at >= start + dt.timedelta(seconds=20):
            start, count = at, 0
        state[(sig, src)] = (start, count + 1)
        if {"limit": count < 3, "both": count == 2, "threshold": count % 3 == 2}[kind]:
            wanted.append((sig, src, at, ident))
    out = spark.read.parquet(f"{tmp_path}/out")
    assert rows(out, "sig_id", "src_ip", "ts", "alert_id") == sorted(wanted, key=repr)
    with pytest.raises(ValueError):
        stateful.rate_limit_stream(stream, "never")
