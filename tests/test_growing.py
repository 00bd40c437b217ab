"""Logs that grow, rotate and are emptied while they are read."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from flowlantern.sources import derived, growing
from flowlantern.streaming import jobs


def reader(folder, **options):
    return growing.GrowingLogReader({"path": str(folder), **options})


def lines_of(source, start, end):
    return [line for span in source.partitions(start, end) for batch in source.read(span) for line in batch["value"].to_pylist()]


def test_a_line_counts_when_its_end_is_written(tmp_path):
    source, log = reader(tmp_path), tmp_path / "eve.json"
    assert source.latestOffset() == source.initialOffset() == {}
    log.write_bytes(b"half")
    assert source.latestOffset() == {}
    log.write_bytes(b"half a line\nand")
    first = source.latestOffset()
    assert lines_of(source, {}, first) == ["half a line"]
    with log.open("ab") as f:
        f.write("one més\r\n\n�\n".encode() + b"\xff\n")
    second = source.latestOffset()
    assert lines_of(source, first, second) == ["andone més", "�", "�"]
    assert lines_of(source, second, second) == [] and lines_of(source, second, source.latestOffset()) == []


def test_rotation_and_emptied_files(tmp_path):
    source, log = reader(tmp_path, pattern="eve.json*"), tmp_path / "eve.json"
    (tmp_path / "other.log").write_text("x\n")
    (tmp_path / ".eve.json").write_text("x\n")
    log.write_text("a\nb\n")
    first = source.latestOffset()
    with log.open("a") as f:
        f.write("c\n")
    planned = source.latestOffset()
    spans = source.partitions(first, planned)
    log.rename(tmp_path / "eve.json.1")  # between planning and reading
    log.write_text("d\n")
    assert [x for s in spans for b in source.read(s) for x in b["value"].to_pylist()] == ["c"]
    second = source.latestOffset()
    assert lines_of(source, planned, second) == ["d"]
    with log.open("r+") as f:  # emptied and written anew
        f.truncate()
        f.write("e\nf\n")
    third = source.latestOffset()
    assert lines_of(source, second, third) == ["e", "f"]
    os.remove(tmp_path / "eve.json.1")
    assert lines_of(source, third, source.latestOffset()) == []
    with pytest.raises(FileNotFoundError):
        source.partitions({}, third)


@pytest.mark.parametrize("block", [3, 1 << 20])
def test_splits_cover_every_line_once(tmp_path, monkeypatch, block):
    monkeypatch.setattr(growing, "BLOCK", block)
    rng = random.Random(2)
    wanted = ["x" * rng.randrange(1, 12) + str(i) for i in range(200)]
    (tmp_path / "a").write_text("".join(f"{w}\n" for w in wanted) + "open")
    for split in (1, 2, 7, 64, 1 << 20):
        source = reader(tmp_path, splitBytes=split)
        assert lines_of(source, {}, source.latestOffset()) == wanted


def test_a_stream_reads_each_byte_once(spark, tmp_path):
    log, taken, spans = tmp_path / "logs" / "eve.json", [], []
    log.parent.mkdir()
    read = 0
    for number in range(4):
        if number == 2:
            log.rename(f"{log}.1")
        with log.open("a") as f:
            f.write("".join(f"{number}-{i}\n" for i in range(50)) + ("" if number % 2 else "cut"))
        stream = growing.read_growing_log(spark, str(log.parent), split_bytes=100)
        query = jobs.finish(jobs.write_stream(stream, f"{tmp_path}/out", f"{tmp_path}/check"))
        taken.append(sum(p["numInputRows"] for p in query.recentProgress))
        found = [r[0] for r in spark.read.parquet(f"{tmp_path}/out").collect()]
        assert len(found) == sum(taken) and len(set(found)) == len(found)
    # the open line of the first run is completed by the second, that of the third by the fourth
    assert taken == [50, 50, 50, 50]
    assert "cut1-0" in found and "cut3-0" in found


def test_texts_of_paired_alerts_are_written_by_compiled_code(spark):
    events = spark.sql(
        "SELECT id AS event_id, timestamp_seconds(id) AS ts, id % 5 AS user_id, CASE id % 3 WHEN 0 THEN 'error' WHEN 1"
        " THEN 'view' END AS event_type FROM range(9)"
    )
    lines = derived.eve_lines(events, paired=True)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", lines._jdf.queryExecution().explainString(mode))
    assert sizes and max(map(int, sizes)) < 8000  # the JVM interprets methods above that
    # an event gives the line it gives alone; an alert gives a second one that differs in signature and severity
    alone = [r[0] for r in derived.eve_lines(events).collect()]
    both = [r[0] for r in lines.collect()]
    assert len(both) == 12 and set(alone) < set(both)
    assert sorted(x for x in both if x not in alone) == sorted(
        re.sub(r'"severity":\d', f'"severity":{1 + (n + 1) % 4}', alone[n].replace(f":240400{n % 3}", f":240410{n % 3}"))
        for n in (0, 3, 6)
    )


def test_sensors_grow_with_the_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(derived, "SENSOR_LINES", 100)
    lines = spark.range(350).select(F.col("id").cast("string").alias("value"))
    assert derived.sensors(lines) == 7 and derived.sensors(lines.limit(0)) == 4
    for part in (0, 1):
        derived.append_lines(lines.filter(F.col("value") % 2 == part), str(tmp_path), derived.sensors(lines))
    logs = [p.read_text().split() for p in tmp_path.iterdir() if p.suffix == ".json"]
    assert len(logs) == 7 and sorted(int(x) for log in logs for x in log) == [*range(350)]


def test_rows_of_a_batch_are_made_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def key(number):
        made.add(1)
        return f"k{number}"

    def batch(start, end):
        dates = F.when(F.col("id") % 5 > 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")))
        return spark.range(start, end, 1, 2).select(key("id").alias("hash_id"), dates.alias("event_date"))

    jobs.insert_new(batch(0, 60), f"{tmp_path}/t")
    jobs.insert_new(batch(30, 100), f"{tmp_path}/t")
    assert made.value == 60 + 70
    jobs.insert_new(batch(0, 100), f"{tmp_path}/t")
    found = [r[0] for r in spark.read.parquet(f"{tmp_path}/t").select("hash_id").collect()]
    assert sorted(found) == sorted(f"k{i}" for i in range(100))
