"""Options of connectors whose servers are not part of the test machine, and session helpers."""

import pytest

from conftest import SF_DIR, rows
from flowlantern.session import shared_dir, shuffle_partitions
from flowlantern.sources import derived, readers, writers
from flowlantern.streaming import jobs


class Recorder:
    """Stands in for a reader or writer and notes what it is told."""

    def __init__(self):
        self.told = {}

    @property
    def readStream(self):
        return self

    read = write = readStream

    def format(self, name):
        self.told["format"] = name
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    def option(self, key, value):
        self.told[key] = value
        return self

    def options(self, **values):
        self.told.update(values)
        return self

    def load(self):
        return self

    save = load


def test_kafka_defaults_and_bounds():
    told = readers.read_flow_stream(Recorder(), "broker:9092").told
    assert told == {
        "format": "kafka",
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "ipfix-network-flow",
        "startingOffsets": "earliest",
    }
    told = readers.read_flow_stream(Recorder(), "b", "security-network-flux", "latest", 1000, 64).told
    assert (told["subscribe"], told["startingOffsets"]) == ("security-network-flux", "latest")
    assert (told["maxOffsetsPerTrigger"], told["minPartitions"]) == (1000, 64)


def test_jdbc_read_is_split_by_bounds():
    told = readers.read_jdbc(Recorder(), "jdbc:x", "trafego", {"user": "u"}, "id", (0, 10), 4).told
    assert told["format"] == "jdbc" and told["dbtable"] == "trafego" and told["user"] == "u"
    assert (told["partitionColumn"], told["lowerBound"], told["upperBound"], told["numPartitions"]) == ("id", 0, 10, 4)
    assert "partitionColumn" not in readers.read_jdbc(Recorder(), "jdbc:x", "t").told
    with pytest.raises(ValueError):
        readers.read_jdbc(Recorder(), "jdbc:x", "t", partition_col="id")


def test_jdbc_write_is_batched():
    table = Recorder()
    writers.write_jdbc(table, "jdbc:x", "trafego", partitions=3, batch_size=50)
    assert table.told == {
        "format": "jdbc", "mode": "append", "url": "jdbc:x", "dbtable": "trafego", "numPartitions": 3, "batchsize": 50,
    }


def test_s3a_settings_hold_no_credentials():
    conf = writers.s3a_conf("http://store:3900", "region", ssl=False)
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert conf["spark.hadoop.fs.s3a.committer.name"] == "magic"
    assert not [key for key in conf if "key" in key.split(".") or "secret" in key]
    plain = writers.s3a_conf("e", "r", committer="file")
    assert plain["spark.hadoop.mapreduce.fileoutputcommitter.algorithm.version"] == "1"


def test_shared_dir_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(root) and first != second


class Cluster:
    class conf:
        @staticmethod
        def get(key, default=None):
            return {"spark.master": "spark://head:7077"}.get(key, default)


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        shared_dir(Cluster, "x")


def test_shuffle_partitions_follow_the_data():
    assert shuffle_partitions(10 << 20, 8) == 8
    assert shuffle_partitions(100 << 40, 8000) == 524288


def test_rows_are_dealt_out_only_on_demand(spark):
    small = readers.read_table(spark, f"{SF_DIR}/events.parquet")
    assert readers.spread(small, "event_id") is small
    spark.conf.set("spark.flowlantern.input.tasks", "3")
    try:
        assert readers.spread(small, "event_id").rdd.getNumPartitions() == 3
        assert rows(derived.table(spark, SF_DIR, "events"), "event_id") == rows(small, "event_id")
    finally:
        spark.conf.unset("spark.flowlantern.input.tasks")


def test_kafka_writer_options(monkeypatch):
    class Recorder(dict):
        def __getattr__(self, name):
            return lambda *a: self.update({name: a}) or self if name != "option" else self.update([a]) or self

        write = property(lambda self: self)

    recorder = Recorder()
    monkeypatch.setattr(jobs.writers, "encode_json", lambda batch, key: recorder)
    jobs.kafka_writer("broker:9092", "out", "src_ip")(None, 0)
    assert recorder["kafka.bootstrap.servers"] == "broker:9092" and recorder["topic"] == "out" and "save" in recorder
