"""Jobs from the command line: ``python -m flowlantern <job> ...`` or through ``spark-submit``."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from flowlantern.operators import ids
from flowlantern.plans import medallion
from flowlantern.session import STREAM_CONF, build_session
from flowlantern.sources import readers, writers
from flowlantern.streaming import jobs


def stream_flows(spark: SparkSession, args: argparse.Namespace) -> None:
    messages = readers.read_flow_stream(spark, args.servers, args.topic, args.starting, args.max_offsets)
    spark.streams.addListener(jobs.HealthListener())
    query = jobs.run_bronze(messages, args.path, args.checkpoint, args.layout, args.trigger)
    print(json.dumps(jobs.progress(jobs.finish(query))))


def refine(spark: SparkSession, args: argparse.Namespace) -> None:
    medallion.refine(spark, args.bronze, args.silver, args.gold, args.dedupe).show(args.rows, truncate=False)


def audit(spark: SparkSession, args: argparse.Namespace) -> None:
    for name, table in medallion.audit(spark, args.bronze).items():
        print(name)
        table.show(20, truncate=False)


def ingest_events(spark: SparkSession, args: argparse.Namespace) -> None:
    spark.streams.addListener(jobs.HealthListener())
    events = readers.read_eve_stream(spark, args.logs, max_files=args.max_files)
    query = jobs.run_eve_ingest(events, args.table, args.checkpoint, args.rejected, args.trigger)
    print(json.dumps(jobs.progress(jobs.finish(query))))


def ingest_log(spark: SparkSession, args: argparse.Namespace) -> None:
    """For logs in use, whose positions are kept; ``ingest-events`` is for closed files."""
    spark.streams.addListener(jobs.HealthListener())
    query = jobs.ingest_log(spark, args.logs, args.table, args.checkpoint, args.rejected, args.pattern, args.trigger)
    print(json.dumps(jobs.progress(query)))


def dashboard(spark: SparkSession, args: argparse.Namespace) -> None:
    trafego, classified = readers.read_table(spark, args.trafego), readers.read_table(spark, args.classificados)
    writers.write_table(ids.traffic_dashboard(trafego, classified), args.out)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="flowlantern", description=__doc__)
    top.add_argument("--shuffle-partitions", type=int, help="partitions a shuffle starts with; adaptive execution only merges them")
    commands = top.add_subparsers(required=True)

    def command(run, *required: str, **optional: object) -> None:
        sub = commands.add_parser(run.__name__.replace("_", "-"))
        sub.set_defaults(run=run)
        for name in required:
            sub.add_argument(f"--{name}", required=True)
        for name, default in optional.items():
            kind = int if isinstance(default, int) or name.startswith("max_") else str
            sub.add_argument(f"--{name.replace('_', '-')}", type=kind, default=default)

    command(
        stream_flows, "servers", "path", "checkpoint",
        topic="ipfix-network-flow", starting="earliest", layout="narrow", trigger=None, max_offsets=None,
    )
    command(refine, "bronze", "silver", "gold", dedupe="row", rows=10)
    command(audit, "bronze")
    command(ingest_events, "logs", "table", "checkpoint", rejected=None, trigger=None, max_files=None)
    command(ingest_log, "logs", "table", "checkpoint", rejected=None, pattern="*", trigger=None)
    command(dashboard, "trafego", "classificados", "out")
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    conf = dict(STREAM_CONF)
    if args.shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(args.shuffle_partitions)
    args.run(build_session(**conf), args)


if __name__ == "__main__":
    main()
