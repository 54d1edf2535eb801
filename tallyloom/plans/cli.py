"""Command line for the six jobs, to run with ``spark-submit``.

    zip -r tallyloom.zip tallyloom
    spark-submit --py-files tallyloom.zip tallyloom/plans/cli.py \
        word-count --input hdfs:///in --output hdfs:///out

The master, resources, Kerberos principal and keytab, and the catalog are
``spark-submit`` settings, not options here.
"""

from __future__ import annotations

import argparse
import hashlib
import os
import sys
from collections.abc import Sequence

if __package__ in (None, ""):  # run as a script by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession

from tallyloom.plans.jobs import (
    catalog_first_column,
    int_parse_stream_job,
    int_stream_job,
    jdbc_round_trip,
    line_routing,
    word_cogroup,
    word_count_job,
)
from tallyloom.session import build_session, shared_dir
from tallyloom.sinks import write_branches, write_lines
from tallyloom.sources import read_kafka, read_lines, read_stream_files

# Columns of a message record, as Kafka's source gives them after the text cast.
RECORD_SCHEMA = "key string, value string, timestamp timestamp"


def _password(path: str | None) -> str | None:
    if not path:
        return None
    with open(path) as fh:
        return fh.read().strip()


def _word_count(spark: SparkSession, a: argparse.Namespace) -> None:
    word_count_job(spark, a.input, a.output)


def _cogroup_words(spark: SparkSession, a: argparse.Namespace) -> None:
    out = word_cogroup({"a": read_lines(spark, a.input_a), "b": read_lines(spark, a.input_b)})
    out.write.mode("errorifexists").parquet(a.output)


def _route_lines(spark: SparkSession, a: argparse.Namespace) -> None:
    write_branches(line_routing(read_lines(spark, a.input)), a.output)


def _jdbc_counts(spark: SparkSession, a: argparse.Namespace) -> None:
    common = {"driver": a.driver, "user": a.user, "password": _password(a.password_file)}
    source = dict(common)
    if a.partition_column:
        source.update(partition_column=a.partition_column, num_partitions=a.num_partitions)
    elif a.single_task:
        source["single_task"] = True
    else:
        raise SystemExit("jdbc-counts needs --partition-column (or --single-task for a small query)")
    obs = jdbc_round_trip(
        spark,
        a.source_url,
        a.query,
        a.target_url or a.source_url,
        a.target_table,
        name_position=a.name_position,
        source_options=source,
        target_options=common,
    )
    print(f"rows read: {obs.get['rows']}, rows with a null name left out: {obs.get['null_names']}")


def _catalog_column(spark: SparkSession, a: argparse.Namespace) -> None:
    write_lines(catalog_first_column(spark, a.table), a.output)


def _int_stream(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.source_files:
        records = read_stream_files(spark, a.source_files, RECORD_SCHEMA, max_files_per_trigger=a.max_files_per_trigger)
    else:
        if not a.bootstrap_servers:
            raise SystemExit("int-stream needs --bootstrap-servers (or --source-files)")
        extra = {"maxOffsetsPerTrigger": str(a.max_offsets_per_trigger)} if a.max_offsets_per_trigger else None
        records = read_kafka(spark, a.bootstrap_servers, a.topic, a.starting_offsets, extra)
    # The same topic and output always use the same checkpoint, so a restarted
    # job resumes where it stopped instead of starting over.
    digest = hashlib.sha1(f"{a.topic}\n{a.output}".encode()).hexdigest()[:16]
    checkpoint = a.checkpoint or f"{shared_dir(spark)}/int-stream-checkpoints/{digest}"
    trigger = {"availableNow": True} if a.available_now else None
    strict = not a.tolerant
    if a.no_window:
        query = int_parse_stream_job(records, a.output, checkpoint, strict=strict, trigger=trigger)
    else:
        query = int_stream_job(records, a.output, checkpoint, a.watermark, a.window, trigger, a.output_mode, strict)
    query.awaitTermination()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tallyloom", description=__doc__.splitlines()[0])
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("word-count", help="text files -> KV{word, n} lines")
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.set_defaults(run=_word_count)

    s = sub.add_parser("cogroup-words", help="word counts of two text inputs, co-grouped by word")
    s.add_argument("--input-a", required=True)
    s.add_argument("--input-b", required=True)
    s.add_argument("--output", required=True)
    s.set_defaults(run=_cogroup_words)

    s = sub.add_parser("route-lines", help="lines routed by suffix, one folder per output")
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.set_defaults(run=_route_lines)

    s = sub.add_parser("jdbc-counts", help="rows per name x 10, from a query into a table")
    s.add_argument("--source-url", required=True)
    s.add_argument("--query", required=True)
    s.add_argument("--target-url")
    s.add_argument("--target-table", required=True)
    s.add_argument("--name-position", type=int, default=1, help="0-based column of the name")
    s.add_argument("--driver")
    s.add_argument("--user")
    s.add_argument("--password-file", help="file holding the password (kept off the command line)")
    s.add_argument("--partition-column", help="numeric column to split the read on (bounds are looked up)")
    s.add_argument("--num-partitions", type=int, default=8, help="parallel reads when --partition-column is set")
    s.add_argument("--single-task", action="store_true", help="read the whole query in one task")
    s.set_defaults(run=_jdbc_counts)

    s = sub.add_parser("catalog-column", help="first column of a catalog table as text lines")
    s.add_argument("--table", required=True)
    s.add_argument("--metastore", help="Hive metastore URI, thrift://host:port")
    s.add_argument("--output", required=True)
    s.set_defaults(run=_catalog_column)

    s = sub.add_parser("int-stream", help="Kafka messages parsed to int, summed per tumbling window")
    s.add_argument("--bootstrap-servers")
    s.add_argument("--topic", required=True)
    s.add_argument("--source-files", help="replay records (key, value, timestamp) from Parquet files instead of Kafka")
    s.add_argument("--max-files-per-trigger", type=int, default=100, help="bound each micro-batch of a file replay")
    s.add_argument("--output", required=True)
    s.add_argument("--checkpoint", help="default: a folder in spark.checkpoint.dir fixed by topic and output")
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--max-offsets-per-trigger", type=int, default=10_000_000,
                   help="bound each micro-batch when catching up on a backlog (spread over the topic's partitions)")
    s.add_argument("--watermark", default="10 seconds")
    s.add_argument("--window", default="5 seconds")
    s.add_argument("--no-window", action="store_true", help="write every parsed value, no window sums")
    s.add_argument("--output-mode", choices=["update", "append"], default="update",
                   help="update: upsert changed windows per batch; append: each window once, when final")
    s.add_argument("--tolerant", action="store_true",
                   help="leave out messages that are not integers (counted in the progress) instead of failing")
    s.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    s.set_defaults(run=_int_stream)
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    if spark is None:
        spark = build_session(app_name=f"tallyloom-{args.job}", hive_metastore_uri=getattr(args, "metastore", None))
    args.run(spark, args)


if __name__ == "__main__":
    main()
