"""The command line runs the jobs end to end."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tallyloom.plans.cli import main, parser
from tallyloom.sinks import write_lines
from tallyloom.sources import from_rows, read_lines

G1 = ["hello world", "hello flink", "hello flink spark"]


def test_word_count_command(spark, scratch):
    write_lines(from_rows(spark, G1), f"{scratch}/in")
    main(["word-count", "--input", f"{scratch}/in", "--output", f"{scratch}/out"], spark)
    got = sorted(r.line for r in read_lines(spark, f"{scratch}/out").collect())
    assert got == ["KV{flink, 2}", "KV{hello, 3}", "KV{spark, 1}", "KV{world, 1}"]


def test_route_lines_command(spark, scratch):
    write_lines(from_rows(spark, G1), f"{scratch}/in")
    main(["route-lines", "--input", f"{scratch}/in", "--output", f"{scratch}/out"], spark)
    got = {r.tag: r.n for r in spark.read.parquet(f"{scratch}/out").groupBy("tag").agg(F.count("*").alias("n")).collect()}
    assert got == {"world": 1, "spark": 1, "flink": 1}


def test_cogroup_words_command(spark, scratch):
    write_lines(from_rows(spark, ["Ahello Aworld"]), f"{scratch}/a")
    write_lines(from_rows(spark, ["Bhello Aworld"]), f"{scratch}/b")
    main(["cogroup-words", "--input-a", f"{scratch}/a", "--input-b", f"{scratch}/b", "--output", f"{scratch}/out"], spark)
    got = {r.word: (list(r.a), list(r.b)) for r in spark.read.parquet(f"{scratch}/out").collect()}
    assert got == {"Ahello": ([1], []), "Bhello": ([], [1]), "Aworld": ([1], [1])}


def test_unknown_job_is_rejected():
    with pytest.raises(SystemExit):
        parser().parse_args(["no-such-job"])


def test_catalog_column_command(spark, scratch):
    from_rows(spark, [("x", 1), ("y", 2)], "c0 string, c1 int").write.parquet(f"{scratch}/t")
    spark.catalog.createTable("cli_table", path=f"{scratch}/t", source="parquet")
    main(["catalog-column", "--table", "cli_table", "--output", f"{scratch}/out"], spark)
    assert sorted(r.line for r in read_lines(spark, f"{scratch}/out").collect()) == ["x", "y"]


def test_jdbc_counts_command_on_embedded_derby(spark, capsys):
    # Derby embedded in memory: seen only by this JVM, no server, no port.
    from test_sources_sinks import DERBY, _derby

    from tallyloom.sources import read_jdbc

    url = _derby(spark, "cli")
    main(["jdbc-counts", "--source-url", url, "--query", "select cast(id as int) as nid, name from people",
          "--target-table", "name_counts_out", "--driver", DERBY, "--partition-column", "nid",
          "--num-partitions", "2"], spark)
    got = sorted((r.NAME, r.COUNT) for r in read_jdbc(spark, url, table="name_counts_out", driver=DERBY).collect())
    assert got == [("a", "20"), ("b", "10")]
    assert "rows with a null name left out: 1" in capsys.readouterr().out


def test_int_stream_command_resumes_after_restart(spark, scratch):
    import datetime as dt

    from tallyloom.streaming import latest_windows

    t0 = dt.datetime(2024, 1, 1)
    schema = "key string, value string, timestamp timestamp"
    from_rows(spark, [(None, "5", t0), (None, "6", t0 + dt.timedelta(seconds=1))], schema).write.parquet(f"{scratch}/in/a")
    args = ["int-stream", "--topic", "t", "--source-files", f"{scratch}/in/*", "--output", f"{scratch}/out",
            "--available-now", "--watermark", "1 hour"]
    main(args, spark)
    from_rows(spark, [(None, "7", t0 + dt.timedelta(seconds=2))], schema).write.parquet(f"{scratch}/in/b")
    main(args, spark)  # same topic and output: resumes, reads only the new file
    assert [r.s for r in latest_windows(spark, f"{scratch}/out").collect()] == [18]
    # Each run writes a data batch and an idle batch (moving the watermark).  A
    # resumed query numbers on (batch 2 holds the new data); starting over
    # would have rewritten batches 0 and 1 only.
    batches = sorted(n for n in os.listdir(f"{scratch}/out") if n.startswith("batch="))
    assert batches == ["batch=0", "batch=1", "batch=2", "batch=3"]
    assert [r.s for r in spark.read.parquet(f"{scratch}/out/batch=2").collect()] == [18]


def test_int_stream_command_replays_files_in_bounded_batches(spark, scratch):
    import datetime as dt

    from tallyloom.streaming import latest_windows

    t0 = dt.datetime(2024, 1, 1)
    schema = "key string, value string, timestamp timestamp"
    from_rows(spark, [(None, "1", t0)], schema).write.parquet(f"{scratch}/in/a")
    from_rows(spark, [(None, "2", t0 + dt.timedelta(seconds=1))], schema).write.parquet(f"{scratch}/in/b")
    main(["int-stream", "--topic", "t", "--source-files", f"{scratch}/in/*", "--output", f"{scratch}/out",
          "--available-now", "--watermark", "1 hour", "--max-files-per-trigger", "1"], spark)
    assert [r.s for r in latest_windows(spark, f"{scratch}/out").collect()] == [3]
    data_batches = [n for n in os.listdir(f"{scratch}/out") if n.startswith("batch=")]
    assert len(data_batches) >= 2
