"""Streams that are stopped and restarted: branch steps, running counts, windows that leave the state, metrics."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import SF_SMALL, rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallyloom.plans import line_branch_steps_stream, read_stream_branch, registry, word_count_stream_job, word_count_text
from tallyloom.plans.jobs import int_stream_job
from tallyloom.sinks import tap
from tallyloom.sources import from_rows, read_stream_files
from tallyloom.streaming import batch_metrics, latest_keys, open_windows, record_metrics

NOW = {"availableNow": True}
RULES = [("cat", "cats"), ("dog", "dogs")]
LINES = [["a cat", "b dog", "c"], ["d cat", "e cat", None], ["f dog", "cat", "x"], ["g", "h cat"]]


def files(spark, path, parts, schema="line string"):
    """One file per part, in order; read as one micro-batch each."""
    for part in parts:
        from_rows(spark, [(x,) if not isinstance(x, tuple) else x for x in part], schema).coalesce(1).write.mode("append").parquet(path)
    return read_stream_files(spark, path, schema, max_files_per_trigger=1)


def finished(query):
    query.awaitTermination()
    return query


def steps(fail_at: str | None = None):
    def cats(df):
        return df.groupBy(F.lit("cats").alias("v")).agg(F.count("*").alias("n"))

    def dogs(df):
        if fail_at and df.filter(F.col("line") == fail_at).count():
            raise RuntimeError("the step of the dogs fails")
        return df.select(F.upper("line").alias("v"), F.lit(1).cast("long").alias("n"))

    return {"cats": cats, "dogs": dogs}


def branches_of(spark, path):
    own = {tag: read_stream_branch(spark, path, tag, "v string, n long") for tag in ("cats", "dogs")}
    rest = read_stream_branch(spark, path, "rest", "line string")
    return {
        "cats": own["cats"].agg(F.sum("n")).first()[0],
        "dogs": rows(own["dogs"], "v"),
        "rest": rows(rest, "line"),
        "batches": sorted(r.batch for r in own["cats"].select("batch").distinct().collect()),
    }


def test_branch_steps_survive_a_failure_within_a_batch(spark, scratch):
    stream = files(spark, f"{scratch}/in", LINES)
    out, checkpoint = f"{scratch}/out", f"{scratch}/checkpoint"
    start = lambda s: line_branch_steps_stream(stream, out, checkpoint, s, "line", RULES, "rest", NOW)
    with pytest.raises(StreamingQueryException, match="the step of the dogs fails"):
        finished(start(steps(fail_at="f dog")))
    half = branches_of(spark, out)
    assert half["batches"] == [0, 1, 2] and half["dogs"] == [("B DOG",)]  # the cats of batch 2 are written, its dogs are not
    finished(start(steps()))
    whole = branches_of(spark, out)
    assert whole == {"cats": 5, "dogs": [("B DOG",), ("F DOG",)], "rest": [("c",), ("g",), ("x",), (None,)], "batches": [0, 1, 2, 3]}
    finished(start(steps()))  # nothing new
    assert branches_of(spark, out) == whole


def test_branch_steps_before_the_first_batch_and_unknown_tags(spark, scratch):
    assert read_stream_branch(spark, f"{scratch}/none", "cats", "v string").dtypes == [("v", "string"), ("batch", "bigint")]
    stream = files(spark, f"{scratch}/in", LINES[:1])
    with pytest.raises(ValueError, match="no output is tagged"):
        line_branch_steps_stream(stream, scratch, scratch, {"birds": lambda df: df}, "line", RULES, "rest")


TEXTS = [["a b a", "c"], ["a", None], ["b b", ""], ["d a"], ["a  a"]]


@pytest.mark.parametrize("every", [1, 2, 100])
def test_running_word_counts_equal_the_batch_ones(spark, scratch, every):
    stream = files(spark, f"{scratch}/in", TEXTS, "text string")
    out, checkpoint = f"{scratch}/out", f"{scratch}/checkpoint"
    start = lambda: word_count_stream_job(stream, out, checkpoint, "text", every, NOW)
    query = finished(start())
    assert len(query.recentProgress) >= len(TEXTS)
    expected = rows(word_count_text(from_rows(spark, [(t,) for part in TEXTS for t in part], "text string")))
    schema = word_count_text(stream).schema
    assert rows(latest_keys(spark, out, schema, ["word"])) == expected
    bases = [r.base for r in spark.read.schema("base long").parquet(f"{out}/bases").collect()]
    assert sorted(bases) == [b for b in range(len(TEXTS)) if (b + 1) % every == 0]
    # more files later, by a restarted query
    from_rows(spark, [("z a",)], "text string").coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    finished(start())
    count = Counter(dict(expected))
    count.update(["z", "a"])
    assert dict(rows(latest_keys(spark, out, schema, ["word"]))) == count


def test_running_counts_before_the_first_batch(spark, scratch):
    from_rows(spark, [("x",)], "text string").limit(0).coalesce(1).write.parquet(f"{scratch}/in")
    stream = read_stream_files(spark, f"{scratch}/in", "text string")
    finished(word_count_stream_job(stream, f"{scratch}/out", f"{scratch}/checkpoint", "text", trigger=NOW))
    assert latest_keys(spark, f"{scratch}/out", word_count_text(stream).schema, ["word"]).count() == 0


def test_a_replayed_batch_replaces_what_it_wrote(spark, scratch):
    stream = files(spark, f"{scratch}/in", TEXTS, "text string")
    out = f"{scratch}/out"
    finished(word_count_stream_job(stream, out, f"{scratch}/checkpoint", "text", 2, NOW))
    schema = word_count_text(stream).schema
    before = rows(latest_keys(spark, out, schema, ["word"]))
    # the base of batch 3 is written and recorded again, as after a failure before the batch's commit
    spark.createDataFrame([(3,)], "base long").write.mode("append").parquet(f"{out}/bases")
    again = spark.read.schema(schema).parquet(f"{out}/changes/batch=4").collect()
    spark.createDataFrame(again, schema).write.mode("overwrite").parquet(f"{out}/changes/batch=4")
    assert rows(latest_keys(spark, out, schema, ["word"])) == before


def test_finished_windows_leave_the_state(spark, scratch):
    stream = registry._replay(spark, SF_SMALL)
    out, checkpoint = f"{scratch}/out", f"{scratch}/checkpoint"
    query = finished(int_stream_job(stream, out, checkpoint, watermark="1 hour", duration="5 seconds", trigger=NOW, output_mode="append"))
    states = [p.stateOperators[0] for p in query.recentProgress if p.stateOperators]
    total = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(F.window("ts", "5 seconds")).distinct().count()
    assert sum(s.numRowsRemoved for s in states) > 0.9 * total
    assert all(s.numRowsDroppedByWatermark == 0 for s in states)
    left, written = open_windows(spark, checkpoint).count(), spark.read.parquet(out).count()
    assert left + written == total and 0 < left < 0.1 * total
    assert max(s.numRowsTotal for s in states) < 0.5 * total  # never the whole span at once


def test_metrics_of_every_batch_are_kept(spark, scratch):
    stream = files(spark, f"{scratch}/in", LINES)
    metrics = {"cats": F.count_if(F.col("line").endswith("cat"))}
    seen, _ = tap(stream, "lines_seen", metrics)

    def run():
        with record_metrics(spark, f"{scratch}/metrics", "lines_seen", metrics) as recorder:
            query = seen.writeStream.format("noop").option("checkpointLocation", f"{scratch}/checkpoint").trigger(availableNow=True).start()
            recorder.follow(query.id)
            finished(query)

    run()
    assert rows(batch_metrics(spark, f"{scratch}/metrics", metrics)) == [(0, 3, 1), (1, 3, 2), (2, 3, 1), (3, 2, 1)]
    from_rows(spark, [("late cat",)], "line string").coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    run()
    assert rows(batch_metrics(spark, f"{scratch}/metrics", metrics))[-1] == (4, 1, 1)
