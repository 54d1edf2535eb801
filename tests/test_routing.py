"""Routing to named outputs (F2, R1, R2, Q3; E5)."""

from __future__ import annotations

import pytest
from conftest import natural, rows
from pyspark.sql import functions as F

from tallyloom.operators import branches, route
from tallyloom.plans import line_branch_steps, line_branches, line_branches_written, line_routing
from tallyloom.sinks import write_branches
from tallyloom.sources import from_rows

G3 = ["hello world", "hello flink", "hello flink spark"]


def test_g3_routing(spark):
    out = rows(line_routing(from_rows(spark, G3)))
    assert out == sorted([("hello world", "world"), ("hello flink", "flink"), ("hello flink spark", "spark")])


def test_first_rule_wins_and_null_goes_to_default(spark):
    df = from_rows(spark, ["x-ab", "x-b", None, "x"])
    out = rows(route(df, "line", [("b", "B"), ("ab", "AB")], "other"))
    assert out == sorted([("x-ab", "B"), ("x-b", "B"), (None, "other"), ("x", "other")], key=natural)


def test_branches_partition_the_input(spark):
    df = from_rows(spark, G3 + [None, "world spark", "spark world"])
    tagged = {r.line: r.tag for r in line_routing(df).collect()}
    parts = line_branches(df)
    assert set(parts) == {"world", "spark", "flink"}
    seen = []
    for tag, frame in parts.items():
        for r in frame.collect():
            assert tagged[r.line] == tag
            seen.append(r.line)
    assert sorted(seen, key=lambda v: natural((v,))) == sorted(tagged, key=lambda v: natural((v,)))


def test_branch_filter_reaches_parquet_scan(spark, scratch):
    path = f"{scratch}/lines"
    from_rows(spark, G3).write.parquet(path)
    df = spark.read.parquet(path)
    plan = branches(df, "line", [("world", "world")], "rest")["world"]._jdf.queryExecution().executedPlan().toString()
    assert "StringEndsWith(line,world)" in plan


def test_write_branches_one_pass_and_pruned_read(spark, scratch):
    df = line_routing(from_rows(spark, G3))
    write_branches(df, scratch)
    back = spark.read.parquet(scratch)
    assert rows(back.groupBy("tag").agg(F.count("*").alias("n"))) == [("flink", 1), ("spark", 1), ("world", 1)]
    one = back.filter(F.col("tag") == "spark")
    assert "PartitionFilters: [isnotnull(tag" in one._jdf.queryExecution().executedPlan().toString()
    assert [r.line for r in one.collect()] == ["hello flink spark"]


def test_written_branches_read_only_their_folder(spark, scratch):
    parts = line_branches_written(from_rows(spark, G3 + ["x world"]), scratch)
    assert {t: sorted(r.line for r in f.collect()) for t, f in parts.items()} == {
        "world": ["hello world", "x world"],
        "spark": ["hello flink spark"],
        "flink": ["hello flink"],
    }
    plan = parts["spark"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tag" in plan and "(tag#" in plan and "= spark)" in plan


def test_written_branches_of_empty_input(spark, scratch):
    parts = line_branches_written(from_rows(spark, [], "line string"), scratch)
    assert {t: f.count() for t, f in parts.items()} == {"world": 0, "spark": 0, "flink": 0}


def test_every_output_gets_its_own_step_in_one_pass(spark, scratch):
    df = from_rows(spark, G3 + ["x world"])
    steps = {"world": lambda rows_: rows_.select(F.upper("line").alias("line"))}
    done = line_branch_steps(df, scratch, steps)
    plain = line_branches(df)
    assert set(done) == set(plain)
    assert rows(done["world"], "line") == sorted((r.line.upper(),) for r in plain["world"].collect())
    for tag in set(plain) - {"world"}:
        assert rows(done[tag], "line") == rows(plain[tag], "line")
    with pytest.raises(ValueError):
        line_branch_steps(df, f"{scratch}-2", {"nowhere": lambda x: x})
