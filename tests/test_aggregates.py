"""Counts, sums and the JDBC job's transform (A1, A3, A4, P2, P7, F1; E4, E7, E9, E15, E17)."""

from __future__ import annotations

import pytest
from conftest import natural, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.operators import count_per_element, key_ones, not_null, scale, sum_all, sum_per_key
from tallyloom.plans import name_counts
from tallyloom.sources import from_rows


def test_count_per_element_counts_null_as_element(spark):
    df = from_rows(spark, ["a", "b", "a", None], "word string")
    assert rows(count_per_element(df)) == sorted([("a", 2), ("b", 1), (None, 1)], key=natural)


def test_key_ones_by_position(spark):
    df = from_rows(spark, [("1", "a"), ("2", "b")], "id string, name string")
    assert rows(key_ones(df, 1)) == [("a", 1), ("b", 1)]


def test_sum_per_key_with_factor(spark):
    df = from_rows(spark, [("a", 1), ("a", 1), ("b", 1)], "key string, value int")
    out = sum_per_key(df, factor=10)
    assert rows(out) == [("a", 20), ("b", 10)]
    assert dict(out.dtypes)["value"] == "bigint"


def test_sum_per_key_is_64_bit(spark):
    big = 2_000_000_000
    df = from_rows(spark, [("a", big), ("a", big)], "key string, value int")
    assert rows(sum_per_key(df)) == [("a", 2 * big)]


def test_sum_overflow_raises_under_ansi(spark):
    df = from_rows(spark, [("a", 2**62), ("a", 2**62)], "key string, value long")
    with pytest.raises(PySparkException):
        sum_per_key(df, factor=10).collect()


def test_sum_all_empty_is_zero(spark):
    df = from_rows(spark, [], "value int")
    assert sum_all(df).collect()[0].s == 0


def test_sum_all(spark):
    df = from_rows(spark, [(1,), (2,), (None,)], "value int")
    out = sum_all(df)
    assert out.collect()[0].s == 3 and dict(out.dtypes)["s"] == "bigint"


def test_scale_and_not_null(spark):
    df = from_rows(spark, [("a", 2), (None, 3), ("c", None)], "key string, value int")
    assert rows(scale(not_null(df), "value", 10)) == [("a", 20)]
    assert rows(not_null(df, ["key"]), "key") == [("a",), ("c",)]


def test_g4_name_counts(spark):
    df = from_rows(spark, [("1", "a"), ("2", "a"), ("3", "b"), ("4", None)], "id string, name string")
    counts, obs = name_counts(df, 1)
    got = rows(counts)
    assert got == [("a", "20"), ("b", "10")]
    assert dict(counts.dtypes)["count"] == "string"
    assert obs.get["null_names"] == 1 and obs.get["rows"] == 4


def test_partial_aggregation_in_plan(spark):
    df = from_rows(spark, ["a", "b"], "word string")
    plan = count_per_element(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_no_python_in_builtin_plans(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = sum_per_key(key_ones(df, "event_type"), factor=10).withColumn("x", F.col("value") + 1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_sums_keep_fractions(spark):
    from tallyloom.streaming import tumbling_sum

    df = from_rows(spark, [(1.25,), (2.5,)], "value double")
    assert sum_all(df).collect()[0].s == 3.75
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = tumbling_sum(ev, "ts", "value")
    assert dict(out.dtypes)["s"] == "double"
    assert abs(out.agg(F.sum("s")).first()[0] - ev.agg(F.sum("value")).first()[0]) < 1e-6
