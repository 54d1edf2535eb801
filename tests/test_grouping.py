"""Group values and co-group in bounded chunks (A2, J1, Q2; E6, E10)."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import natural, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.operators import cogroup, cogroup_stored, fold_repeats, fold_sum, group_values, sum_per_key
from tallyloom.plans import word_cogroup
from tallyloom.sources import from_rows, read_stream_files


def test_g2_word_cogroup(spark):
    a = from_rows(spark, ["Ahello Aworld", "Ahello Aflink", "Ahello Aflink spark"])
    b = from_rows(spark, ["Bhello Aworld", "Bhello Aflink", "Bhello Aflink spark"])
    out = word_cogroup({"a": a, "b": b})
    got = {r.word: (r.chunk, list(r.a), list(r.b)) for r in out.collect()}
    assert got == {
        "Ahello": (0, [3], []),
        "Bhello": (0, [], [3]),
        "Aworld": (0, [1], [1]),
        "Aflink": (0, [2], [2]),
        "spark": (0, [1], [1]),
    }


def test_cogroup_missing_side_is_empty_list_not_null(spark):
    a = from_rows(spark, [("x", 1)], "key string, value int")
    b = from_rows(spark, [("y", 2)], "key string, value int")
    out = {r.key: (r.a, r.b) for r in cogroup({"a": a, "b": b}).collect()}
    assert out == {"x": ([1], []), "y": ([], [2])}


def test_cogroup_three_inputs_no_cross_product(spark):
    a = from_rows(spark, [("k", 1), ("k", 2)], "key string, value int")
    b = from_rows(spark, [("k", 3), ("k", 4)], "key string, value int")
    c = from_rows(spark, [("k", 5)], "key string, value int")
    out = cogroup({"a": a, "b": b, "c": c}, sort_values=True).collect()
    assert [(r.a, r.b, r.c) for r in out] == [([1, 2], [3, 4], [5])]


def test_group_values_keeps_duplicates_and_drops_nulls(spark):
    df = from_rows(spark, [("k", 1), ("k", 1), ("k", None), ("n", None)], "key string, value int")
    out = {r.key: sorted(r.values) for r in group_values(df).collect()}
    assert out == {"k": [1, 1], "n": []}


def test_group_values_keep_nulls(spark):
    df = from_rows(spark, [("k", 1), ("k", None)], "key string, value int")
    out = group_values(df, keep_nulls=True).collect()
    assert sorted(out[0]["values"], key=lambda v: natural((v,))) == [1, None]


def test_group_values_null_key_is_a_group(spark):
    df = from_rows(spark, [(None, 1), (None, 2)], "key string, value int")
    assert rows(group_values(df, sort_values=True), "key", "values") == [(None, [1, 2])]


def test_hot_key_is_split_into_bounded_chunks(spark):
    # One key holds most rows; every value must come back exactly once and
    # no chunk may hold the whole group.
    hot = spark.range(0, 5000).select(F.lit("hot").alias("key"), F.col("id").alias("value"))
    cold = spark.range(0, 30).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("key"), F.col("id").alias("value"))
    out = group_values(hot.unionByName(cold), chunk_size=500).collect()
    hot_chunks = [r for r in out if r.key == "hot"]
    assert len(hot_chunks) >= 5
    assert max(len(r["values"]) for r in hot_chunks) <= 500
    assert Counter(v for r in hot_chunks for v in r["values"]) == Counter(range(5000))
    assert all(r.chunk == 0 and len(r["values"]) == 1 for r in out if r.key != "hot")


def test_hot_identical_values_are_split(spark):
    # 10,000 identical (key, value) rows: the duplicate collapse turns them
    # into one row with multiplicity, then pieces of at most chunk_size.
    df = spark.range(0, 10_000).select(F.lit("k").alias("key"), F.lit(1).alias("value"))
    out = group_values(df, chunk_size=1000).collect()
    sizes = [len(r["values"]) for r in out]
    assert sum(sizes) == 10_000 and sizes == [1000] * 10


def test_chunks_are_deterministic(spark):
    df = spark.range(0, 3000).select((F.col("id") % 3).alias("key"), F.col("id").alias("value"))
    first = rows(group_values(df, chunk_size=100, sort_values=True))
    second = rows(group_values(df.repartition(7), chunk_size=100, sort_values=True))
    assert first == second


def test_cogroup_hot_key_across_inputs(spark):
    # One key holds a third of each input; its lists are split, nothing lost.
    a = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"), F.col("id").alias("value"))
    b = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 1, "hot").otherwise(F.col("id").cast("string")).alias("key"), (-F.col("id")).alias("value"))
    out = cogroup({"a": a, "b": b}, chunk_size=200).collect()
    hot = [r for r in out if r.key == "hot"]
    assert len(hot) >= 5 and max(len(r.a) + len(r.b) for r in hot) <= 200
    assert sorted(v for r in hot for v in r.a) == list(range(0, 3000, 3))
    assert sorted(-v for r in hot for v in r.b) == list(range(1, 3000, 3))
    assert sum(len(r.a) for r in out) == 3000 and sum(len(r.b) for r in out) == 3000


def test_hot_keys_of_real_table_are_balanced(spark):
    # Each return flag holds a third of lineitem.
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    pairs = li.select(F.col("l_returnflag").alias("key"), F.col("l_orderkey").alias("value"))
    sizes = group_values(pairs, chunk_size=100).select("key", F.size("values").alias("n")).collect()
    per_key = Counter(r.key for r in sizes)
    assert all(c >= 15 for c in per_key.values())
    assert max(r.n for r in sizes) <= 100
    assert sum(r.n for r in sizes) == li.count()


def test_cogroup_unique_keys_single_shuffle(spark):
    a = from_rows(spark, [("x", 1), ("y", None)], "key string, value int")
    b = from_rows(spark, [("y", 2)], "key string, value int")
    out = cogroup({"a": a, "b": b}, unique_keys=True)
    assert {r.key: (r.chunk, r.a, r.b) for r in out.collect()} == {"x": (0, [1], []), "y": (0, [], [2])}
    kept = cogroup({"a": a, "b": b}, unique_keys=True, keep_nulls=True)
    assert {r.key: r.a for r in kept.collect()} == {"x": [1], "y": [None]}
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1


def test_cogroup_rejects_tag_equal_to_key(spark):
    a = from_rows(spark, [("x", 1)], "key string, value int")
    with pytest.raises(ValueError):
        cogroup({"key": a})


def test_distinct_values_path_gives_the_same_groups(spark):
    df = spark.range(0, 3000).select((F.col("id") % 4).alias("key"), F.col("id").alias("value"))
    plain = rows(group_values(df, chunk_size=100, sort_values=True).select("key", F.explode("values").alias("v")))
    fast = rows(group_values(df, chunk_size=100, distinct_values=True).select("key", F.explode("values").alias("v")))
    assert plain == fast and len(fast) == 3000
    sizes = [len(r["values"]) for r in group_values(df, chunk_size=100, distinct_values=True).collect()]
    assert max(sizes) <= 100 and len(sizes) >= 28


def test_distinct_values_with_some_repeats_is_still_exact(spark):
    df = from_rows(spark, [("k", 1), ("k", 1), ("k", 2), ("j", None)], "key string, value int")
    out = {r.key: sorted(r["values"]) for r in group_values(df, distinct_values=True).collect()}
    assert out == {"k": [1, 1, 2], "j": []}
    a = from_rows(spark, [("x", 1), ("x", 1)], "key string, value int")
    b = from_rows(spark, [("x", 2)], "key string, value int")
    got = cogroup({"a": a, "b": b}, distinct_values=True).collect()
    assert [(sorted(r.a), r.b) for r in got] == [([1, 1], [2])]


def test_grouping_refuses_streams(spark, scratch):
    from_rows(spark, [("k", 1)], "key string, value int").write.parquet(scratch)
    with pytest.raises(ValueError):
        group_values(read_stream_files(spark, scratch, "key string, value int"))


def test_fold_sum_of_chunked_lists_equals_sum_per_key(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("key"), (F.col("id") % 7).cast("int").alias("value"))
    folded = fold_sum(group_values(df, chunk_size=200), factor=10)
    assert rows(folded) == rows(sum_per_key(df, factor=10))


def test_folding_repeats_equals_sum_per_key(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("key"), (F.col("id") % 7).cast("int").alias("value"))
    assert rows(fold_repeats(df, factor=10)) == rows(sum_per_key(df, factor=10))


def test_nothing_runs_before_the_action(spark):
    sc = spark.sparkContext
    upstream = spark.range(0, 1000).groupBy((F.col("id") % 10).alias("key")).agg(F.max("id").alias("value"))
    sc.setJobGroup("tallyloom-build", "build only")
    group_values(upstream, chunk_size=2)
    cogroup({"a": upstream, "b": upstream}, chunk_size=2)
    assert not sc.statusTracker().getJobIdsForGroup("tallyloom-build")
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_keys_that_change_between_evaluations_lose_no_row(spark):
    df = spark.range(0, 1000).select((F.rand() * 1e9).cast("long").alias("key"), F.col("id").alias("value"))
    out = group_values(df, chunk_size=10).select(F.explode("values").alias("v"))
    assert sorted(r.v for r in out.collect()) == list(range(1000))


def test_chunk_size_is_a_hard_bound(spark):
    # 2,000 values of 100 copies each
    df = spark.range(0, 200_000).select(F.lit("k").alias("key"), (F.col("id") % 2000).alias("value"))
    out = group_values(df, chunk_size=100)
    sizes = [r.n for r in out.select(F.size("values").alias("n")).collect()]
    assert max(sizes) <= 100 and sum(sizes) == 200_000
    assert out.select("key", "chunk").distinct().count() == len(sizes)
    many = group_values(df, chunk_size=130).select(F.size("values").alias("n")).collect()
    assert max(r.n for r in many) <= 130 and sum(r.n for r in many) == 200_000


def test_a_false_distinct_claim_keeps_the_bound(spark):
    df = spark.range(0, 10_000).select(F.lit("k").alias("key"), F.lit(1).alias("value"))
    sizes = [len(r["values"]) for r in group_values(df, chunk_size=100, distinct_values=True).collect()]
    assert max(sizes) <= 100 and sum(sizes) == 10_000


def test_a_false_unique_claim_fails(spark):
    a = from_rows(spark, [("x", 1), ("x", 2)], "key string, value int")
    with pytest.raises(PySparkException):
        cogroup({"a": a}, unique_keys=True).collect()


def test_more_copies_than_one_block_of_lists(spark):
    # 3,000 lists of one value are made from one collapsed row, at most 1024 rows per level
    df = spark.range(0, 3001).select(F.lit("k").alias("key"), F.lit(7).alias("value"))
    out = group_values(df, chunk_size=1)
    assert out.count() == 3001 and out.select("chunk").distinct().count() == 3001


def test_cogroup_of_stored_tables_is_the_cogroup(spark):
    a = from_rows(spark, [("x", 1), ("y", None)], "key string, value int")
    b = from_rows(spark, [("y", 2), ("z", 4)], "key string, value int")
    plain = rows(cogroup({"a": a, "b": b}), "key", "a", "b")
    assert rows(cogroup_stored(a, b, "key", "value", ["a", "b"]), "key", "a", "b") == plain
    assert plain == [("x", [1], []), ("y", [], [2]), ("z", [], [4])]
    null = from_rows(spark, [(None, 3)], "key string, value int")
    assert rows(cogroup_stored(null, null, "key", "value", ["a", "b"]), "a", "b") == [([], [3]), ([3], [])]
