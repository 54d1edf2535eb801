"""Assertions on the final physical plans of the registered queries."""

from __future__ import annotations

import re

import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry
from tallyloom.plans import registry

SHUFFLE = re.compile(r"Exchange (hashpartitioning|RoundRobinPartitioning|SinglePartition|rangepartitioning)")


def final_plan(spark, name: str) -> str:
    df = entry.queries()[name](spark, SF_SMALL)
    df.collect()  # the adaptive plan is final only after execution
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def shuffles(plan: str) -> int:
    """Exchanges the plan computes (a reused exchange is not computed again)."""
    return sum(len(SHUFFLE.findall(line)) for line in plan.splitlines() if "ReusedExchange" not in line)


@pytest.mark.parametrize("name", ["count_per_element", "sum_per_key_x10", "jdbc_counts", "tumbling_sum", "sum_all"])
def test_aggregates_are_two_phase_with_one_shuffle(spark, name):
    plan = final_plan(spark, name)
    assert re.search(r"partial_(count|sum)", plan)
    assert shuffles(plan) == 1


def test_word_count_partial_aggregate_after_split(spark):
    plan = final_plan(spark, "word_count")
    assert "partial_count" in plan and "Generate explode" in plan
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize(
    "name,most", [("group_values", 3), ("cogroup", 3), ("group_values_hot", 4), ("cogroup_hot", 4)]
)
def test_bounded_grouping_plan(spark, name, most):
    plan = final_plan(spark, name)
    # totals of keys above the chunk size, rows by (key, salt), the query's own
    # fold of the lists, and the collapse of duplicates where there are any
    assert 2 <= shuffles(plan) <= most
    assert "collect_list" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["route", "branch_bolt", "parse_int", "nth_column", "catalog_read"])
def test_row_level_queries_do_not_shuffle(spark, name):
    assert shuffles(final_plan(spark, name)) == 0


@pytest.mark.parametrize("name", [n for n in sorted(registry.queries()) if n != "map_rows"])
def test_no_python_in_builtin_queries(spark, name):
    plan = final_plan(spark, name)
    assert not re.search(r"MapInPandas|ArrowEvalPython|BatchEvalPython|PythonUDF", plan)


def test_map_rows_runs_python_per_batch(spark):
    assert "MapInPandas" in final_plan(spark, "map_rows")


def test_scans_read_only_used_columns(spark):
    assert "ReadSchema: struct<event_id:bigint>" in final_plan(spark, "nth_column")
    assert "ReadSchema: struct<o_orderpriority:string>" in final_plan(spark, "sum_per_key_x10")
    assert "ReadSchema: struct<text:string>" in final_plan(spark, "word_count")


def test_branch_counts_scan_once(spark):
    plan = final_plan(spark, "branches")
    assert plan.count("FileScan parquet") == 1


def test_cogroup_of_word_counts_adds_no_shuffle(spark):
    # Two word counts, one shuffle each.  Both come out hash-partitioned by
    # word, the union keeps that partitioning, and the co-group by word needs
    # no exchange of its own.
    assert shuffles(final_plan(spark, "cogroup_words")) == 2


def test_single_branch_filter_pushed_to_parquet(spark):
    plan = final_plan(spark, "branch_bolt")
    assert "PushedFilters: [IsNotNull(p_name), StringEndsWith(p_name,bolt)]" in plan
    assert shuffles(plan) == 0


def test_bucketed_tables_are_grouped_and_cogrouped_without_a_shuffle(spark):
    plan = final_plan(spark, "bucketed_cogroup")
    assert shuffles(plan) == 0 and plan.count("Bucketed: true") == 2


def test_grouping_shuffles_its_rows_once(spark):
    """Besides sketches, counted repeats and the query's own fold, rows move by (key, salt) alone."""
    plan = final_plan(spark, "group_values_hot")
    by_salt = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "_tl_salt" in line]
    assert len(by_salt) == 1
    assert "approx_top_k" in plan and "SortMergeJoin" not in plan
