"""Every registered query equals its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SF_SMALL
from oracle import TABLES, compare, duck

import __spark_entry__ as entry
from tallyloom.plans import registry
from tallyloom.session import staging_path

NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(registry.oracle_sql()) == set(NAMES) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "n"] and df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    ok, msg = compare(df, con, entry.oracle_sql()[name])
    assert ok, msg


@pytest.fixture(scope="module")
def empty_dir(spark):
    """Empty copies (same schemas, no rows) of every driver table."""
    path = staging_path(spark, "empty-tables")
    for t in TABLES:
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0).coalesce(1).write.parquet(f"{path}/{t}.parquet")
    return path


@pytest.fixture(scope="module")
def empty_con(empty_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{empty_dir}/{t}.parquet/*.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_on_empty_tables(spark, empty_dir, empty_con, name):
    ok, msg = compare(entry.queries()[name](spark, empty_dir), empty_con, entry.oracle_sql()[name])
    assert ok, msg


def test_an_ungrouped_table_does_not_pass(spark, con):
    for name in ("group_values", "group_values_hot", "cogroup", "cogroup_hot"):
        tables = {"group_values": "customer", "cogroup": "customer"}
        df = spark.read.parquet(f"{SF_SMALL}/{tables.get(name, 'lineitem')}.parquet")
        assert not compare(df, con, entry.oracle_sql()[name])[0]


def test_text_word_count_sees_a_grown_table(spark, scratch):
    docs = f"{scratch}/documents.parquet"
    one = spark.createDataFrame([("a b", "x")], "text string, lang string")
    one.write.partitionBy("lang").parquet(docs)
    before = {r.word: r.n for r in registry.q_text_word_count(spark, scratch).collect()}
    one.write.mode("append").partitionBy("lang").parquet(docs)
    after = {r.word: r.n for r in registry.q_text_word_count(spark, scratch).collect()}
    assert before == {"a": 1, "b": 1} and after == {"a": 2, "b": 2}


def test_catalog_read_leaves_no_table(spark):
    registry.q_catalog_read(spark, SF_SMALL).count()
    assert not spark.catalog.listTables("tallyloom_runs")
