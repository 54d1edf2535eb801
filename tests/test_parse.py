"""Integer parsing, projections and the per-batch user function (P3-P6, U1; E11-E13, E18)."""

from __future__ import annotations

import pandas as pd
import pytest
from conftest import rows
from pyspark.errors import PySparkException

from tallyloom.functions import map_rows
from tallyloom.operators import key_value, nth_column, pair_text, parse_int, parse_int_rejects
from tallyloom.sources import from_rows

BAD = [None, "x", "", "1.5", "2147483648", " 5 ", "1e3", "0x1", "5L", "5\n", "5\r\n", "\n5"]


@pytest.mark.parametrize("text", BAD)
def test_strict_parse_raises(spark, text):
    df = from_rows(spark, [text], "value string")
    with pytest.raises(PySparkException):
        parse_int(df).collect()


@pytest.mark.parametrize("text,expected", [("5", 5), ("+5", 5), ("-7", -7), ("2147483647", 2147483647), ("007", 7)])
def test_strict_parse_accepts_java_ints(spark, text, expected):
    df = from_rows(spark, [text], "value string")
    assert parse_int(df).collect()[0].value == expected


def test_tolerant_parse(spark):
    df = from_rows(spark, [None, "x", "", "1.5", "2147483648", " 5 ", "+5"], "value string")
    got = [r.value for r in parse_int(df, strict=False).collect()]
    assert got == [None, None, None, None, None, 5, 5]
    assert parse_int_rejects(df).count() == 5


def test_key_value_drops_metadata(spark):
    df = from_rows(spark, [("k", "1", 0, "t")], "key string, value string, partition int, topic string")
    assert key_value(df).columns == ["key", "value"]


def test_nth_column_as_text_keeps_null(spark):
    df = from_rows(spark, [("x", 1), (None, 2)], "c0 string, c1 int")
    assert [r.first_col for r in nth_column(df).collect()] == ["x", None]
    assert [r.first_col for r in nth_column(df, 1).collect()] == ["1", "2"]
    assert nth_column(df, keep_record=True).columns == ["c0", "c1", "first_col"]


def test_pair_text(spark):
    df = from_rows(spark, [("hello", 3)], "key string, value long")
    assert pair_text(df).collect()[0].kv == "KV{hello, 3}"


def test_map_rows_zero_to_many_outputs(spark):
    df = from_rows(spark, ["a b", "", "c"], "line string")

    def explode_words(batch: pd.DataFrame) -> pd.DataFrame:
        w = batch["line"].str.split(" ").explode()
        return pd.DataFrame({"word": w[w != ""]})

    assert rows(map_rows(df, explode_words, "word string")) == [("a",), ("b",), ("c",)]


def test_strict_parse_raises_without_ansi_mode(spark):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException):
            parse_int(from_rows(spark, ["x"], "value string")).collect()
        assert parse_int(from_rows(spark, ["x"], "value string"), strict=False).collect()[0].value is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
