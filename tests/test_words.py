"""Word splitting and word counts (P1, A1, Q1; edge rules E1-E3)."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.operators import count_per_element, lines, text_words, words
from tallyloom.plans import word_count, word_count_text
from tallyloom.sources import from_rows

# Java split(" ") results for single lines (one space separates; trailing
# empty pieces dropped; leading and inner ones kept; tabs do not split).
EDGE_LINES = [
    ("a b ", ["a", "b"]),
    ("a  b", ["a", "", "b"]),
    ("  a", ["", "", "a"]),
    ("", [""]),
    (" ", []),
    ("   ", []),
    ("a\tb", ["a\tb"]),
    ("  \u2028", ["", "", "\u2028"]),
    ("  \u0085", ["", "", "\u0085"]),
    ("  \n", ["", "", "\n"]),
    (None, []),
]


@pytest.mark.parametrize("line,expected", EDGE_LINES)
def test_edge_lines(spark, line, expected):
    df = from_rows(spark, [line])
    got = [r.word for r in words(df).collect()]
    assert sorted(got) == sorted(expected)


def test_edge_lines_keep_order(spark):
    df = from_rows(spark, ["  a b  c  "]).select(F.posexplode(F.split(F.rtrim("line"), " ")))
    assert [r.col for r in df.orderBy("pos").collect()] == ["", "", "a", "b", "", "c"]


def test_drop_empty(spark):
    df = from_rows(spark, ["a  b", "", " x"])
    assert sorted(r.word for r in words(df, drop_empty=True).collect()) == ["a", "b", "x"]


def test_case_and_punctuation_untouched(spark):
    df = from_rows(spark, ["Hello hello, HELLO"])
    assert rows(count_per_element(words(df), "word", "n")) == [("HELLO", 1), ("Hello", 1), ("hello,", 1)]


def test_g1_word_count(spark):
    df = from_rows(spark, ["hello world", "hello flink", "hello flink spark"])
    got = rows(word_count(df))
    assert got == sorted([("hello", 3), ("flink", 2), ("world", 1), ("spark", 1)], key=repr)
    assert dict(word_count(df).dtypes)["n"] == "bigint"


def test_lines_split_all_separators(spark):
    df = from_rows(spark, ["a\nb\r\nc\rd", "e"], "text string")
    assert sorted(r.line for r in lines(df).collect()) == ["a", "b", "c", "d", "e"]


def test_text_words_matches_line_then_word(spark):
    df = from_rows(spark, ["x y\n\n z \n  ", "p"], "text string")
    # lines: "x y", "", " z ", "  "  -> words x, y, "", "", z ; "p" -> p
    assert sorted(r.word for r in text_words(df).collect()) == sorted(["x", "y", "", "", "z", "p"])


def test_word_count_text_on_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counts = word_count_text(docs)
    total = counts.agg(F.sum("n")).first()[0]
    direct = text_words(docs).count()
    assert total == direct > 0


def test_word_count_text_is_one_exchange(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = word_count_text(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
