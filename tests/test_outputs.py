"""User functions with several outputs (R1, U1): tagged rows, one pass, a schema per output."""

from __future__ import annotations

import pandas as pd
import pytest
from conftest import rows
from pyspark.errors import PythonException

from tallyloom.functions import map_outputs, output
from tallyloom.plans import outputs_written
from tallyloom.sources import from_rows

SCHEMAS = {"words": "line string, word string", "sizes": "n int", "empty": "line string, at array<int>"}


def splitter():
    def parts(batch: pd.DataFrame) -> dict[str, pd.DataFrame]:
        """Any number of words per line, one size, and the lines without words."""
        found = [(line, (line or "").split()) for line in batch["line"]]
        return {
            "words": pd.DataFrame([(line, w) for line, own in found for w in own], columns=["line", "word"]),
            "sizes": pd.DataFrame({"n": [len(own) for _, own in found]}),
            "empty": pd.DataFrame([(line, [0, 1]) for line, own in found if not own], columns=["line", "at"]),
        }

    return parts


LINES = [("a b",), ("",), (None,), ("a",), ("é  x y",)]
EXPECTED = {
    "words": [("a", "a"), ("a b", "a"), ("a b", "b"), ("é  x y", "x"), ("é  x y", "y"), ("é  x y", "é")],
    "sizes": [(0,), (0,), (1,), (2,), (3,)],
    "empty": [("", [0, 1]), (None, [0, 1])],
}


@pytest.mark.parametrize("name", SCHEMAS)
def test_every_output_has_its_rows_and_columns(spark, name):
    tagged = map_outputs(from_rows(spark, LINES, "line string"), splitter(), SCHEMAS)
    assert tagged.columns == ["tag", *SCHEMAS]
    assert rows(output(tagged, name)) == EXPECTED[name]


def test_outputs_are_written_in_one_pass_and_read_apart(spark, scratch):
    seen = spark.sparkContext.accumulator(0)

    parts = splitter()

    def counted(batch):
        seen.add(len(batch))
        return parts(batch)

    found = outputs_written(from_rows(spark, LINES, "line string"), scratch, counted, SCHEMAS)
    assert {name: rows(df) for name, df in found.items()} == EXPECTED
    assert seen.value == len(LINES)  # however many outputs are read
    plan = found["sizes"]._jdf.queryExecution().executedPlan().toString()
    assert "tag=sizes" in plan.replace(" ", "") or "PartitionFilters: [isnotnull(tag" in plan
    assert "words:struct" not in plan and "sizes:struct" in plan


def test_outputs_left_out_and_empty_inputs(spark, scratch):
    only = lambda batch: {"sizes": pd.DataFrame({"n": [1] * len(batch)}), "words": None}
    found = outputs_written(from_rows(spark, LINES, "line string"), f"{scratch}/a", only, SCHEMAS)
    assert [found[name].count() for name in SCHEMAS] == [0, 5, 0]
    none = outputs_written(from_rows(spark, LINES, "line string").limit(0), f"{scratch}/b", splitter(), SCHEMAS)
    assert [none[name].count() for name in SCHEMAS] == [0, 0, 0]
    assert none["empty"].dtypes == [("line", "string"), ("at", "array<int>")]


def test_an_unknown_output_fails(spark):
    wrong = lambda batch: {"other": pd.DataFrame({"n": [1]})}
    with pytest.raises(PythonException, match="no output is named"):
        map_outputs(from_rows(spark, LINES, "line string"), wrong, SCHEMAS).collect()
    with pytest.raises(ValueError, match="tag column"):
        map_outputs(from_rows(spark, LINES, "line string"), splitter(), {"tag": "n int"})


def test_nulls_inside_an_output_stay_null(spark):
    some = lambda batch: {"sizes": pd.DataFrame({"n": [None] * len(batch)}, dtype=object)}
    tagged = map_outputs(from_rows(spark, LINES, "line string"), some, SCHEMAS)
    assert rows(output(tagged, "sizes")) == [(None,)] * 5
