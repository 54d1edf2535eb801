"""The awkward corpus that the tests of this folder share."""

from __future__ import annotations

import random

import pytest

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "re", "sa", "to", "vi") for b in ("ra", "le", "ni", "mo", "tu", "s", "")]
# more columns, named like those that operators add on their way
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "key string, bucket int, position int, size int, block int, id int, row string, anchor int, label string, score int, h int"
)
EXTRA = ("k", 1, 2, 3, 4, 5, "r", 6, "l", 7, 8)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", ".", ".\n"]) for _ in range(n))


def corpus() -> list[tuple]:
    """Small rows with every awkward case: nulls, empty and blank texts, copies, near copies, ties, repeated rows, a long text."""
    base, passage = prose(1, 120), prose(2, 60)
    words = base.split(" ")
    near = " ".join([*words[:50], "changed", *words[51:]])
    rows = [(i, prose(100 + i, 20 + 3 * i), "xa" if i % 2 else "xb", f"s{i % 3}") for i in range(12)]
    rows += [
        (20, base, "xa", "s0"), (21, base, "xa", "s1"), (22, near, "xa", "s0"), (23, base.replace(" ", "\t", 3), "xb", "s2"),
        (24, None, "xa", "s0"), (25, "", None, None), (26, " \t\n", "xb", "s1"), (27, "one two", "xa", None),
        (28, prose(3, 40) + " " + passage, "xb", "s0"), (29, passage + " " + prose(4, 40), "xb", "s1"),
        (30, "aaaa " * 300, "xa", "s0"), (31, prose(5, 12_000), "xa", "s0"), (32, "é日本 \U0001f600 password = hunter2hunter2", "xb", "s2"),
        (33, "AKIA" + "ABCDEFGH" * 3 + " " + "0123456789abcdef" * 3 + " token:abc", "xa", "s1"),
        (34, "x", "xa", "s0"), (34, "x", "xa", "s0"), (35, "tie", "xa", "s0"), (35, "tied", "xb", "s0"), (None, "no id at all here", "xa", "s0"),
        (36, "Straße\r\nline two\x0b\x0c end", "xb", "s2"), (37, "  odd spaces　here", "xa", "s2"),
    ]
    return rows


@pytest.fixture(scope="session")
def docs_dir(spark, tmp_path_factory):
    """The awkward corpus as ``documents`` and labels for some of it."""
    path = str(tmp_path_factory.mktemp("llm"))
    rows = [(*r, len(r[1] or ""), *EXTRA) for r in corpus()]
    spark.createDataFrame(rows, SCHEMA).repartition(3, "doc_id").write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 5 > 0), 0) for i in range(36)] + [(None, 1, 0), (5, None, 0), (3, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="session")
def docs(spark, docs_dir):
    return spark.read.parquet(f"{docs_dir}/documents.parquet")


@pytest.fixture(scope="session")
def empty_dir(spark, docs_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm-empty"))
    for name in ("documents", "labels"):
        spark.read.parquet(f"{docs_dir}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture(scope="session")
def table(docs):
    """``(doc_id, text)`` of every row as Python values, in no order."""
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
