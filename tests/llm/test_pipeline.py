"""The pipeline's stages on the awkward corpus and on given tables, and its registration."""

from __future__ import annotations

from collections import Counter

import pytest
from oracle import compare, duck

import __spark_entry__ as entry
import corpus_pipeline
from awkward import docs, docs_dir, empty_dir  # noqa: F401  (fixtures)

from tallyloom.llm import exact_dedup, minhash, mixing, quality, queries
from tallyloom.session import staging_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage over the given tables."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = staging_path(spark, f"test-{name}")
        stage(spark, docs, SF).write.parquet(path)
        out.append((docs, docs := spark.read.parquet(path)))
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_the_columns(stages):
    for before, after in stages[:-1]:
        assert after.dtypes == before.dtypes


def test_quality_stage(spark, stages):
    before, after = stages[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = quality.quality(before, labels).filter("predicted = 1")
    assert ids(after) == ids(good)
    clean = before.join(labels.filter("quality = 1"), "doc_id")
    assert clean.join(after, "doc_id", "left_anti").count() <= 0.02 * clean.count()


def test_dedup_stages(stages):
    for (before, after), found in ((stages[1], exact_dedup.exact_dedup(stages[1][0])), (stages[2], minhash.near_dedup(stages[2][0]))):
        assert ids(after) == ids(found.filter("kept"))


def test_mixing_stage(stages):
    before, after = stages[3]
    taken = {r.doc_id: (r.taken, r["size"]) for r in mixing.mix(before).collect()}
    assert ids(after) == Counter({i: int(t / n + 0.5) for i, (t, n) in taken.items() if n and int(t / n + 0.5)})


def test_bpe_stage_and_run(spark, stages):
    before, after = stages[4]
    assert ids(after) == ids(before) and after.filter("NOT round_trip").count() == 0
    run = corpus_pipeline.run(spark, SF)
    assert Counter((r.doc_id, r.n_tokens) for r in run.collect()) == Counter((r.doc_id, r.n_tokens) for r in after.collect())


def test_awkward_and_empty_tables(spark, docs_dir, empty_dir):
    assert corpus_pipeline.run(spark, docs_dir).filter("NOT round_trip").count() == 0
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


def test_repeated_rows_leave_one(spark, docs):
    assert ids(exact_dedup.keep_first(docs))[34] == 1


def test_registration():
    names = entry.queries()
    assert "pipeline" in names and "pipeline" not in entry.oracle_sql()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracles(spark, name):
    ok, msg = compare(entry.queries()[name](spark, SF), duck(SF), entry.oracle_sql()[name])
    assert ok, msg
