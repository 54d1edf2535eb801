"""That results come by the operators' methods: each test fails if the part it names is taken away."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from awkward import docs, docs_dir, prose  # noqa: F401  (fixtures)

from tallyloom.llm import common, fingerprint, mixing, secret_scan

TREE = "sections array<string>, paragraphs array<array<string>>, phrases array<array<array<string>>>, root string"


def trees(spark, a, b):
    rows = spark.createDataFrame([(a, b)], f"a struct<{TREE}>, b struct<{TREE}>")
    names = ("sections", "paragraphs", "phrases", "root")
    return rows.select(*[F.col(f"{t}.{n}").alias(f"{t}_{n}") for t in "ab" for n in names])


def test_op1_equal_inner_nodes_are_not_looked_into(spark):
    # the nodes of section 0 and of paragraph 1 of section 1 say equal, the phrases below them do not
    a = (["s0", "s1"], [["p0"], ["p1", "p2"]], [[["x", "y"]], [["q"], ["r"]]], "ra")
    b = (["s0", "S1"], [["P0"], ["P1", "p2"]], [[["X", "Y"]], [["Q"], ["R"]]], "rb")
    r = fingerprint.compare(trees(spark, a, b), "a", "b", "d").first()
    assert (r.d_lead_s, r.d_lead_p, r.d_lead_f, r.d_lead) == (1, 0, 0, 2)
    assert (r.d_back_s, r.d_back_p, r.d_back_f, r.d_trail) == (0, 1, 0, 1)
    assert r.d_near == pytest.approx(2 * 3 / (2 * 3 + 2))


@pytest.mark.parametrize(
    "old, new, path, start, end",
    [
        ("a one. b.\nc two. d.\n\ne three. f.", "a one. b.\nc two! d.\n\ne three. f.", [0, 1, 0], 10, 17),
        ("a one. b.\nc two. d.\n\ne three. f.", "a one. b.\nc two. d.\n\ne three. g.", [1, 0, 1], 30, 32),
        ("x. y.", "x. y. z.", [0, 0, 1], 3, 5),
        ("", "x", [0, 0, 0], 0, 0),
    ],
)
def test_op1_the_way_down_locates_the_edit(spark, old, new, path, start, end):
    pair = spark.createDataFrame([(old, new)], "old string, new string")
    r = fingerprint.compare(fingerprint.fingerprints(pair, {"old": "own", "new": "new"}), "own", "new", "edit").first()
    flat = [x for s in r.own_pieces for p in s for x in p]
    assert [r.edit_lead_s, r.edit_lead_p, r.edit_lead_f] == path
    assert len("".join(flat[: r.edit_lead])) == start
    assert len("".join(flat[: len(flat) - r.edit_trail])) == max(start, end)


def test_op1_likeness_of_moved_and_equal_parts(spark):
    base = [prose(k, 60) for k in range(4)]
    texts = {"same": "\n\n".join(base), "moved": "\n\n".join(base[::-1]), "half": "\n\n".join(base[:2] + [prose(9, 60), prose(8, 60)]), "other": prose(7, 240)}
    pairs = spark.createDataFrame([(k, texts["same"], t) for k, t in texts.items()], "k string, old string, new string")
    found = fingerprint.compare(fingerprint.fingerprints(pairs, {"old": "own", "new": "new"}), "own", "new", "edit").collect()
    near = {r.k: r.edit_near for r in found}
    assert near["same"] == 1.0 and 0.6 < near["moved"] < 1 and 0.35 < near["half"] < 0.65 and near["other"] < 0.3


def test_op3_known_pairs_are_not_scanned_again(spark, scratch):
    text = "password = hunter22hunter22 and ghp_" + "a" * 40
    docs = spark.createDataFrame([(1, text), (2, text), (3, "password = other77other")], "doc_id long, text string")
    sets = [secret_scan.BASE, secret_scan.ADDED]
    secret_scan.update_ledger(spark, scratch, docs.filter("doc_id < 3"), sets[:1], new=True)
    # what the ledger says of a known pair stands: the blob is not read again for it
    marked = spark.read.schema(secret_scan.LEDGER).parquet(scratch).withColumn("spans", F.slice("spans", 1, 0))
    common.materialize(marked, "marked").write.parquet(f"{scratch}-marked")
    ledger = secret_scan.update_ledger(spark, f"{scratch}-marked", docs, sets)
    assert ledger.count() == 4  # one known pair and three scanned now
    spans = {r.doc_id: (r[secret_scan.BASE.version], r[secret_scan.ADDED.version]) for r in secret_scan.findings(docs, ledger, sets).collect()}
    assert spans[1] == spans[2] and spans[1][0] == [] and [s.kind for s in spans[1][1]] == ["github"]
    assert [s.kind for s in spans[3][0]] == ["assign"] and spans[3][1] == []
    again = secret_scan.update_ledger(spark, f"{scratch}-marked", docs, sets)
    assert again.count() == 4


def test_op6_every_stretch_of_the_schedule_is_mixed(spark):
    rows = [(i, prose(i, 30), f"s{i % 7 if i % 3 else 0}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = common.materialize(mixing.document_sizes(docs, "doc_id", "text", "source"), "sizes")
    plan = common.materialize(mixing._plan(mixing.source_targets(sizes), sizes.agg(F.sum("size")).first()[0]), "plan")
    slots = [r.position for r in mixing.schedule(plan).orderBy("slot", "position", "rank").collect()]
    quota = {r.position: r.quota for r in plan.collect()}
    seen, worst = Counter(), 0.0
    for n, position in enumerate(slots, 1):
        seen[position] += 1
        worst = max(worst, *(abs(seen[p] - n * q / len(slots)) for p, q in quota.items()))
    assert seen == quota and worst < 6 < max(quota.values()) / 4


def test_op6_the_mix_comes_in_the_order_of_its_slots(spark):
    rows = [(i, prose(i, 30), f"s{i // 150}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4, "source")
    mix = {r.doc_id: r for r in mixing.mix(docs).collect()}
    assert all((r.taken > 0) == bool(r.slots) for r in mix.values())
    assert all(len(r.slots) <= mixing.MAX_REPEAT and r.slots == sorted(r.slots) for r in mix.values())
    order = [r.source for r in mixing.mixed(docs).collect()]
    share = Counter(order)
    for i in range(0, len(order) - 100, 50):
        part = Counter(order[i : i + 100])
        assert all(abs(part[s] - 100 * n / len(order)) < 25 for s, n in share.items())


def test_rows_are_known_by_their_place(spark, scratch):
    df = spark.range(1000).select(F.col("id"), F.lit("x").alias("_file"), F.col("id").alias("_rank"), F.lit(1).alias("_metadata"))
    df.repartition(5).write.parquet(scratch)
    stored = spark.read.parquet(scratch)
    first = {r.id: r._rid for r in common.identified(stored, "id", "_file", "_rank").collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        again = {r.id: r._rid for r in common.identified(stored, "id").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert first == again and len(set(first.values())) == 1000
    derived = {r.id: r._rid for r in common.identified(stored.filter("id < 10").distinct(), "id").collect()}
    assert len(set(derived.values())) == 10
