"""Connected components: of few edges in few tasks, of many dealt out, and extended by further edges."""

from __future__ import annotations

import random

import pytest

from tallyloom.llm import common, components as module
from tallyloom.llm.common import materialize
from tallyloom.llm.components import components, extended


def expected(edges):
    root = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for u, v in edges:
            low = min(root[u], root[v])
            changed |= root[u] != low or root[v] != low
            root[u] = root[v] = low
    return root


def stored(spark, edges):
    return materialize(spark.createDataFrame(edges, "u long, v long"), "test-edges")


def found(df):
    rows = [tuple(r) for r in df.select("node", "component").collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def some_edges(seed, n, nodes):
    rng = random.Random(seed)
    pairs = [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(n)]
    return [(u, v) for u, v in pairs if u != v]


def test_few_edges_are_not_dealt_out(spark, monkeypatch):
    files = []
    keep = lambda df, kind: files.append(len((out := materialize(df, kind)).inputFiles())) or out
    monkeypatch.setattr(module, "materialize", keep)
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        edges = some_edges(1, 300, 400)
        assert found(components(stored(spark, edges))) == expected(edges)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert max(files) <= 2


@pytest.mark.parametrize("task_rows", [10, 50_000])
def test_extended_is_the_whole(spark, monkeypatch, task_rows):
    monkeypatch.setattr(common, "TASK_ROWS", task_rows)
    first, second = some_edges(2, 60, 120), some_edges(3, 25, 160)
    assert found(extended(components(stored(spark, first)), stored(spark, second))) == expected(first + second)
    chain = [(i, i + 1) for i in range(40)]
    assert found(components(stored(spark, chain[::-1]))) == {i: 0 for i in range(41)}
