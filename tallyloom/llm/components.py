"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import materialize, packed, spread


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)``, stored, for every node of stored ``edges (u, v)``: the smallest node reachable.

    Each step hangs neighbours under the smallest one around, so that trees
    become stars in about log(n) steps.  Every step is a grouped minimum
    (reduced map-side) and a join, written to the shared folder; only a row
    count and a checksum come to the driver.  No step makes more edges than it
    has, so that few edges are dealt to few tasks.
    """
    n = edges.count()
    edges = packed(edges, n).filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialize(edges, "edges")
    mark = _mark(edges)
    while True:
        ways = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
        both = packed(edges, mark[0]).select(ways.alias("e")).select("e.u", "e.v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        step = small.unionByName(least.select("u", F.col("m").alias("v")))
        edges = materialize(packed(step, mark[0]).distinct(), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    edges = packed(edges, mark[0])
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return materialize(leaves.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components")


def extended(joined: DataFrame, edges: DataFrame) -> DataFrame:
    """The stored ``components`` of more edges: of those that gave ``joined``, and of stored ``edges (u, v)``.

    Only the components that the new edges meet are looked at again.
    """
    known = spread(joined)
    for end in "uv":
        edges = edges.join(known.withColumnRenamed("node", end), end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    roots = components(materialize(edges, "edges"))
    changed = spread(roots)
    moved = joined.join(changed.select(F.col("node").alias("component"), F.col("component").alias("root")), "component", "left")
    moved = moved.select("node", F.coalesce("root", "component").alias("component"))
    return materialize(moved.unionByName(roots.join(known.select("node"), "node", "left_anti")), "components")
