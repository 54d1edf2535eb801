"""Merkle dataset manifest by nested-interval labels.

Every row is a leaf; the leaves of a source are ranked, and a node carries the
interval of leaf ranks that it covers.  Every ``FAN`` consecutive nodes of a
level become their parent, until one node, the source's subroot, is left; the
subroots, ranked by source, grow the same way into the root.

Ancestors are attached from the top: the nodes of a level meet their parents
in a join on (source, bucket of the level) with containment of intervals, so a
key never has more than ``FAN`` rows on either side, however hot a source is.
What the parent's interval holds besides the node's own, to its left and to
its right, are the node's siblings.  Texts are read once and never shuffled:
what moves are digests, and runs of ``FAN`` digests once per run.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import materialize, shuffle_partitions

#: Nodes under one parent.
FAN = 16
#: Columns of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<left:string,right:string>>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts joined."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*values: Column) -> Column:
    """Digest of a row's values: ``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    text = [v.cast("string") for v in values]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text])


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0, in ``order``) and ``n`` (rows) within the group; null is a group.

    The rows are sorted into ranges of similar size, whatever the groups'
    sizes, and stored with their places; a rank is the place within a range's
    share of the group, after the group's rows of earlier ranges.  Only the
    shares, about one row per range and group, meet in a window.
    """
    parts = shuffle_partitions(rows.sparkSession)
    placed = rows.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order)
    stored = materialize(placed.withColumn("place", F.monotonically_increasing_id()), "ranked")
    stored = stored.withColumn("range", F.shiftright("place", 33))
    shares = stored.groupBy("range", group).agg(F.min("place").alias("first"), F.count("*").alias("own"))
    whole = Window.partitionBy(group)
    before = F.sum("own").over(whole.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("own")
    shares = shares.select(
        F.col("range").alias("r"), F.col(group).alias("g"), (before - F.col("first")).alias("shift"), F.sum("own").over(whole).alias("n")
    )
    met = stored.join(shares, (F.col("range") == F.col("r")) & F.col(group).eqNullSafe(F.col("g")))
    return materialize(met.select(*rows.columns, (F.col("place") + F.col("shift")).alias("rank"), "n"), "ranks")


def _nodes_left(level: int) -> Column:
    """How many nodes a group of ``n`` leaves has on a level."""
    return F.ceil(F.col("n") / F.lit(FAN**level))


def grow(leaves: DataFrame, group: str) -> list[DataFrame]:
    """The levels above ``(group, rank, n, digest)``: ``(group, bucket, lo, hi, n, kids, digest)``.

    ``[lo, hi]`` are the leaf ranks that a node covers, ``bucket`` is its place
    on its level, and ``kids`` are its children ``(lo, hi, digest)`` in order.
    A group is done when one node is left.  Only the largest group's size comes
    to the driver.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    below = leaves.select(group, F.col("rank").alias("lo"), F.col("rank").alias("hi"), "n", "digest")
    levels: list[DataFrame] = []
    while most > FAN ** len(levels):
        width = FAN ** (len(levels) + 1)
        open_ = below.filter(_nodes_left(len(levels)) > 1).withColumn("bucket", F.floor(F.col("lo") / width))
        runs = open_.groupBy(group, "bucket").agg(
            F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids"), F.first("n").alias("n")
        )
        nodes = runs.select(
            group,
            "bucket",
            F.col("kids")[0]["lo"].alias("lo"),
            F.element_at("kids", -1)["hi"].alias("hi"),
            "n",
            "kids",
            F.sha2(F.array_join("kids.digest", ""), 256).alias("digest"),
        )
        levels.append(materialize(nodes, f"manifest-level-{len(levels) + 1}"))
        below = levels[-1]
    return levels


def siblings(kids: Column, lo: Column, hi: Column) -> Column:
    """The digests left and right of the child ``[lo, hi]`` within its parent."""
    joined = lambda part: F.array_join(F.transform(part, lambda k: k["digest"]), "")
    return F.struct(
        joined(F.filter(kids, lambda k: k["hi"] < lo)).alias("left"), joined(F.filter(kids, lambda k: k["lo"] > hi)).alias("right")
    )


def attach(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, group: str) -> DataFrame:
    """``leaves`` with ``subroot``, ``root`` and ``path``: the siblings on the way up, from the leaf's own run to the root.

    ``tops (group, root, path)`` says what is above every group's last node.
    """
    tops = tops.select(F.col(group).alias("g"), F.col("root").alias("root"), F.col("path").alias("above"))

    def last(nodes: DataFrame) -> DataFrame:
        """Nodes that are alone on their level: the tops are above them."""
        return nodes.join(tops, F.col(group).eqNullSafe(F.col("g"))).drop("g").withColumn("subroot", F.col("digest"))

    def met(nodes: DataFrame, parents: DataFrame, width: int) -> DataFrame:
        above = parents.select(
            F.col(group).alias("g"), F.col("bucket").alias("b"), F.col("lo").alias("from"), F.col("hi").alias("to"), F.col("kids").alias("run"), "subroot", "root", F.col("above").alias("up")
        )
        within = (F.col("lo") >= F.col("from")) & (F.col("hi") <= F.col("to"))
        joined = nodes.join(above, F.col(group).eqNullSafe(F.col("g")) & (F.floor(F.col("lo") / width) == F.col("b")) & within)
        path = F.concat(F.array(siblings(F.col("run"), F.col("lo"), F.col("hi"))), F.col("up")).cast(_PATH)
        return joined.withColumn("above", path).drop("g", "b", "from", "to", "run", "up")

    parents = None
    for level in range(len(levels), 0, -1):
        nodes = levels[level - 1]
        alone = last(nodes.filter(_nodes_left(level) <= 1))
        if parents is not None:
            alone = alone.unionByName(met(nodes.filter(_nodes_left(level) > 1), parents, FAN ** (level + 1)))
        parents = alone
    rows = leaves.withColumn("lo", F.col("rank")).withColumn("hi", F.col("rank"))
    found = last(rows.filter("n <= 1"))
    if parents is not None:
        found = found.unionByName(met(rows.filter("n > 1"), parents, FAN))
    return found.withColumnRenamed("above", "path").drop("lo", "hi")


@dataclass(frozen=True)
class Manifest:
    """Leaves ``(source, id, digest, rank, n, ...)``, the levels of the sources' trees, the subroots and the levels above them."""

    group: str
    leaves: DataFrame
    levels: list[DataFrame]
    subroots: DataFrame
    upper: list[DataFrame]

    def proofs(self) -> DataFrame:
        """The leaves with ``subroot``, ``root`` and ``path``."""
        none = F.array().cast(_PATH)
        top = self.upper[-1] if self.upper else self.subroots
        tops = top.select("all", F.col("digest").alias("root"), none.alias("path"))
        above = attach(self.subroots, self.upper, tops, "all").select(self.group, "root", "path")
        return attach(self.leaves, self.levels, above, self.group)


def build(docs: DataFrame, group: str = "source", order: str = "doc_id", fields: tuple[str, ...] = FIELDS, tampered: Column | None = None) -> Manifest:
    """The manifest of a table.

    Leaves ascend by ``order`` within ``group`` (nulls first), equal ids by
    digest; null groups are one group of their own and come first; rows that
    repeat are leaves each; null and empty texts differ.  ``tampered`` is an
    expression over the row whose value replaces the last field in a second
    digest, ``changed`` (null: none).  Other columns are ignored.  An empty
    table has no leaves, no subroots and no root.
    """
    named = [F.col(f"`{c}`") for c in fields]
    leaves = docs.select(
        named[fields.index(group)].alias(group),
        named[fields.index(order)].alias(order),
        leaf_digest(*named).alias("digest"),
        (F.lit(None).cast("string") if tampered is None else F.when(tampered.isNotNull(), leaf_digest(*named[:-1], tampered))).alias("changed"),
        # copies of a row are told apart, so that a range need not hold them all
        F.monotonically_increasing_id().alias("copy"),
    )
    leaves = ranked(materialize(leaves, "leaves"), group, [order, "digest", "copy"])
    levels = grow(leaves, group)
    alone = [leaves.filter("n = 1").select(group, "digest")]
    alone += [nodes.filter(_nodes_left(i + 1) == 1).select(group, "digest") for i, nodes in enumerate(levels)]
    subroots = reduce(DataFrame.unionByName, alone).withColumn("all", F.lit(0))
    subroots = ranked(subroots, "all", [group])
    return Manifest(group, leaves, levels, subroots, grow(subroots, "all"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(path, leaf, lambda node, p: digest(p["left"], node, p["right"]))


def proof_text(path: Column) -> Column:
    """All siblings on the way, level by level, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")
