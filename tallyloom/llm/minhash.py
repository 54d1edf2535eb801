"""MinHash near-dedup with fast similarity sketches, banding and exact verification.

A sketch has ``COORDINATES`` places.  In round ``i`` every shingle falls by a
hash of its own into one place with the value ``(i, rest of the hash)``; a
place keeps its least value, and rounds go on until all places are filled, at
the latest in rounds ``t .. 2t`` that visit place ``i - t`` with every shingle.
Two sketches agree in a place with the probability of the sets' Jaccard
similarity, and the share of agreeing places is as concentrated as with
independent permutations, at about the cost of one pass.

Documents that agree in all places of a band meet in a bucket.  Equal sets are
one node.  In a few turns, the members of every bucket are verified against a
leader of it, the node that meets the most others first; buckets whose members
are then in one component are done.  The members of the others are compared
across components by an exact join: candidates share one of their rarest
shingles early enough in a common order.  No pair within one component is made,
and no link between members of a bucket is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import RID, arrow_slices, keep_rows, materialize, ship, spread, identified, identified_rows, text_or_empty
from tallyloom.llm.components import components, extended

WIDTH, PERCENT = 5, 80
#: At similarity 0.8 all bands miss with probability (1 - 0.8**4)**32 < 1e-7.
COORDINATES, ROWS = 128, 4
#: Turns in which the members of a bucket are compared with one leader.
LEADERS = 2
#: Words remembered by a task; bytes of text or of sets handled at a time.
CACHE_WORDS, BATCH_BYTES = 100_000, 2 << 20

_K, _MASK = np.uint64(0x9E3779B97F4A7C15), (1 << 64) - 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """64-bit hashes of words; a bounded memory of those seen."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str, width: int, memory: _Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``width``-word shingles.

    Words are runs of anything but ASCII white space, with A-Z lower-cased;
    a text of fewer words is one shingle, one without words has none.
    """
    words = text.encode("utf-8").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(memory.__getitem__, words), np.uint64, n)
    own = min(width, n)
    out = np.full(n - own + 1, own, np.uint64)
    for i in range(own):
        out = _mixed(out * _K + h[i : n - own + 1 + i])
    return np.unique(out)


def sketch(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """Sketches of non-empty shingle sets, one per row."""
    t, shift = coordinates, np.uint64(64 - (coordinates - 1).bit_length())
    out = np.full(len(sets) * t, _EMPTY, np.uint64)
    rest_mask = np.uint64((1 << 54) - 1)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    x = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    for i in range(2 * t):
        h = _mixed(x + np.uint64((i + 1) * int(_K) & _MASK))
        place = (h >> shift).astype(np.int64) if i < t else np.full(len(x), i - t)
        value = (np.uint64(i) << np.uint64(54)) | (h & rest_mask)
        np.minimum.at(out, owner * t + place, value)
        open_ = (out.reshape(-1, t) == _EMPTY).any(axis=1)
        if not open_.any():
            break
        if not open_.all():
            keep = open_[owner]
            x, owner = x[keep], owner[keep]
    return out.reshape(-1, t)


def bands(sketches: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band of ``rows`` places; the band's number is part of the key."""
    n, t = sketches.shape
    count = t // rows
    grouped = sketches[:, : count * rows].reshape(n, count, rows)
    key = np.broadcast_to(np.arange(1, count + 1, dtype=np.uint64) * _K, (n, count)).copy()
    for i in range(rows):
        key = _mixed(key * _K + grouped[:, :, i])
    return key.view(np.int64)


def sketch_table(rows: DataFrame, width: int) -> DataFrame:
    """``(_rid, n_shingles, set_id, bands)`` per row of ``(_rid, text)``; ``set_id`` is a 128-bit hash of the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Words()
        for part in arrow_slices(batches, "text", BATCH_BYTES):
            sets = [shingles(t, width, memory) for t in part.column("text").to_pylist()]
            full = [k for k, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            if full:
                for k, row in zip(full, bands(sketch([sets[k] for k in full]))):
                    keys[k] = row
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(RID),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                [RID, "n_shingles", "set_id", "bands"],
            )

    return rows.select(RID, "text").mapInArrow(run, f"{RID} long, n_shingles long, set_id binary, bands array<long>")


def _sets(rows: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``(node, shingles)``: the sorted shingle hashes of the given rows as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Words()
        for part in arrow_slices(batches, "text", BATCH_BYTES):
            sets = [shingles(t, width, memory).astype("<u8").tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(RID), pa.array(sets, pa.binary())], ["node", "shingles"])

    return rows.select(RID, "text").join(spread(nodes).withColumnRenamed("node", RID), RID, "left_semi").mapInArrow(run, "node long, shingles binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``(a, b)`` of ``pairs`` whose full sets have 100 * intersection >= percent * union."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in arrow_slices(batches, "sa", BATCH_BYTES):
            for part in arrow_slices(iter([whole]), "sb", BATCH_BYTES):
                keep = []
                for x, y in zip(part.column("sa").to_pylist(), part.column("sb").to_pylist()):
                    p, q = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    keep.append(100 * both >= percent * (len(p) + len(q) - both))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    return spread(pairs).join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(linked, "a long, b long")


def _open_entries(open_: DataFrame, joined: DataFrame) -> DataFrame:
    """Entries of the buckets whose members are not yet in one component, with their components."""
    labelled = open_.drop("component").join(spread(joined), "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    return labelled.join(split.select("key"), "key", "left_semi")


def _similar(a: str, b: str, percent: int) -> Column:
    """Sets of other sizes cannot be linked."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _star_pairs(open_: DataFrame, turn: int, percent: int) -> DataFrame:
    """Every member of a bucket with the bucket's leader of this turn: its heaviest, second heaviest, ... node."""
    order = F.struct("w", (-F.col("node")).alias("m"), "n", "component")
    lead = open_.groupBy("key").agg(F.max(order).alias("lead"))
    for _ in range(turn):
        below = open_.join(lead, "key").filter(F.struct("w", (-F.col("node")).alias("m")) < F.struct("lead.w", "lead.m"))
        lead = below.groupBy("key").agg(F.max(order).alias("lead"))
    stars = open_.join(lead, "key").withColumn("leader", -F.col("lead.m")).withColumn("size", F.col("lead.n"))
    stars = stars.filter(F.col("component") != F.col("lead.component")).filter(_similar("n", "size", percent))
    return stars.select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct()


def _prefixes(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(shingle, node, n, component, i, index)``: the rarest shingles of every open node in a common order.

    Two linked sets of ``n`` and at most ``n`` shingles share one of the first
    ``n - ceil(p n) + 1`` of the larger and of the first
    ``n - ceil(2 p n / (1 + p)) + 1`` of the smaller (``index``), whatever the
    order; rare shingles first, few sets share one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_slices(batches, "shingles", BATCH_BYTES):
            own = [np.frombuffer(raw, "<i8") for raw in part.column("shingles").to_pylist()]
            node = np.repeat(part.column("node").to_numpy(), [len(x) for x in own])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own)), pa.array(node)], ["shingle", "node"])

    nodes = spread(materialize(open_.select("node", "n", "component").distinct(), "open-nodes"))
    single = materialize(sets.join(nodes.select("node"), "node", "left_semi").mapInArrow(run, "shingle long, node long"), "open-shingles")
    use = single.groupBy("shingle").agg(F.count("*").alias("df"))
    order = F.sort_array(F.collect_list(F.struct("df", "shingle")))
    ordered = single.join(use, "shingle").groupBy("node").agg(order.alias("o")).join(nodes, "node")
    probe = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    index = F.col("n") - F.ceil(F.col("n") * (2 * percent) / (100 + percent)) + 1
    rows = ordered.select("node", "n", "component", index.alias("upto"), F.posexplode(F.slice("o", F.lit(1), probe.cast("int"))).alias("i", "e"))
    return rows.select(F.col("e.shingle").alias("shingle"), "node", "n", "component", "i", (F.col("i") < F.col("upto")).alias("index"))


def _cross_pairs(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs of open nodes in different components that can be linked: prefix and position filters.

    If a shingle is the first in order that two sets share, what stands before
    it is in no intersection.
    """
    rows = materialize(_prefixes(open_, sets, percent), "prefixes")
    left = rows.select("shingle", F.col("node").alias("a"), "n", "i", F.col("component").alias("ca"))
    right = rows.filter("index").select(
        "shingle", F.col("node").alias("b"), F.col("n").alias("m"), F.col("i").alias("j"), F.col("component").alias("cb")
    )
    smaller = (F.col("m") < F.col("n")) | (F.col("m") == F.col("n")) & (F.col("b") < F.col("a"))
    both = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j"))
    possible = both * 100 >= (F.col("n") + F.col("m") - both) * percent
    pairs = left.join(right, "shingle").filter(smaller & (F.col("ca") != F.col("cb")) & possible)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """One row per input row: ``_rid, doc_id, n_shingles, component_id, kept``.

    Rows are linked when the Jaccard similarity of their shingle sets is at
    least ``percent`` / 100; ``component_id`` is the smallest id reachable over
    links and ``kept`` marks that one row (null ids come last; among rows that
    repeat an id, the first of the scan).  Null, empty and blank texts have no
    shingles, are linked with nothing and are kept.  Other columns are ignored;
    an empty table gives an empty result.
    """
    return _near(identified(docs, F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")), width, percent)


def _near(rows: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``near_dedup`` of stored ``(_rid, doc_id, text)``."""
    ship(rows.sparkSession)
    ids = rows.select(RID, "doc_id")
    table = materialize(sketch_table(rows, width), "sketches")
    full = table.filter("n_shingles > 0")
    # stored, so that both sides of the joins are dealt out by them and a hot set's or bucket's rows can be split
    first = materialize(full.groupBy("set_id").agg(F.min(RID).alias("node")), "distinct-sets")
    nodes = full.join(first.select(F.col("node").alias(RID)), RID)
    entries = materialize(
        nodes.select(F.explode("bands").alias("key"), F.col(RID).alias("node"), F.col("n_shingles").alias("n")), "band-entries"
    )
    buckets = materialize(entries.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1"), "buckets")
    shared = materialize(entries.join(buckets, "key"), "shared-entries")
    # a node that meets many others is likely their common original: the leader of its buckets
    weight = materialize(shared.groupBy("node").agg(F.sum("c").alias("w")), "weights")
    open_ = shared.join(spread(weight), "node").select("key", "node", "n", "w", F.col("node").alias("component"))
    open_ = materialize(open_, "open-entries")
    sets = materialize(_sets(rows, weight.select("node"), width), "shingle-sets")
    joined = tried = None
    for turn in range(LEADERS + 1):
        if open_.isEmpty():
            break
        pairs = _star_pairs(open_, turn, percent) if turn < LEADERS else _cross_pairs(open_, sets, percent)
        if tried is not None:
            pairs = pairs.join(spread(tried), ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        found = materialize(verified(pairs, sets, percent), "links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        if not found.isEmpty():
            links = found.select(F.col("a").alias("u"), F.col("b").alias("v"))
            joined = components(links) if joined is None else extended(joined, links)
            if turn < LEADERS:
                open_ = materialize(_open_entries(open_, joined), "open-entries")
    # rows without shingles have no set to meet
    known = table.withColumn("set_id", F.coalesce("set_id", F.encode(F.col(RID).cast("string"), "utf-8"))).drop("bands")
    known = known.join(first, "set_id", "left").withColumn("node", F.coalesce("node", RID))
    if joined is not None:
        known = known.join(spread(joined), "node", "left").withColumn("node", F.coalesce("component", "node"))
    placed = ids.join(known.select(RID, "n_shingles", F.col("node").alias("component")), RID)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col(RID).alias("rid"))
    heads = placed.groupBy("component").agg(F.min(order).alias("first"))
    return placed.join(heads, "component").select(
        RID, "doc_id", "n_shingles", F.col("first.id").alias("component_id"), (F.col(RID) == F.col("first.rid")).alias("kept")
    )


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every group of near copies; columns unchanged."""
    stored, row = identified_rows(docs), F.col("row")
    rows = stored.select(RID, row[id_col].alias("doc_id"), text_or_empty(row[text_col]).alias("text"))
    return keep_rows(stored, _near(rows).filter("kept"))
