"""Mixing sources to target weights by a low-discrepancy schedule.

Every source is a shuffled stream of its documents' words, cut into blocks of
equal length.  Slot ``i`` of the mix looks up the golden-ratio point
``frac(i * phi)`` in the cumulative weights of the sources, which spreads each
source evenly over the mix; a source's slots are ranked, and slot rank ``r``
takes block ``r mod blocks`` of its source (so a source is repeated only after
all its blocks were used).  All ranks and running sums are taken in two steps
(within buckets, then over bucket totals; about as many buckets as rows in one),
so that a source with most of the rows is spread over many tasks.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import RID, materialize, number_rows, identified_rows, text_or_empty

#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: No source is repeated more often than this.
MAX_REPEAT = 3
#: Longest block in words, the least number of blocks of a whole mix and of one source.
BLOCK_WORDS, MIN_SLOTS, MIN_BLOCKS = 2048, 1 << 16, 64
#: Golden ratio less one, to 18 places.
_PHI = "0.618033988749894848"
_CELLS = 1 << 12
_SEED = 17


def _buckets(rows: int) -> int:
    return isqrt(max(rows, 1)) + 1


def _sized(doc_id: Column, text: Column, source: Column) -> list[Column]:
    """``doc_id, source, size``: the size is words (runs of anything but ASCII white space)."""
    words = F.regexp_count(text_or_empty(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return [doc_id.alias("doc_id"), source.cast("string").alias("source"), words.alias("size")]


def document_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(_rid, doc_id, source, size)`` of every row."""
    return number_rows(docs, *_sized(F.col(id_col), F.col(text_col), F.col(source_col)))


def source_targets(sizes: DataFrame) -> DataFrame:
    """``(source, position, source_size, target)``; one row per source.

    Sources by code point, null last, weigh 1, 2, 3 repeating and share all
    words.  A target stops at ``MAX_REPEAT`` times its source; the excess is
    shared again by weight until no target is above: with the sources in order
    of (limit / weight), the stopped ones are a prefix, found by running sums.
    The windows see one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    per = per.withColumn("position", F.row_number().over(order) - 1).withColumn(
        "weight", F.get(weights, F.col("position") % len(WEIGHTS))
    )
    limit = F.col("source_size") * MAX_REPEAT
    by_ratio = Window.orderBy(limit / F.col("weight"), "position")
    before = F.coalesce(F.sum(limit).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    per = per.withColumn("level", (total - before) / rest).withColumn("ratio", limit / F.col("weight"))
    free = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "position", "level"))).over(Window.partitionBy())
    per = per.withColumn("free", free)
    target = F.when(F.col("free").isNull(), limit.cast("double")).otherwise(
        F.least(limit.cast("double"), F.col("weight") * F.col("free.level"))
    )
    return per.select("source", "position", "source_size", target.alias("target"))


def _plan(targets: DataFrame, total: int) -> DataFrame:
    """Block length, blocks and slots of every source, and its share ``[lo, hi)`` of the points."""
    length = max(1, min(BLOCK_WORDS, total // MIN_SLOTS))
    own = F.greatest(F.lit(1), F.least(F.lit(length), F.floor(F.col("source_size") / MIN_BLOCKS)))
    p = targets.withColumn("length", own).withColumn("blocks", F.ceil(F.col("source_size") / F.col("length")))
    whole = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))
    part = F.round((F.col("target") - whole * F.col("source_size")) / F.col("length"))
    quota = F.least(F.col("blocks") * MAX_REPEAT, whole * F.col("blocks") + part).cast("long")
    p = p.withColumn("quota", quota)
    upto = F.sum("quota").over(Window.orderBy("position"))
    all_ = F.greatest(F.sum("quota").over(Window.partitionBy()), F.lit(1))
    return p.withColumn("lo", (upto - F.col("quota")) / all_).withColumn("hi", upto / all_)


def schedule(plan: DataFrame) -> DataFrame:
    """``(slot, position, rank, epoch, block)``: what every slot of the mix takes.

    Sources get exactly their quota of slots: ranks beyond it are left out, and
    the few that the points leave over are appended.
    """
    spark = plan.sparkSession
    slots, sources = plan.agg(F.coalesce(F.sum("quota"), F.lit(0)), F.count("*")).first()
    cells_in_all = max(_CELLS, 4 * sources)  # a cell meets a few sources, however many there are
    product = F.col("id").cast("decimal(19,0)") * F.lit(_PHI).cast("decimal(18,18)")
    point = (product - F.floor(product)).cast("double")
    points = spark.range(slots).select(F.col("id").alias("slot"), point.alias("u"))
    points = points.withColumn("cell", F.floor(F.col("u") * cells_in_all))
    cells = plan.filter("quota > 0").select(
        "position", "quota", "blocks", "lo", "hi",
        F.explode(F.sequence(F.floor(F.col("lo") * cells_in_all), F.floor(F.col("hi") * cells_in_all))).alias("cell"),
    )
    hits = points.join(cells, "cell").filter("u >= lo AND u < hi")
    hits = hits.select("slot", "position", "quota", "blocks", F.floor(F.col("slot") / _buckets(slots)).alias("bucket"))
    counts = hits.groupBy("position", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("position").orderBy("bucket")
    counts = counts.select("position", "bucket", (F.sum("n").over(earlier) - F.col("n")).alias("before"))
    within = Window.partitionBy("position", "bucket").orderBy("slot")
    ranked = (
        hits.withColumn("rn", F.row_number().over(within))
        .join(counts, ["position", "bucket"])
        .withColumn("rank", F.col("before") + F.col("rn") - 1)
        .filter("rank < quota")
        .select("slot", "position", "rank", "blocks")
    )
    got = hits.groupBy("position").agg(F.count("*").alias("got"))
    left = plan.filter("quota > 0").join(got, "position", "left").withColumn("got", F.coalesce("got", F.lit(0))).filter("got < quota")
    tail = left.select(
        F.lit(slots).alias("slot"), "position", F.explode(F.sequence(F.col("got"), F.col("quota") - 1)).alias("rank"), "blocks"
    )
    return ranked.unionByName(tail).select(
        "slot", "position", "rank", F.floor(F.col("rank") / F.col("blocks")).alias("epoch"), (F.col("rank") % F.col("blocks")).alias("block")
    )


def _streams(sizes: DataFrame, plan: DataFrame, rows: int) -> DataFrame:
    """Rows with their place ``start`` in the shuffled word stream of their source."""
    h = F.xxhash64(F.lit(_SEED), F.col("doc_id"))
    placed = sizes.join(plan, sizes["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    placed = placed.withColumn("h", h).withColumn("bucket", F.pmod("h", F.lit(_buckets(rows))))
    sums = placed.groupBy("position", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("position").orderBy("bucket")
    sums = sums.select("position", "bucket", (F.sum("words").over(earlier) - F.col("words")).alias("base"))
    within = Window.partitionBy("position", "bucket").orderBy("h", "doc_id", "size", RID)
    return (
        placed.withColumn("own", F.sum("size").over(within) - F.col("size"))
        .join(sums, ["position", "bucket"])
        .withColumn("start", F.col("base") + F.col("own"))
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: ``_rid, doc_id, size, source_size, target, taken, slots``.

    ``taken`` is the number of the row's words that the mix takes, repeats
    counted; it never exceeds ``MAX_REPEAT`` times ``size``.  ``slots`` are the
    row's places in the mix, first the slot in which its words come first, then
    that of their first repeat, and so on; read in the order of slots, the
    sources come evenly mixed at every length.  Null and empty
    texts have size 0 and nothing taken; a null source is a source of its own,
    last in order; repeated rows count each; an empty table gives an empty
    result.  Ties in the shuffle go by id, size and place in the scan, and
    reruns over the same rows agree.
    """
    return _mix(materialize(document_sizes(docs, id_col, text_col, source_col), "sizes")).drop("position")


def _mix(sizes: DataFrame) -> DataFrame:
    """``mix`` of stored ``(_rid, doc_id, source, size)``, with the ``position`` of the source."""
    total, rows = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    plan = materialize(_plan(source_targets(sizes), total), "mix-plan")
    # a block is used once an epoch, so at most MAX_REPEAT times
    uses = schedule(plan).groupBy("position", "block").agg(F.count("*").alias("uses"), F.sort_array(F.collect_list("slot")).alias("at"))
    streams = materialize(_streams(sizes, plan, rows), "streams")
    first, last = F.col("start"), F.col("start") + F.col("size")
    pieces = streams.filter("size > 0").select(
        RID, "position", "length", "start", "size",
        F.explode(F.sequence(F.floor(first / F.col("length")), F.floor((last - 1) / F.col("length")))).alias("block"),
    )
    words = F.least(last, (F.col("block") + 1) * F.col("length")) - F.greatest(first, F.col("block") * F.col("length"))
    taken = (
        pieces.join(uses, ["position", "block"])
        .groupBy(RID)
        .agg(F.sum(words * F.col("uses")).cast("long").alias("taken"), *[F.min(F.get("at", F.lit(i))).alias(f"at{i}") for i in range(MAX_REPEAT)])
        .select(RID, "taken", F.array_compact(F.array(*[f"at{i}" for i in range(MAX_REPEAT)])).alias("slots"))
    )
    return streams.join(taken, RID, "left").select(
        RID, "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
        F.coalesce("slots", F.array().cast("array<bigint>")).alias("slots"), "position"
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as whole documents in the order of the schedule: every row as often as its taken words, rounded, hold its size.

    Columns are those of ``docs``; a copy stands at the slot of its words.  Rows without words are left out (they
    weigh nothing).  A source takes a prefix of its stream once more than the
    rest, so only the document at the end of that prefix is rounded.  A source
    with a target above 0 of which rounding would leave nothing gives the
    document with the most taken words once (ties: the shortest, then the first
    of the scan).
    """
    stored, row = identified_rows(docs), F.col("row")
    result = _mix(materialize(stored.select(RID, *_sized(row[id_col], row[text_col], row[source_col])), "sizes"))
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    plan = materialize(result.filter("size > 0").select(RID, "position", "size", "target", "taken", "slots", copies.alias("_copies")), "copies")
    most = F.max(F.struct("taken", (-F.col("size")).alias("s"), (-F.col(RID)).alias("r"))).alias("most")
    lost = plan.groupBy("position").agg(most, F.max("_copies").alias("n"), F.max("target").alias("t")).filter("n = 0 AND t > 0")
    plan = plan.join(lost.select((-F.col("most.r")).alias(RID), F.lit(1).alias("once")), RID, "left")
    plan = plan.select(RID, "slots", F.coalesce("once", "_copies").alias("_copies")).filter("_copies > 0")
    copied = stored.join(plan, RID).select(RID, "row", "slots", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("copy"))
    slot = F.coalesce(F.get("slots", F.col("copy")), F.try_element_at("slots", F.lit(-1)))
    return copied.select(slot.alias("slot"), RID, "copy", "row").orderBy("slot", RID, "copy").select("row.*")
