"""Group values by key, and co-group several keyed inputs, in bounded chunks.

A group that gathers all values of a key is unbounded: one key may hold a
third of all rows.  So the value lists here are emitted in *chunks*: rows of
one key told apart by ``chunk``, whose lists together hold at most
``chunk_size`` values, always.  Every value lands in exactly one chunk; none is
dropped or sampled.  A key whose values fit one chunk, none of them repeated
``chunk_size`` times, gets exactly one row with ``chunk = 0``, which is the
plain "key with its list" result.

One plan at every size (all built-in expressions, deterministic, nothing runs
before the action); the rows are shuffled once:

1. A mergeable heavy-hitter sketch (Spark's ``approx_top_k``) over hashes of the
   keys, and of (key, value) pairs, in one pass that shuffles sketches only.
   It names at most ``HEAVY`` of each that surely occur more than
   ``chunk_size`` times, with a lower bound of their counts.
2. Rows of named pairs are counted: ``m // chunk_size`` whole lists of one value
   are made at once, in blocks of at most 1024 per input row and level, spread
   over the tasks in between; ``m % chunk_size`` copies are left over.
3. All other rows and those copies: the rows of a named key are spread over
   ``bound / chunk_size`` salts by a hash of their content.
4. Running sums within ``(key, salt)`` cut the rows at exact multiples of
   ``chunk_size``, and each chunk's lists are gathered.

The sketch decides only how evenly the work is spread: what it does not name
has at most about ``7 * rows / COUNTERS`` rows more than ``chunk_size``, and is
cut by its running sums like the rest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK_SIZE = 100_000
#: Keys, and pairs of key and value, that the sketch names at most; its counters; sketches merged into the last one.
HEAVY, COUNTERS, _SKETCHES = 1000, 16_384, 256
#: Rows that one row becomes per level when whole lists of one value are made.
_BLOCK = 1024

_M, _NC, _SALT, _COPIES, _LAST, _H = "_tl_m", "_tl_nc", "_tl_salt", "_tl_copies", "_tl_last", "_tl_h"


def _as_list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _div(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b))


def _hash(columns: Sequence[str]) -> Column:
    # a null leaves a hash as it is, so where the nulls are is hashed too
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def _sketch(df: DataFrame, hashes: Mapping[str, Column]) -> DataFrame:
    """One row (none for no input): ``n`` (rows) and a heavy-hitter sketch of every hash, merged in two levels."""
    rows = df.select(F.pmod(F.spark_partition_id(), F.lit(_SKETCHES)).alias("_tl_p"), *[h.alias(name) for name, h in hashes.items()])
    each = [F.expr(f"approx_top_k_accumulate({name}, {COUNTERS})").alias(name) for name in hashes]
    merged = [F.expr(f"approx_top_k_combine({name}, {COUNTERS})").alias(name) for name in hashes]
    parts = rows.groupBy("_tl_p").agg(F.count(F.lit(1)).alias("n"), *each)
    # by a constant: there is no group, and nothing to merge, without rows
    return parts.groupBy(F.lit(0).alias("_tl_all")).agg(F.sum("n").alias("n"), *merged)


def _heavy(sketch: DataFrame, name: str, least: int) -> DataFrame:
    """``(_tl_h, least)``: hashes that surely occur more than ``least`` times, with that lower bound; at most ``HEAVY`` rows.

    An estimate of the sketch is too high by 3.5 rows in ``COUNTERS`` at most.
    """
    found = sketch.select("n", F.explode(F.expr(f"approx_top_k_estimate({name}, {HEAVY})")).alias("e"))
    surely = F.col("e.count") - F.ceil(F.col("n") * 3.5 / COUNTERS)
    return found.select(F.col("e.item").alias(_H), surely.alias("least")).filter(F.col("least") > least)


def _counted(rows: DataFrame, keys: list[str], content: list[str], keep_nulls: bool, each: bool = False) -> DataFrame:
    """``(keys, content, m)``: rows (``each`` of them, or equal ones together) with how often they count; nulls that are not kept count 0 times."""
    if each:
        rows = rows.select(*keys, *content, F.lit(1).cast("long").alias(_M))
    else:
        rows = rows.groupBy(*keys, *content).agg(F.count(F.lit(1)).alias(_M))
    if not keep_nulls:
        rows = rows.withColumn(_M, F.when(F.col(content[-1]).isNull(), F.lit(0).cast("long")).otherwise(F.col(_M)))
    return rows


def _whole(rows: DataFrame, keys: list[str], content: list[str], chunk_size: int) -> DataFrame:
    """One row per whole list of one value: ``(keys, content, copies, chunk)`` with a chunk number below 0."""
    n = "_tl_whole"
    heavy = rows.filter(F.col(_M) >= chunk_size).select(*keys, *content, _div(F.col(_M), chunk_size).alias(n))
    upto = lambda left: F.sequence(F.lit(0).cast("long"), F.least(left, F.lit(_BLOCK).cast("long")) - 1)
    too_many = F.raise_error(F.lit(f"a value repeats more than {_BLOCK}**3 * chunk_size times; use a larger chunk_size"))
    heavy = heavy.withColumn(n, F.when(F.col(n) > _BLOCK**3, too_many.cast("long")).otherwise(F.col(n)))
    heavy = heavy.withColumn("_tl_a", F.explode(upto(F.ceil(F.col(n) / _BLOCK**2))))
    heavy = heavy.withColumn(n, F.col(n) - F.col("_tl_a") * _BLOCK**2)
    heavy = heavy.withColumn("_tl_b", F.explode(upto(F.ceil(F.col(n) / _BLOCK)))).repartition(*keys, *content, "_tl_a", "_tl_b")
    heavy = heavy.withColumn("_tl_c", F.explode(upto(F.col(n) - F.col("_tl_b") * _BLOCK)))
    number = F.pmod(F.xxhash64(*content, "_tl_a", "_tl_b", "_tl_c"), F.lit(1 << 62))
    return heavy.select(*keys, *content, F.lit(chunk_size).cast("int").alias(_COPIES), (-1 - number).alias("chunk"))


def _parts(
    df: DataFrame, keys: list[str], content: list[str], chunk_size: int, keep_nulls: bool, distinct_values: bool
) -> tuple[DataFrame, DataFrame]:
    """``(parts, whole)``: rows ``(keys, content, copies, chunk)`` to gather, and whole lists of one value."""
    if not 1 <= chunk_size < 2**31:
        raise ValueError("chunk_size must be between 1 and 2**31 - 1")
    if df.isStreaming:
        raise ValueError("grouping values into lists is a batch operation; aggregate streams per window")
    if distinct_values:
        sketch = _sketch(df, {"of_key": _hash(keys)})
        repeated, single = df.filter(F.col(content[-1]).isNull()), df.filter(F.col(content[-1]).isNotNull())
    else:
        sketch = _sketch(df, {"of_key": _hash(keys), "of_pair": _hash([*keys, *content])})
        # a table of at most HEAVY rows
        pairs = F.broadcast(_heavy(sketch, "of_pair", chunk_size))
        repeated, single = (df.join(pairs, _hash([*keys, *content]) == F.col(_H), how) for how in ("left_semi", "left_anti"))
    counted = _counted(repeated, keys, content, keep_nulls)
    left = counted.withColumn(_M, F.when(F.col(_M) < chunk_size, F.col(_M)).otherwise(F.col(_M) % chunk_size))
    left = left.filter((F.col(_M) > 0) | F.col(content[-1]).isNull() & F.lit(not keep_nulls))
    light = left.unionByName(_counted(single, keys, content, keep_nulls, each=True))
    hot = F.broadcast(_heavy(sketch, "of_key", chunk_size).select(_H, F.ceil(F.col("least") / chunk_size).alias(_NC)))
    salted = light.join(hot, _hash(keys) == F.col(_H), "left").drop(_H).withColumn(_NC, F.coalesce(_NC, F.lit(1).cast("long")))
    h = F.xxhash64(*keys, *content)
    salted = salted.withColumn(_SALT, F.pmod(h, F.col(_NC)))
    upto = Window.partitionBy(*keys, _SALT).orderBy(F.xxhash64(*content)).rowsBetween(Window.unboundedPreceding, 0)
    placed = salted.withColumn(_LAST, F.sum(_M).over(upto))
    first = F.col(_LAST) - F.col(_M)
    lo = F.when(F.col(_M) > 0, _div(first, chunk_size)).otherwise(_div(F.greatest(first - 1, F.lit(0)), chunk_size))
    hi = F.when(F.col(_M) > 0, _div(F.col(_LAST) - 1, chunk_size)).otherwise(lo)
    cut = placed.withColumn("_tl_sub", F.explode(F.sequence(lo, hi)))  # at most two: m is below chunk_size
    sub = F.col("_tl_sub")
    copies = F.least(F.col(_LAST), (sub + 1) * chunk_size) - F.greatest(first, sub * chunk_size)
    parts = cut.select(
        *keys, *content, _SALT, F.greatest(copies, F.lit(0)).cast("int").alias(_COPIES), (sub * F.col(_NC) + F.col(_SALT)).alias("chunk")
    )
    return parts, _whole(counted, keys, content, chunk_size)


def group_values(
    df: DataFrame,
    key: str | Sequence[str] = "key",
    value: str = "value",
    out: str = "values",
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    keep_nulls: bool = False,
    sort_values: bool = False,
    distinct_values: bool = False,
) -> DataFrame:
    """``(key, chunk, values)``: the values of each key, in lists of at most ``chunk_size``.

    Duplicated values are kept.  Null values are dropped unless
    ``keep_nulls``; a key whose values are all null still appears, with an
    empty list.  ``sort_values`` sorts each chunk's list.  ``chunk`` tells the
    rows of a key apart (0 and up; below 0 for whole lists of one value).

    ``distinct_values=True`` states that no value repeats often within a key
    (ids, for instance) and skips the sketch of pairs.  Where that is false the
    result is the same and the bound holds, but the copies of a value are
    sorted in one task.

    Prefer ``sum_per_key`` / ``count_per_element`` when only a fold of the
    list is wanted: they never build it.
    """
    keys = _as_list(key)
    parts, whole = _parts(df.select(*keys, value), keys, [value], chunk_size, keep_nulls, distinct_values)
    copies = F.array_repeat(F.col(value), F.col(_COPIES))
    values = F.flatten(F.collect_list(copies))
    gathered = parts.groupBy(*keys, _SALT, "chunk").agg((F.array_sort(values) if sort_values else values).alias(out))
    return gathered.select(*keys, "chunk", out).unionByName(whole.select(*keys, "chunk", copies.alias(out)))


def cogroup(
    inputs: Mapping[str, DataFrame],
    key: str | Sequence[str] = "key",
    value: str = "value",
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    keep_nulls: bool = False,
    sort_values: bool = False,
    unique_keys: bool = False,
    distinct_values: bool = False,
) -> DataFrame:
    """Co-group keyed inputs: ``(key, chunk, <tag1>, <tag2>, ...)``.

    ``inputs`` maps a tag (the output column name) to a frame with the key
    columns and ``value``.  Every key of any input appears; an input without
    values for the key contributes an empty list, never null; values are not
    multiplied across inputs.  One union feeds one grouping, for any number of
    inputs, instead of a chain of full outer joins.  The lists of one row hold
    at most ``chunk_size`` values together.

    ``unique_keys=True`` states that every input holds at most one row per
    key (per-key aggregates, such as word counts).  Each list then has at most
    one element and the co-group needs a single shuffle and no chunking
    (``chunk`` is 0); a second row for a key fails the query.
    ``distinct_values`` is as for ``group_values``.
    """
    keys = _as_list(key)
    if not inputs:
        raise ValueError("cogroup needs at least one input")
    clash = set(inputs) & (set(keys) | {"chunk"})
    if clash:
        raise ValueError(f"input tags {sorted(clash)} collide with the key or chunk columns")
    tagged = [
        frame.select(*[F.col(k) for k in keys], F.lit(tag).alias("_tl_tag"), F.col(value).alias("_tl_v"))
        for tag, frame in inputs.items()
    ]
    union = reduce(lambda a, b: a.unionByName(b), tagged)
    if unique_keys:
        aggs, lists = [], []
        empty = F.array().cast(f"array<{union.schema['_tl_v'].dataType.simpleString()}>")
        for i, tag in enumerate(inputs):
            mine = F.col("_tl_tag") == tag
            aggs += [F.count_if(mine).alias(f"_tl_n{i}"), F.max(F.when(mine, F.col("_tl_v"))).alias(f"_tl_v{i}")]
            n, v = F.col(f"_tl_n{i}"), F.col(f"_tl_v{i}")
            second = F.raise_error(F.lit(f"input {tag} has several rows for a key, unique_keys is not true")).cast("string")
            none = (n == 0) if keep_nulls else v.isNull()
            checked = F.when(n > 1, second).isNull()  # raises, or is true
            lists.append(F.when(checked & none, empty).otherwise(F.array(v)).alias(tag))
        return union.groupBy(*keys).agg(*aggs).select(*keys, F.lit(0).cast("long").alias("chunk"), *lists)
    parts, whole = _parts(union, keys, ["_tl_tag", "_tl_v"], chunk_size, keep_nulls, distinct_values)
    copies = F.array_repeat(F.col("_tl_v"), F.col(_COPIES))
    aggs, single = [], []
    for tag in inputs:
        mine = F.col("_tl_tag") == tag
        values = F.flatten(F.collect_list(F.when(mine, copies)))
        aggs.append((F.array_sort(values) if sort_values else values).alias(tag))
        single.append(F.array_repeat(F.col("_tl_v"), F.when(mine, F.col(_COPIES)).otherwise(F.lit(0))).alias(tag))
    gathered = parts.groupBy(*keys, _SALT, "chunk").agg(*aggs)
    return gathered.select(*keys, "chunk", *inputs).unionByName(whole.select(*keys, "chunk", *single))


def cogroup_stored(left: DataFrame, right: DataFrame, key: str, value: str, tags: Sequence[str]) -> DataFrame:
    """``(key, <tag1>, <tag2>)``: co-group of two inputs that are stored by key (``sinks.write_bucketed``).

    Each input has at most one row per key (per-key aggregates), so every list
    has at most one element.  With the same number of buckets on both sides the
    join finds the rows of a key in the same bucket and shuffles nothing; on
    inputs that are not stored by key it is an ordinary outer join.  A second
    row for a key would give a second row here, and a null key of one input
    does not meet that of the other (a join on equality alone keeps to the
    buckets): use ``cogroup`` where either may be.
    """
    a = left.select(F.col(key).alias("_tl_a"), F.struct(F.col(value).alias("v")).alias("_tl_x"))
    b = right.select(F.col(key).alias("_tl_b"), F.struct(F.col(value).alias("v")).alias("_tl_y"))
    met = a.join(b, F.col("_tl_a") == F.col("_tl_b"), "full_outer")
    # a side's struct is null where the side has no row; null values are no list elements
    values = lambda side: F.filter(F.array(F.col(f"{side}.v")), lambda v: v.isNotNull())
    own_key = F.when(F.col("_tl_x").isNotNull(), F.col("_tl_a")).otherwise(F.col("_tl_b"))
    return met.select(own_key.alias(key), values("_tl_x").alias(tags[0]), values("_tl_y").alias(tags[1]))


def fold_sum(
    grouped: DataFrame,
    key: str | Sequence[str] = "key",
    values: str = "values",
    factor: int = 1,
    out: str = "value",
) -> DataFrame:
    """``(key, factor * sum of all listed values)`` over ``group_values`` output.

    Each chunk's list is added up in place, then the chunk sums are added per
    key (a partial aggregate), so no key's values are gathered again.  For
    data not yet grouped, ``fold_repeats`` does the same without the lists.
    """
    keys = _as_list(key)
    per_chunk = F.aggregate(values, F.lit(0).cast("long"), lambda acc, v: acc + F.coalesce(v, F.lit(0)))
    total = F.sum(per_chunk)
    if factor != 1:
        total = total * F.lit(factor)
    return grouped.groupBy(*keys).agg(total.alias(out))


def fold_repeats(
    df: DataFrame, key: str | Sequence[str] = "key", value: str = "value", factor: int = 1, out: str = "value"
) -> DataFrame:
    """``(key, factor * sum of the key's values)``: what ``fold_sum`` gives over the key's list, without the list.

    Repeated values are counted first, so a fold costs one product per
    distinct value of a key.
    """
    keys = _as_list(key)
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(_M))
    total = F.coalesce(F.sum(F.col(value) * F.col(_M)), F.lit(0))
    return counted.groupBy(*keys).agg((total * F.lit(factor) if factor != 1 else total).alias(out))
