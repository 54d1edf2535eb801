"""Helpers shared by the operators of this package."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.session import ship_package as ship  # noqa: F401
from tallyloom.session import staging_path, table_path

#: Name of the row number that the operators add.
RID = "_rid"
#: Running sums are built in blocks of this many elements.
_SUM_BLOCK = 128
#: Files whose ranks are broadcast.
MAX_FILES = 100_000
#: Stored rows that one task takes with ease: so few are broadcast, and not dealt out any further.
TASK_ROWS = 50_000


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def materialize(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written to a new folder under the shared folder and read back.

    Cuts lineage like a checkpoint (a lost executor costs nothing that was
    written) and computes ``df`` once instead of once per use.
    """
    spark = df.sparkSession
    path = staging_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(stored: DataFrame, rows: int) -> DataFrame:
    """``stored``, of that many short rows, in no more tasks than ``TASK_ROWS`` each ask for.

    What one task holds is grouped and joined without a shuffle.
    """
    return stored.coalesce(max(1, -(-rows // TASK_ROWS)))


def spread(stored: DataFrame) -> DataFrame:
    """A stored table of short rows as a side of a join: broadcast if it has at most ``TASK_ROWS``."""
    return F.broadcast(stored) if stored.count() <= TASK_ROWS else stored


def number_rows(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """``columns`` of ``docs`` with a row number ``_rid``, unique and ascending in scan order.

    The number depends on how the scan is split, which may differ from one scan
    to the next: numbers of two scans must never meet in a join.  What is read
    more than once is numbered by ``identified``.  Only the named columns are
    taken, so no other column can clash with those an operator adds.
    """
    return docs.select(F.monotonically_increasing_id().alias(RID), *columns)


def identified(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """``columns`` of ``docs`` with a row number ``_rid`` that is the same in every scan.

    Rows of Parquet files are known by the file's rank among the file names
    and their place in the file, so nothing is copied; the ranks, one short row
    per file, are stored, and broadcast up to ``MAX_FILES`` files.  Other rows,
    and those of more files, are numbered once and written with their number.
    """
    if docs.isStreaming:
        raise ValueError("a stream has no stored rows")
    ranks = _file_ranks(docs)
    if ranks is None:
        return materialize(number_rows(docs, *columns), "numbered")
    place = docs.metadataColumn("_metadata")
    # in a struct, no column clashes with those of the join
    rows = docs.select(place["file_path"].alias("_file"), place["row_index"].alias("_place"), F.struct(*columns).alias("_row"))
    met = rows.join(F.broadcast(ranks), "_file")
    return met.select((F.shiftleft("_rank", 40) + F.col("_place")).alias(RID), "_row.*")


def _file_ranks(docs: DataFrame) -> DataFrame | None:
    """``(_file, _rank)`` of the Parquet files that ``docs`` reads directly; None for any other input, or for too many files."""
    try:
        place = docs.metadataColumn("_metadata")
        docs.select(place["row_index"]).schema  # fails where the rows are not those of Parquet files
        files = materialize(docs.select(place["file_path"].alias("_file")).distinct(), "files")
    except AnalysisException:
        return None
    if files.count() > MAX_FILES:
        return None
    return materialize(files.withColumn("_rank", F.row_number().over(Window.orderBy("_file")).cast("long")).coalesce(1), "file-ranks")


def whole_row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct ``row``, to be opened again with ``row.*``."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def identified_rows(docs: DataFrame) -> DataFrame:
    """``(_rid, row)``: whole rows under a number that is the same in every scan."""
    return identified(docs, whole_row(docs))


def keep_rows(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``identified_rows`` whose number is in ``kept (_rid)``, with their own columns."""
    return rows.join(kept.select(RID), RID, "left_semi").select("row.*")


def crc_mod(column: str, divisor: int) -> Column:
    """crc32 of the column as text, modulo ``divisor`` (null columns count as the empty text)."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % divisor


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    A column named inside a lambda is computed again for every element that the
    lambda sees; a lambda's own variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running_small(values: Column) -> Column:
    start = F.array().cast("array<bigint>")
    step = lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + x))
    return F.aggregate(values, start, step)


def running_sums(values: Column, levels: int = 2) -> Column:
    """Inclusive running sums of an array<bigint>.

    Appending to an array copies it, so long arrays are summed in blocks:
    within each block, over the block totals (in blocks again), then both added.
    """
    return let(values, lambda v: _running_sums(v, levels))


def _running_sums(values: Column, levels: int) -> Column:
    n = F.size(values)

    def add_up(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.element_at(b, -1))
        before = running_sums(totals, levels - 1) if levels > 1 else _running_small(totals)
        return let(before, lambda t: F.flatten(F.transform(blocks, lambda b, i: shifted(b, F.coalesce(F.get(t, i - 1), F.lit(0))))))

    def shifted(block: Column, by: Column) -> Column:
        return let(by, lambda d: F.transform(block, lambda x: x + d))

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / _SUM_BLOCK).cast("int")),
        lambda b: _running_small(F.slice(values, b * _SUM_BLOCK + 1, _SUM_BLOCK)),
    )
    return F.when(n == 0, F.array().cast("array<bigint>")).when(n <= _SUM_BLOCK, _running_small(values)).otherwise(
        let(blocks, add_up)
    )


def find_each(text: Column, patterns: list[str]) -> Column:
    """Leftmost non-overlapping matches of every pattern.

    array<array<struct<start, end, match, before, after>>>, in code points, end
    exclusive.  ``before`` and ``after`` are the texts between a match and the
    matches of its pattern next to it.  Matches and the texts between them
    alternate, so running sums of their lengths are the places; every pattern
    goes over the text once.
    """

    def parts(pattern: str) -> Column:
        both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("between"))
        none = F.array().cast("array<string>")
        return F.when(F.regexp_like(text, F.lit(pattern)), both).otherwise(F.struct(none.alias("found"), none.alias("between")))

    def placed(v: Column) -> Column:
        found, between = v["found"], v["between"]
        steps = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, m: (F.length(b) + F.length(m)).cast("bigint"))
        ends = F.zip_with(found, running_sums(steps), lambda m, e: F.struct(m.alias("match"), e.alias("end")))
        around = F.zip_with(
            F.slice(between, 1, F.size(found)), F.slice(between, 2, F.size(found)), lambda b, a: F.struct(b.alias("before"), a.alias("after"))
        )
        return F.zip_with(
            ends,
            around,
            lambda e, x: F.struct(
                (e["end"] - F.length(e["match"])).alias("start"), e["end"].alias("end"), e["match"].alias("match"), x["before"].alias("before"), x["after"].alias("after")
            ),
        )

    return F.transform(F.array(*map(parts, patterns)), placed)


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.format_string("%s:%d:%d", s["kind"], s["start"], s["end"])), ",")


def range_bounds(df: DataFrame, column: str, parts: int) -> list[float]:
    """At most ``parts - 1`` ascending values that cut ``column`` into ranges of similar counts."""
    if parts < 2:
        return []
    cuts = df.approxQuantile(column, [i / parts for i in range(1, parts)], 1 / (4 * parts))
    return sorted(set(cuts))


def range_bucket(value: Column, bounds: list[float]) -> Column:
    """Index of the range that holds ``value``: how many bounds are at most ``value``.

    Looked up in two steps of about sqrt(len(bounds)) comparisons each.
    """
    if not bounds:
        return F.lit(0)
    width = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    array = lambda xs: F.array(*[F.lit(float(x)) for x in xs])
    at_most = lambda xs: F.size(F.filter(xs, lambda b: b <= value.cast("double")))
    block = at_most(array([g[0] for g in groups]))
    inner = F.array(*[array(g) for g in groups])
    return F.when(block == 0, F.lit(0)).otherwise((block - 1) * width + at_most(F.get(inner, block - 1)))


def bucket_of(value: float, bounds: list[float]) -> int:
    return bisect_right(bounds, float(value))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_lengths(sizes: Iterable[int], limit: int) -> Iterable[tuple[int, int]]:
    """Index ranges ``[i, j)`` whose sizes sum to about ``limit``; a larger one goes alone."""
    start, total, i = 0, 0, -1
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if i >= start:
        yield start, i + 1


def by_size(items: Iterable[str], limit: int) -> Iterable[tuple[int, int]]:
    """``by_lengths`` of the items."""
    return by_lengths(map(len, items), limit)


def arrow_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of about ``limit`` bytes of ``column`` (a larger value goes alone).

    A slice shares the memory of its batch, so only what a slice holds is ever
    turned into Python objects, whatever the session's batch size.
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        for i, j in by_lengths((n or 0 for n in sizes), limit):
            yield batch.slice(i, j - i)
