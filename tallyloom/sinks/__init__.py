"""Sinks: text files, JDBC tables, one-pass branch output, and taps.

Writes run in the executors, one task per partition; nothing is gathered on
the driver.  ``tap`` replaces printing every element: it counts rows (and any
other aggregate) while the data flows, and hands the numbers to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_lines(
    df: DataFrame, path: str, column: str | None = None, mode: str = "errorifexists"
) -> dict[str, int]:
    """Write one string column as text lines (one file per partition).

    A null is no line (the text format would make it an empty one): nulls are
    left out.  Returns ``{"rows": rows seen, "null_lines": nulls left out}``,
    counted during the write.
    """
    lines = df.select(F.col(column or df.columns[0]).cast("string").alias("line"))
    seen, obs = tap(lines, "write_lines", {"null_lines": F.count_if(F.col("line").isNull())})
    seen.filter(F.col("line").isNotNull()).write.mode(mode).text(path)
    return dict(obs.get)


def write_lines_stream(
    df: DataFrame, path: str, checkpoint: str, column: str | None = None, trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """Streaming text sink (append only; files are committed exactly once; nulls are left out)."""
    col = F.col(column or df.columns[0]).cast("string").alias("line")
    writer = (
        df.select(col)
        .filter(F.col("line").isNotNull())
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    batch_size: int = 10_000,
    num_partitions: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> None:
    """Insert the rows into a database table, batched per partition.

    ``num_partitions`` caps concurrent connections (Spark coalesces to it).
    ``append`` into a table with a primary key fails on a second run, as a
    plain insert does; use ``mode="overwrite"`` with ``truncate`` or a staging
    table for reruns.
    """
    writer = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
    writer = writer.option("batchsize", str(batch_size))
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    for key, value in (("driver", driver), ("user", user), ("password", password)):
        if value is not None:
            writer = writer.option(key, value)
    for key, value in (extra or {}).items():
        writer = writer.option(key, value)
    writer.save()


def write_jdbc_stream(df: DataFrame, checkpoint: str, url: str, table: str, **options) -> StreamingQuery:
    """Each micro-batch appended to a database table through ``foreachBatch``.

    At least once: a micro-batch replayed after a failure is inserted again,
    which a primary key on the target turns into an error rather than a
    duplicate.
    """

    def write_batch(batch: DataFrame, _batch_id: int) -> None:
        write_jdbc(batch, url, table, **options)

    return df.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).start()


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None, mode: str = "errorifexists") -> None:
    """A catalog table stored by key: ``buckets`` hash buckets, sorted within.

    Grouping by the key, and co-grouping several tables with the same number of
    buckets, then need no exchange: the rows of a key are in one bucket of
    each.  The rows are shuffled to the buckets once, here, so that a task
    writes whole buckets.  ``path`` makes the table external.
    """
    placed = df.repartition(buckets, key)
    writer = placed.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_branches(df: DataFrame, path: str, tag: str = "tag", mode: str = "errorifexists", fmt: str = "parquet") -> None:
    """All routed outputs in one pass: one sub folder ``tag=<t>`` per branch.

    A later read of one branch prunes the others by folder.
    """
    df.write.mode(mode).partitionBy(tag).format(fmt).save(path)


def write_branches_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    tag: str = "tag",
    fmt: str = "parquet",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Streaming twin of ``write_branches``: each micro-batch's rows land in
    their branch's ``tag=<t>`` folder, committed exactly once by the file sink."""
    writer = (
        df.writeStream.format(fmt)
        .partitionBy(tag)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def tap(
    df: DataFrame, name: str, metrics: Mapping[str, Column] | None = None
) -> tuple[DataFrame, Observation | None]:
    """Count rows (and other aggregates) as they pass, without a second job.

    Batch: returns the observed frame and an ``Observation`` whose ``.get``
    gives the metrics after the first action on that frame.  Stream: returns
    ``None`` instead; each micro-batch's metrics appear in the query progress
    under ``observedMetrics[name]``.
    """
    exprs = [F.count(F.lit(1)).alias("rows")]
    exprs += [expr.alias(key) for key, expr in (metrics or {}).items()]
    if df.isStreaming:
        return df.observe(name, *exprs), None
    obs = Observation(name)
    return df.observe(obs, *exprs), obs


def print_rows(df: DataFrame, n: int = 20) -> None:
    """Show the first ``n`` rows, for eyes only (only ``n`` rows reach the driver)."""
    df.show(n, truncate=False)


def console_stream(df: DataFrame, checkpoint: str, output_mode: str = "append", num_rows: int = 20) -> StreamingQuery:
    """Print each micro-batch (first rows only) to the driver's stdout."""
    return (
        df.writeStream.format("console")
        .outputMode(output_mode)
        .option("numRows", str(num_rows))
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
        .start()
    )


__all__ = [
    "console_stream",
    "print_rows",
    "tap",
    "write_branches",
    "write_branches_stream",
    "write_bucketed",
    "write_jdbc",
    "write_jdbc_stream",
    "write_lines",
    "write_lines_stream",
]
