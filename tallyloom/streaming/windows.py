"""Tumbling-window sums, the same code for batch and streaming frames.

Windows are epoch-aligned and start-inclusive; a window without rows gives no
row.  On a stream the watermark bounds the state: once the watermark passes
a window's end, the window's state is dropped and later rows for it are
dropped as late.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom.fixed import WINDOW_DURATION

DEFAULT_WINDOW = WINDOW_DURATION
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event_time(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Turn a ``timestamp_ntz`` column into ``timestamp``.

    Watermarks accept only ``timestamp``.  The wall time is read in the
    session zone, so with the zone set to UTC the instants equal the naive
    values.
    """
    return df.withColumn(out or column, F.col(column).cast("timestamp"))


def tumbling_sum(
    df: DataFrame,
    ts: str = "ts",
    value: str = "value",
    duration: str = DEFAULT_WINDOW,
    watermark: str | None = None,
    keys: Sequence[str] = (),
    out: str = "s",
) -> DataFrame:
    """``(w_start, w_end, *keys, s)``: sum of ``value`` per tumbling window.

    Integral values sum to ``bigint``, fractional ones keep their type.  An
    all-null window sums to 0, the identity of a sum.
    On a stream ``watermark`` is required for append mode and bounds the
    state in update mode (without it every window stays in state forever).
    """
    if watermark:
        df = df.withWatermark(ts, watermark)
    agg = df.groupBy(F.window(ts, duration).alias("_w"), *keys).agg(F.coalesce(F.sum(value), F.lit(0)).alias(out))
    return agg.select(F.col("_w.start").alias("w_start"), F.col("_w.end").alias("w_end"), *keys, out)


@contextmanager
def _conf(spark: SparkSession, key: str, value: str):
    """Set a session setting while a streaming query starts (the query keeps a
    copy of the session settings taken at start)."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def rocksdb_state(spark: SparkSession):
    """Queries started within keep their state in RocksDB."""
    return _conf(spark, _STATE_STORE, _ROCKSDB)


def start_window_upserts(
    agg: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Run a windowed streaming aggregate in update mode into ``path``.

    Every micro-batch writes the windows it changed into its own folder
    ``batch=<id>``, replacing that folder, so a batch replayed after a failure
    writes the same files again instead of adding duplicates.  State is kept
    until the watermark passes, in RocksDB on the executors' disks (with a
    copy in the checkpoint folder); ``latest_windows`` reads the result.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = agg.writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    with rocksdb_state(agg.sparkSession):
        return writer.start()


def start_window_appends(
    agg: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Run a windowed streaming aggregate in append mode into Parquet files.

    Each window is written once, final, after the watermark passes its end;
    Spark's file sink commits every micro-batch exactly once.  Suited to
    long-running streams; windows still open when a bounded run stops stay in
    state until later data moves the watermark.
    """
    writer = (
        agg.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    with rocksdb_state(agg.sparkSession):
        return writer.start()


def open_windows(spark: SparkSession, checkpoint: str, out: str = "s") -> DataFrame:
    """``(w_start, w_end, out)``: the windows still in the state of a stopped ``tumbling_sum`` query without keys.

    Read from the checkpoint's state store: what an append-mode query has not
    written yet because the watermark has not passed the window's end.
    """
    state = spark.read.format("statestore").load(checkpoint)
    total = F.coalesce(F.col(f"value.{state.schema['value'].dataType.names[0]}"), F.lit(0))
    window = f"key.{state.schema['key'].dataType.names[0]}"
    return state.select(F.col(f"{window}.start").alias("w_start"), F.col(f"{window}.end").alias("w_end"), total.alias(out))


def latest_windows(spark: SparkSession, path: str, value: str = "s") -> DataFrame:
    """The newest value of every window (and key) written by ``start_window_upserts``."""
    rows = spark.read.parquet(path)
    return rows.groupBy(*[c for c in rows.columns if c not in (value, "batch")]).agg(F.max_by(value, "batch").alias(value))


def compact_windows(spark: SparkSession, path: str, out: str, value: str = "s") -> None:
    """Write the newest value of every window under ``path`` to a new table ``out``.

    For long-running update-mode streams, whose sink adds a folder per
    micro-batch: later reads use ``out``; the stream keeps writing to ``path``.
    """
    latest_windows(spark, path, value).write.mode("errorifexists").parquet(out)
