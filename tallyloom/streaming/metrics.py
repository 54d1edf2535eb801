"""Observed metrics of a stream, kept as a table keyed by micro-batch.

``sinks.tap`` on a stream reports each micro-batch's metrics in the query's
progress, which the driver forgets.  ``record_metrics`` attaches a listener
that writes them to a folder per query run and batch, one row each, replaced if a
batch is reported again.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import LongType, StructType


def _schema(metrics: Mapping[str, object]) -> StructType:
    out = StructType()
    for name in metrics:
        out = out.add(name, LongType())
    return out


def _keyed(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add("run", "string").add("batch", "long")


class _Recorder(StreamingQueryListener):
    """Writes the metrics ``tap`` of every batch of one query; ``ended`` is set once the query's last event was handled."""

    def __init__(self, spark: SparkSession, path: str, tap: str, schema: StructType):
        self.spark, self.path, self.tap, self.schema = spark, path, tap, schema
        self.query_id: str | None = None
        self.early: list = []  # progress that came before the caller told which query it listens to
        self.ended, self.error = threading.Event(), None
        self._lock = threading.Lock()

    def follow(self, query_id: str) -> None:
        with self._lock:
            self.query_id = query_id
            for event in self.early:
                self._handle(event)
            self.early = []

    def _handle(self, event) -> None:
        if isinstance(event, tuple):
            run, batch, values = event
            try:
                row = self.spark.createDataFrame([values], self.schema).coalesce(1)
                row.write.mode("overwrite").parquet(f"{self.path}/run={run}/batch={batch}")
            except Exception as exc:  # handed to the caller: what a listener raises is only logged
                self.error = self.error or exc
        else:
            self.ended.set()

    def _take(self, query_id: str, event) -> None:
        with self._lock:
            if self.query_id is None:
                self.early.append(event)
            elif query_id == self.query_id:
                self._handle(event)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        seen = event.progress.observedMetrics.get(self.tap)
        if seen is not None:
            values = tuple(seen[name] for name in self.schema.names)
            self._take(str(event.progress.id), (str(event.progress.runId), event.progress.batchId, values))

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._take(str(event.id), None)


@contextmanager
def record_metrics(spark: SparkSession, path: str, tap: str, metrics: Mapping[str, object]) -> Iterator[_Recorder]:
    """While the block runs, the whole-number ``metrics`` of ``tap`` are written under ``path``, batch by batch.

    Start one query in the block and call ``follow(query.id)`` on what the
    block is given; at the end the block waits until the query's last event
    was handled.  A failed write is raised then.
    """
    schema = _schema({"rows": None, **metrics})
    recorder = _Recorder(spark, path, tap, schema)
    spark.createDataFrame([], _keyed(schema)).write.mode("append").partitionBy("run", "batch").parquet(path)
    spark.streams.addListener(recorder)
    try:
        yield recorder
        if recorder.query_id is not None and not recorder.ended.wait(600):
            raise TimeoutError("the query's end was not reported")
    finally:
        spark.streams.removeListener(recorder)
    if recorder.error:
        raise recorder.error


def batch_metrics(spark: SparkSession, path: str, metrics: Mapping[str, object]) -> DataFrame:
    """``(batch, rows, <metric>...)`` as recorded; a batch that several runs reported counts once.

    A batch that failed is run again after a restart with the same rows, so its
    reports differ only where one was made before the batch was done.
    """
    names = ["rows", *metrics]
    rows = spark.read.schema(_keyed(_schema({"rows": None, **metrics}))).parquet(path)
    return rows.groupBy("batch").agg(*[F.max(n).alias(n) for n in names])
