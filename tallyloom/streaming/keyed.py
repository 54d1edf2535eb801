"""Keyed results of a stream: changed keys per micro-batch, compacted as they pile up.

A running aggregate over an unbounded set of keys (word counts, for instance)
keeps one row of state per key, in RocksDB on the executors' disks with a copy
in the checkpoint folder.  In update mode every micro-batch gives the keys it
changed; each batch writes them into a folder of its own, replaced on replay.
Every so many batches the newest value of every key is written as a base, and
recorded once it is whole: a read takes the newest recorded base and the
batches after it, so it never goes through the whole history.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallyloom.streaming.windows import rocksdb_state

_BATCH = "batch"


def _schema(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add(_BATCH, "long")


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of the latest batch for every key."""
    values = [c for c in rows.columns if c not in (*keys, _BATCH)]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), _BATCH).alias("_tl_row"))
    return newest.select(*keys, "_tl_row.*")


def _current(spark: SparkSession, path: str, schema: StructType, upto: int | None = None) -> DataFrame:
    """All rows that may be newest: those of the newest base before ``upto`` and of the batches after that base."""
    bases = spark.read.schema("base long").parquet(f"{path}/bases")
    base = bases.filter(F.col("base") < upto) if upto is not None else bases
    last = base.agg(F.max("base")).first()[0]
    rows = spark.read.schema(_schema(schema)).parquet(f"{path}/changes")
    if upto is not None:
        rows = rows.filter(F.col(_BATCH) <= upto)
    if last is None:
        return rows
    whole = spark.read.schema(schema).parquet(f"{path}/base-{last}").withColumn(_BATCH, F.lit(last).cast("long"))
    return rows.filter(F.col(_BATCH) > last).unionByName(whole)


def start_key_upserts(
    agg: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    compact_every: int = 20,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Run a keyed streaming aggregate in update mode into ``path``; ``latest_keys`` reads the result.

    After every ``compact_every`` batches the newest value of every key becomes
    a base.  Batch and base folders are named by the batch's number and
    replaced on replay, and a base is recorded after it is written, so a query
    that is stopped anywhere and restarted adds nothing twice.
    """
    spark, schema = agg.sparkSession, agg.schema
    # the folders exist from the start, so that a read before the first batch finds no rows
    spark.createDataFrame([], _schema(schema)).write.mode("append").partitionBy(_BATCH).parquet(f"{path}/changes")
    spark.createDataFrame([], "base long").write.mode("append").parquet(f"{path}/bases")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/changes/{_BATCH}={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            _newest(_current(own, path, schema, batch_id), keys).write.mode("overwrite").parquet(f"{path}/base-{batch_id}")
            own.createDataFrame([(batch_id,)], "base long").coalesce(1).write.mode("append").parquet(f"{path}/bases")

    writer = agg.writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    with rocksdb_state(spark):
        return writer.start()


def latest_keys(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The newest row of every key written by ``start_key_upserts``; ``schema`` is the aggregate's."""
    return _newest(_current(spark, path, schema), keys)
