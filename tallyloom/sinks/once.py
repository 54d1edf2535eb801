"""Database inserts that a retry or a rerun does not repeat.

Spark commits an insert partition by partition, so a task that is run again
after its commit (its executor was lost, say) inserts its rows again, and so
does a job that is started again.  Here the rows go to a staging table first,
each with its number and the attempt that wrote it; one transaction then moves
one copy of every number to the target and enters ``(job, batch)`` in a ledger
table.  A pair that is in the ledger is not inserted again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tallyloom.session import ship_package, staging_path
from tallyloom.sinks import write_jdbc

LEDGER = "tl_commits"
_ROW, _ATTEMPT = "tl_row", "tl_attempt"


@contextmanager
def _connection(spark: SparkSession, url: str, driver: str | None, user: str | None, password: str | None) -> Iterator:
    jvm = spark.sparkContext._jvm
    if driver:
        jvm.java.lang.Class.forName(driver)
    properties = jvm.java.util.Properties()
    for key, value in (("user", user), ("password", password)):
        if value is not None:
            properties.setProperty(key, value)
    conn = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        yield conn
    finally:
        conn.close()


def _run(conn, sql: str, *values: object) -> int:
    statement = conn.prepareStatement(sql)
    try:
        for i, value in enumerate(values, 1):
            statement.setObject(i, value)
        return statement.executeUpdate()
    finally:
        statement.close()


def _has_table(conn, name: str) -> bool:
    found = conn.getMetaData().getTables(None, None, None, None)
    while found.next():
        if found.getString("TABLE_NAME").lower() == name.lower():
            return True
    return False


def _entered(conn, ledger: str, job: str, batch: int) -> bool:
    statement = conn.prepareStatement(f"SELECT 1 FROM {ledger} WHERE job = ? AND batch = ?")
    try:
        statement.setString(1, job)
        statement.setLong(2, batch)
        return statement.executeQuery().next()
    finally:
        statement.close()


def _with_attempt(rows: DataFrame) -> DataFrame:
    """The rows with the number of the task attempt that hands them on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([attempt] * batch.num_rows, pa.int64())], [*batch.schema.names, _ATTEMPT]
            )

    ship_package(rows.sparkSession)
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(_ATTEMPT, LongType())]))


def write_jdbc_once(
    df: DataFrame,
    url: str,
    table: str,
    job: str,
    batch: int = 0,
    ledger: str = LEDGER,
    column_types: str | None = None,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    **options,
) -> bool:
    """Insert ``df`` into ``table`` unless ``(job, batch)`` was inserted before; whether it was inserted now.

    However often tasks are retried or the call is repeated, every row is
    inserted once.  The target must exist; columns meet its columns by name,
    in any case.  ``column_types`` are the database's types of the staging
    table (as Spark's ``createTableColumnTypes``), where Spark's own choice
    does not suit the target.  The ledger table is made if it is missing.
    ``options`` are those of ``write_jdbc``.
    """
    spark = df.sparkSession
    conn_options = {"driver": driver, "user": user, "password": password}
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    target = reader.options(**{k: v for k, v in conn_options.items() if v is not None}).load()
    named = {c.lower(): c for c in target.columns}
    missing = [c for c in df.columns if c.lower() not in named]
    if missing:
        raise ValueError(f"{table} has no columns {missing}")
    columns = [named[c.lower()] for c in df.columns]
    dialect = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
    quoted = {c: dialect.quoteIdentifier(c) for c in [*columns, _ROW, _ATTEMPT]}
    staging = f"{table}_tl_{uuid.uuid4().hex[:16]}"
    with _connection(spark, url, **conn_options) as conn:
        if not _has_table(conn, ledger):
            _run(conn, f"CREATE TABLE {ledger} (job VARCHAR(200) NOT NULL, batch BIGINT NOT NULL, PRIMARY KEY (job, batch))")
        if _entered(conn, ledger, job, batch):
            return False
        # numbered and stored, so that every attempt of a task sees the same rows under the same numbers
        path = staging_path(spark, "jdbc-once")
        numbered = df.toDF(*columns).withColumn(_ROW, F.monotonically_increasing_id())
        numbered.write.parquet(path)
        rows = _with_attempt(spark.read.schema(numbered.schema).parquet(path))
        extra = dict(options.pop("extra", None) or {})
        if column_types:
            extra["createTableColumnTypes"] = column_types
        try:
            write_jdbc(rows, url, staging, mode="errorifexists", extra=extra, **conn_options, **options)
            return _move(conn, staging, table, columns, quoted, ledger, job, batch)
        finally:
            if _has_table(conn, staging):
                _run(conn, f"DROP TABLE {staging}")


def _move(conn, staging: str, table: str, columns: list[str], quoted: Mapping[str, str], ledger: str, job: str, batch: int) -> bool:
    """One copy of every staged row into the target and the pair into the ledger, together or not at all."""
    own = ", ".join(quoted[c] for c in columns)
    from_staging = ", ".join(f"s.{quoted[c]}" for c in columns)
    first = f"SELECT {quoted[_ROW]} AS r, MIN({quoted[_ATTEMPT]}) AS a FROM {staging} GROUP BY {quoted[_ROW]}"
    conn.setAutoCommit(False)
    try:
        if _entered(conn, ledger, job, batch):  # by a run at the same time
            conn.rollback()
            return False
        _run(conn, f"INSERT INTO {ledger} (job, batch) VALUES (?, ?)", job, batch)
        _run(
            conn,
            f"INSERT INTO {table} ({own}) SELECT {from_staging} FROM {staging} s JOIN ({first}) k "
            f"ON s.{quoted[_ROW]} = k.r AND s.{quoted[_ATTEMPT]} = k.a",
        )
        conn.commit()
        return True
    except BaseException:
        conn.rollback()
        raise
    finally:
        conn.setAutoCommit(True)


def write_jdbc_once_stream(
    df: DataFrame, checkpoint: str, url: str, table: str, job: str, trigger: Mapping[str, object] | None = None, **options
) -> StreamingQuery:
    """Each micro-batch inserted once, by its number: a batch replayed after a failure adds nothing."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_jdbc_once(batch, url, table, job, batch_id, **options)

    writer = df.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
