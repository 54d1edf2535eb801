"""Sources: literal rows, text files, JDBC queries, catalog tables, Kafka topics
and file streams.  Each returns a lazy DataFrame; nothing is read on the driver.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def from_rows(spark: SparkSession, rows: Iterable, schema: StructType | str = "line string") -> DataFrame:
    """A small frame from literal rows (strings become one-column rows).

    Meant for literals written in a program or a test: the rows travel from
    the driver, so this is not a way to load data.
    """
    data = [(r,) if isinstance(r, str) or r is None else tuple(r) for r in rows]
    return spark.createDataFrame(data, schema)


def read_lines(spark: SparkSession, path: str | Sequence[str], out: str = "line") -> DataFrame:
    """One row per line of the text files at ``path`` (any Hadoop file system path).

    Lines end at ``\\n``, ``\\r\\n`` or ``\\r``; the separators are removed,
    empty lines are kept, a leading byte-order mark is dropped.  Uncompressed
    (or bzip2) files are split across tasks by bytes; a gzip file cannot be
    split and is read by one task, so keep gzip inputs to many small files.
    An HDFS address goes in the path (``hdfs://namenode:port/dir``) or in
    ``spark.hadoop.fs.defaultFS``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.text(paths).withColumnRenamed("value", out)


def read_lines_stream(spark: SparkSession, path: str, out: str = "line", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming twin of ``read_lines``: new files in ``path`` become new lines."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).withColumnRenamed("value", out)


def jdbc_options(
    url: str,
    query: str | None = None,
    table: str | None = None,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetch_size: int | None = 10_000,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for a JDBC query or table.

    Spark refuses ``query`` together with ``partitionColumn``; a partitioned
    read of a query therefore wraps it as a derived table ``(query) q``, and
    each of the ``num_partitions`` tasks reads one range of the column.
    """
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query or table")
    opts: dict[str, str] = {"url": url}
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned read needs lower_bound, upper_bound and num_partitions")
        opts["dbtable"] = f"({query}) q" if query is not None else table  # type: ignore[assignment]
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    elif query is not None:
        opts["query"] = query
    else:
        opts["dbtable"] = table  # type: ignore[assignment]
    for key, value in (("driver", driver), ("user", user), ("password", password)):
        if value is not None:
            opts[key] = value
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    opts.update(extra or {})
    return opts


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str | None = None,
    table: str | None = None,
    predicates: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Rows of a database query or table.

    Parallel reads: either a numeric ``partition_column`` with
    ``num_partitions`` (bounds are asked of the database when not given; see
    ``jdbc_options``), or ``predicates``, one WHERE clause per task.  Column
    choice and simple filters applied later are pushed into the database
    query by Spark.
    """
    if predicates:
        if query is not None:
            table = f"({query}) q"
            query = None
        opts = jdbc_options(url, table=table, **options)
        props = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(url, opts["dbtable"], predicates=list(predicates), properties=props)
    column = options.get("partition_column")
    if column and (options.get("lower_bound") is None or options.get("upper_bound") is None):
        options["lower_bound"], options["upper_bound"] = jdbc_bounds(spark, url, column, query, table, **options)
    return spark.read.format("jdbc").options(**jdbc_options(url, query, table, **options)).load()


def jdbc_bounds(
    spark: SparkSession, url: str, column: str, query: str | None = None, table: str | None = None, **options
) -> tuple[int, int]:
    """``(min, max)`` of a numeric column, asked of the database in one row.

    The bounds only shape the ranges of a partitioned read; rows outside
    them are still read (by the first and last task).
    """
    source = f"({query}) q" if query is not None else table
    conn = {k: options[k] for k in ("driver", "user", "password", "extra") if options.get(k) is not None}
    row = (
        spark.read.format("jdbc")
        .options(**jdbc_options(url, query=f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {source}", **conn))
        .load()
        .first()
    )
    lo, hi = row[0], row[1]
    if lo is None:  # empty source: any range reads nothing
        return 0, 1
    return int(lo), int(hi) + 1


#: Values that a database hands over at most for the ranges of a read.
RANGE_SAMPLE = 10_000


def _literal(value: object) -> str:
    """A value as the database reads it."""
    if isinstance(value, dt.datetime):
        return "{ts '" + value.strftime("%Y-%m-%d %H:%M:%S.%f") + "'}"
    if isinstance(value, dt.date):
        return "{d '" + value.isoformat() + "'}"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, float):
        return repr(value)
    return str(value)


def range_predicates(column: str, cuts: Sequence[object]) -> list[str]:
    """One condition per range between the ascending ``cuts``: every row, nulls too, meets exactly one of them.

    Text is compared by the database's own order, which may not be that of the
    cuts; a range of text therefore leaves out what earlier ranges hold.
    """
    if not cuts:
        return ["1 = 1"]
    marks = [_literal(c) for c in cuts]
    out = [f"{column} < {marks[0]} OR {column} IS NULL"]
    for i in range(1, len(marks) + 1):
        upper = [f"{column} < {marks[i]}"] if i < len(marks) else []
        lower = [f"NOT ({column} < {m})" for m in marks[:i]] if isinstance(cuts[0], str) else [f"{column} >= {marks[i - 1]}"]
        out.append(" AND ".join([*lower, *upper]))
    return out


def jdbc_ranges(
    spark: SparkSession,
    url: str,
    column: str,
    num_partitions: int,
    query: str | None = None,
    table: str | None = None,
    sample: int = RANGE_SAMPLE,
    sample_query: str | None = None,
    **options,
) -> list[str]:
    """Predicates that split a query or table into ``num_partitions`` ranges of similar row counts, for ``read_jdbc``.

    The ranges follow the content: the database counts the rows and hands over
    every so-many-th value of ``column`` (numbers, dates, timestamps or text),
    at most ``sample`` of them, and the ranges are cut at its quantiles.  A
    value that fills several ranges by itself starts one, and the others are left out.
    ``sample_query`` replaces that query where a database has no
    ``ROW_NUMBER() OVER ()``.
    """
    if num_partitions < 1 or sample < 1:
        raise ValueError("num_partitions and sample must be positive")
    source = f"({query}) q" if query is not None else table
    conn = {k: options[k] for k in ("driver", "user", "password", "extra") if options.get(k) is not None}
    ask = lambda sql: spark.read.format("jdbc").options(**jdbc_options(url, query=sql, **conn)).load()
    if sample_query is None:
        total = ask(f"SELECT COUNT(*) AS n FROM {source} WHERE {column} IS NOT NULL").first()[0]
        step = max(1, -(-int(total) // sample))
        numbered = f"SELECT {column} AS v, ROW_NUMBER() OVER () AS rn FROM {source} WHERE {column} IS NOT NULL"
        sample_query = f"SELECT v FROM ({numbered}) s WHERE MOD(rn, {step}) = 0"
    values = sorted(r[0] for r in ask(sample_query).limit(sample + 1).collect() if r[0] is not None)
    cuts: list[object] = []
    for i in range(1, num_partitions):
        if values:
            at = values[len(values) * i // num_partitions]
            if at > values[0] and at not in cuts:
                cuts.append(at)
    return range_predicates(column, cuts)


def read_branches(
    spark: SparkSession, path: str, tags: Sequence[str], tag: str = "tag", schema: StructType | str | None = None
) -> dict[str, DataFrame]:
    """One frame per tag over a folder written by ``sinks.write_branches``.

    Each frame's tag filter prunes the other tags' folders, so a branch
    reads only its own files.  Give ``schema`` (with the tag column) when the
    output may be empty: there is then no file to infer it from.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    rows = reader.parquet(path)
    return {t: rows.filter(F.col(tag) == t) for t in tags}


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the session catalog (Hive metastore when the session has one).

    Metastore address, security and database are session settings, not code:
    ``spark.sql.catalogImplementation=hive`` plus the metastore URI, and
    ``spark-submit --principal/--keytab`` for Kerberos.
    """
    return spark.table(name)


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options for Spark's Kafka source (string keys and values are cast later)."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    opts.update(extra or {})
    return opts


def kafka_records(df: DataFrame) -> DataFrame:
    """Kafka's binary ``key``/``value`` as text, with the record ``timestamp``."""
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp"),
    )


def read_kafka(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """A Kafka topic as a stream of ``(key, value, timestamp)`` text records.

    Needs Spark's Kafka connector on the class path (``--packages``).  Pass
    ``extra={"maxOffsetsPerTrigger": ...}`` to bound each micro-batch when
    catching up on a large backlog; Kafka partitions become Spark tasks.
    """
    reader = spark.readStream.format("kafka").options(**kafka_options(bootstrap_servers, topic, starting_offsets, extra))
    try:
        raw = reader.load()
    except Exception as exc:
        if "kafka" in str(exc).lower() and "data source" in str(exc).lower():
            raise RuntimeError(
                "Spark's Kafka connector is not on the class path; add it with "
                f"--packages org.apache.spark:spark-sql-kafka-0-10_2.13:{spark.version}"
            ) from exc
        raise
    return kafka_records(raw)


def stream_path(path: str) -> str:
    """A path the file stream source accepts.

    The file stream source needs a directory or a glob; a single local file
    is turned into a glob that matches only itself.
    """
    if os.path.isfile(path):
        return path[:-1] + f"[{path[-1]}]"
    return path


def read_stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A stream over the files arriving in ``path``; the schema is required."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(stream_path(path))


__all__ = [
    "from_rows",
    "range_predicates",
    "read_branches",
    "jdbc_bounds",
    "jdbc_options",
    "jdbc_ranges",
    "kafka_options",
    "kafka_records",
    "read_jdbc",
    "read_kafka",
    "read_lines",
    "read_lines_stream",
    "read_stream_files",
    "read_table",
    "stream_path",
]
