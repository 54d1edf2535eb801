"""The reference's six programs as Spark jobs built from the operators.

Each job is split in two: a pure ``DataFrame -> DataFrame`` part that tests
can run on any frame, and a thin runner that binds sources and sinks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tallyloom.fixed import JDBC_FACTOR, ROUTING_DEFAULT, ROUTING_RULES
from tallyloom.functions import map_outputs, output
from tallyloom.functions.rows import OutputsFn
from tallyloom.operators import (
    cogroup,
    count_per_element,
    key_ones,
    key_value,
    not_null,
    nth_column,
    pair_text,
    parse_int,
    route,
    sum_per_key,
    text_words,
    words,
)
from tallyloom.operators.routing import SuffixRules, branch_tags, branches
from tallyloom.sinks import tap, write_branches, write_jdbc, write_lines
from tallyloom.sources import read_branches, read_jdbc, read_lines, read_table
from tallyloom.streaming import (
    DEFAULT_WINDOW,
    event_time,
    start_key_upserts,
    start_window_appends,
    start_window_upserts,
    tumbling_sum,
)


# Q1: word count -----------------------------------------------------------

def word_count(lines_df: DataFrame, line: str = "line") -> DataFrame:
    """``(word, n)`` over the lines of ``lines_df``."""
    return count_per_element(words(lines_df, line, "word"), "word", "n")


def word_count_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n)`` over every line of a multi-line text column.

    Scan, split and partial count are one stage; only counts are shuffled.
    """
    return count_per_element(text_words(docs, text, "word"), "word", "n")


def word_count_job(spark: SparkSession, in_path: str, out_path: str | None = None) -> DataFrame:
    """Text files -> words -> counts -> ``KV{word, n}`` lines (written if ``out_path``)."""
    counts = not_null(word_count(read_lines(spark, in_path)))
    text = pair_text(counts, "word", "n", "kv")
    if out_path:
        write_lines(text, out_path)
    return text


def word_count_stream_job(
    lines_df: DataFrame,
    path: str,
    checkpoint: str,
    text: str = "line",
    compact_every: int = 20,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Running word counts of a stream of texts; ``streaming.latest_keys`` reads ``(word, n)`` from ``path``.

    The words of an unbounded stream are unbounded: one count per word is kept
    in state, and the output is compacted by word.
    """
    return start_key_upserts(word_count_text(lines_df, text), path, checkpoint, ["word"], compact_every, trigger)


# Q2: two inputs, word counts co-grouped by word ---------------------------

def word_cogroup(inputs: Mapping[str, DataFrame], line: str = "line", **kwargs) -> DataFrame:
    """``(word, chunk, <tag>...)``: the count list of each input per word.

    Each input's counts hold one row per word, so no list can grow and the
    co-group needs no chunking; both counts come out partitioned by word, so
    it adds no shuffle of its own.
    """
    counted = {tag: word_count(df, line) for tag, df in inputs.items()}
    return cogroup(counted, key="word", value="n", unique_keys=True, **kwargs)


# Q3: route lines to three outputs ------------------------------------------

def line_routing(
    df: DataFrame, column: str = "line", rules: SuffixRules = ROUTING_RULES, default: str = ROUTING_DEFAULT
) -> DataFrame:
    """Each line with the tag of its output."""
    return route(df, column, rules, default)


def line_branches(
    df: DataFrame, column: str = "line", rules: SuffixRules = ROUTING_RULES, default: str = ROUTING_DEFAULT
) -> dict[str, DataFrame]:
    """One frame per output, each filtered at the source."""
    return branches(df, column, rules, default)


def line_branches_written(
    df: DataFrame,
    path: str,
    column: str = "line",
    rules: SuffixRules = ROUTING_RULES,
    default: str = ROUTING_DEFAULT,
) -> dict[str, DataFrame]:
    """Route once, write all outputs in one pass under ``path``, return one frame per output.

    The source is read once however many branches are processed later, and
    the branch inputs are files in ``path`` (put it in the shared folder), so
    a lost executor costs no recomputation of the routing.
    """
    routed = line_routing(df, column, rules, default)
    write_branches(routed, path)
    return read_branches(df.sparkSession, path, branch_tags(rules, default), schema=routed.schema)


def line_branch_steps(
    df: DataFrame,
    path: str,
    steps: Mapping[str, Callable[[DataFrame], DataFrame]],
    column: str = "line",
    rules: SuffixRules = ROUTING_RULES,
    default: str = ROUTING_DEFAULT,
) -> dict[str, DataFrame]:
    """Each output with a step of its own, the source read once: ``{tag: step(rows of tag)}``.

    Outputs without a step pass through unchanged; a step for an unknown tag
    is an error.
    """
    unknown = set(steps) - set(branch_tags(rules, default))
    if unknown:
        raise ValueError(f"no output is tagged {sorted(unknown)}")
    parts = line_branches_written(df, path, column, rules, default)
    return {tag: steps[tag](rows) if tag in steps else rows for tag, rows in parts.items()}


def line_branch_steps_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    steps: Mapping[str, Callable[[DataFrame], DataFrame]],
    column: str = "line",
    rules: SuffixRules = ROUTING_RULES,
    default: str = ROUTING_DEFAULT,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """``line_branch_steps`` on a stream: every micro-batch is routed once and fanned out into the branches' steps.

    A step sees the rows of its output in one micro-batch (without the tag), so
    it is a per-row transform or a partial aggregate that a reader of the
    output adds up; outputs without a step pass through.  Each output is
    written to ``<path>/<tag>/batch=<id>``.  A micro-batch has the same rows
    and the same number when it is replayed after a failure, and replaces the
    folders of its number, so a branch that was written before the failure
    gains nothing and one that was not is completed.
    """
    tags = branch_tags(rules, default)
    unknown = set(steps) - set(tags)
    if unknown:
        raise ValueError(f"no output is tagged {sorted(unknown)}")
    routed = line_routing(df, column, rules, default)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read and routed once, whatever the number of branches
        try:
            for tag in tags:
                rows = batch.filter(F.col("tag") == tag).drop("tag")
                done = steps[tag](rows) if tag in steps else rows
                done.write.mode("overwrite").parquet(f"{path}/{tag}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = routed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def read_stream_branch(spark: SparkSession, path: str, tag: str, schema: StructType | str) -> DataFrame:
    """What ``line_branch_steps_stream`` wrote for one output, with the micro-batch's number as ``batch``.

    ``schema`` is that of the step's result; an output without any batch yet is empty.
    """
    own = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = StructType([*own.fields, StructField("batch", LongType())])
    try:
        return spark.read.schema(whole).parquet(f"{path}/{tag}")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], whole)


def outputs_written(
    df: DataFrame, path: str, fn: OutputsFn, schemas: Mapping[str, StructType | str]
) -> dict[str, DataFrame]:
    """Run a user function with several outputs once and write all of them in one pass; one frame per output.

    A frame reads its own folder and its own columns only.
    """
    tagged = map_outputs(df, fn, schemas)
    write_branches(tagged, path)
    parts = read_branches(df.sparkSession, path, list(schemas), schema=tagged.schema)
    return {name: output(rows, name) for name, rows in parts.items()}


# Q4: JDBC round trip ------------------------------------------------------

def name_counts(rows: DataFrame, name_position: int = 1, factor: int = JDBC_FACTOR) -> tuple[DataFrame, object]:
    """``(name, count)`` with ``count = factor * rows per name`` as text.

    The name is taken by 0-based position.  Rows with a null name are left
    out (the target's key is NOT NULL) and counted in the returned
    observation under ``null_names``, read after the first action.
    """
    pairs = key_ones(rows, name_position, "name", "value")
    pairs, obs = tap(pairs, "name_counts", {"null_names": F.count_if(F.col("name").isNull())})
    summed = sum_per_key(not_null(pairs, ["name"]), "name", "value", factor, "count")
    return summed.select("name", F.col("count").cast("string").alias("count")), obs


def jdbc_round_trip(
    spark: SparkSession,
    source_url: str,
    query: str,
    target_url: str,
    target_table: str,
    name_position: int = 1,
    source_options: Mapping[str, object] | None = None,
    target_options: Mapping[str, object] | None = None,
) -> object:
    """Read a query, count rows per name times ten, append to a table.

    The read must say how it is split over tasks (``partition_column`` with
    ``num_partitions``, or ``predicates``), or state ``single_task=True``.
    Returns the observation with the number of rows read and of null names.
    """
    source_options = dict(source_options or {})
    if not source_options.pop("single_task", False) and not {"partition_column", "predicates"} & set(source_options):
        raise ValueError("give partition_column or predicates, or single_task=True for a read by one task")
    rows = read_jdbc(spark, source_url, query=query, **source_options)
    counts, obs = name_counts(rows, name_position)
    write_jdbc(counts, target_url, target_table, **dict(target_options or {}))
    return obs


# Q5: catalog table, first column as text ----------------------------------

def catalog_first_column(spark: SparkSession, table: str, out: str = "first_col") -> DataFrame:
    return nth_column(read_table(spark, table), 0, out)


# Q6: stream of integer messages, optionally summed per 5-second window ----

def parse_messages(records: DataFrame, strict: bool = True, keep: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Kafka-style ``(key, value, timestamp)`` records -> ``value`` as int."""
    kv = key_value(records, "key", "value", keep=[k for k in keep if k in records.columns])
    return parse_int(kv, "value", strict=strict)


def windowed_int_sums(
    parsed: DataFrame,
    ts: str = "timestamp",
    duration: str = DEFAULT_WINDOW,
    watermark: str | None = None,
) -> DataFrame:
    """``(w_start, w_end, s)`` over the parsed values (nulls dropped first)."""
    return tumbling_sum(not_null(parsed, ["value"]), ts, "value", duration, watermark)


def int_stream_job(
    records: DataFrame,
    out_path: str,
    checkpoint: str,
    watermark: str = "10 seconds",
    duration: str = DEFAULT_WINDOW,
    trigger: Mapping[str, object] | None = None,
    output_mode: str = "update",
    strict: bool = True,
) -> StreamingQuery:
    """Start the windowed integer sum on a record stream (Kafka or files).

    ``update`` (default): changed windows are upserted per micro-batch, read
    the result with ``latest_windows``.  ``append``: each window is written
    once, final, when the watermark passes it.  ``strict=False`` leaves
    malformed messages out instead of failing; each micro-batch's count of
    them appears in the query progress under ``observedMetrics["messages"]``.
    """
    records = event_time(records, "timestamp") if _is_ntz(records, "timestamp") else records
    parsed = _observed_parse(records, strict)
    sums = windowed_int_sums(parsed, "timestamp", duration, watermark)
    if output_mode == "append":
        return start_window_appends(sums, out_path, checkpoint, trigger)
    if output_mode != "update":
        raise ValueError("output_mode must be 'update' or 'append'")
    return start_window_upserts(sums, out_path, checkpoint, trigger)


def int_parse_stream_job(
    records: DataFrame,
    out_path: str,
    checkpoint: str,
    strict: bool = True,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Start the live program: every message parsed to int, non-null values appended to Parquet files.

    With ``strict=False`` malformed messages are left out and counted in the
    query progress under ``observedMetrics["messages"]``.
    """
    parsed = not_null(_observed_parse(records, strict), ["value"])
    writer = parsed.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def _observed_parse(records: DataFrame, strict: bool) -> DataFrame:
    """Parse messages; in tolerant mode count the ones that do not parse."""
    if strict:
        return parse_messages(records)
    observed, _ = tap(
        records, "messages", {"malformed": F.count_if(F.col("value").try_cast("int").isNull())}
    )
    return parse_messages(observed, strict=False)


def _is_ntz(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() == "timestamp_ntz"
