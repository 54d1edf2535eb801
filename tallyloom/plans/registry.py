"""Registered queries over the driver's tables, each with its DuckDB oracle.

Every query reads whole tables (or data Spark derives from them) and returns a
lazy DataFrame; column names match the oracle's.  Value lists are folded per key
(with what the oracle can tell of their sizes), or joined to text where they are
short, so that an ungrouped table does not pass.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from datetime import timedelta
from collections.abc import Callable, Sequence
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallyloom.fixed import JDBC_FACTOR
from tallyloom.functions import map_rows
from tallyloom.operators import (
    branches,
    cogroup,
    cogroup_stored,
    count_per_element,
    fold_repeats,
    group_values,
    key_ones,
    not_null,
    nth_column,
    pair_text,
    parse_int,
    parse_int_rejects,
    route,
    scale,
    sum_all,
    sum_per_key,
    words,
)
from tallyloom.plans.jobs import (
    catalog_first_column,
    int_parse_stream_job,
    int_stream_job,
    line_branch_steps,
    line_branch_steps_stream,
    name_counts,
    outputs_written,
    read_stream_branch,
    word_count,
    word_count_stream_job,
    word_count_text,
)
from tallyloom.session import staging_path, table_path
from tallyloom.sinks import tap, write_branches, write_bucketed, write_lines
from tallyloom.sources import read_lines, read_stream_files, read_table
from tallyloom.streaming import batch_metrics, event_time, latest_keys, latest_windows, open_windows, record_metrics, tumbling_sum

QueryFn = Callable[[SparkSession, str], DataFrame]

# Routing rules of the registered routing queries over part names.
PART_RULES = [("bolt", "bolt"), ("ring", "ring")]
PART_DEFAULT = "other"
# Chunk size of the registered group/co-group queries: small enough that the
# larger keys at sf0.01 are split into several chunks.
SMALL_CHUNK = 50
# Chunk size of the hot-key query: each return flag holds a third of lineitem.
HOT_CHUNK = 1000


# Files of one micro-batch of the registered streams.
STREAM_FILES = 16


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _events_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``k``: the integer message text of ``props.k`` parsed strictly."""
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", F.get_json_object("props", "$.k").alias("k"))
    return parse_int(ev, "k")


# ---------------------------------------------------------------- queries

def q_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count_text(_t(spark, sf_dir, "documents"))


def q_word_count_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch word-count program: words -> counts -> non-null -> ``KV{word, n}``."""
    counts = not_null(word_count_text(_t(spark, sf_dir, "documents")))
    return pair_text(counts, "word", "n", "kv")


def q_count_per_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_per_element(_t(spark, sf_dir, "events"), "event_type", "n")


def q_pair_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_text(count_per_element(_t(spark, sf_dir, "events"), "event_type", "n"), "event_type", "n", "kv")


def _chunk_facts(grouped: DataFrame, lists: Sequence[str]) -> DataFrame:
    """Per key and list, folded from the lists themselves: ``k, side, n, s, lo, hi``, and the
    sizes of the key's chunks: ``chunks``, ``longest`` (values of all lists in one row)."""
    sizes = sum((F.size(c) for c in lists), F.lit(0))
    sides = ", ".join(f"'{c}', `{c}`" for c in lists)
    rows = grouped.withColumn("size", sizes).selectExpr("k", "chunk", "size", f"stack({len(lists)}, {sides}) AS (side, vs)")
    add = lambda acc, v: acc + v
    return rows.groupBy("k", "side").agg(
        F.sum(F.size("vs")).cast("long").alias("n"),
        F.sum(F.aggregate("vs", F.lit(0).cast("long"), add)).alias("s"),
        F.min(F.array_min("vs")).alias("lo"),
        F.max(F.array_max("vs")).alias("hi"),
        F.count(F.lit(1)).alias("chunks"),
        F.max("size").alias("longest"),
    )


def _chunk_check(grouped: DataFrame, lists: Sequence[str], chunk_size: int) -> DataFrame:
    """``_chunk_facts`` with the sizes as what the oracle can tell: ``one_chunk`` (the key has one
    row) and ``bounded`` (no row's lists hold more than ``chunk_size`` values)."""
    facts = _chunk_facts(grouped, lists)
    return facts.select(
        "k", "side", "n", "s", "lo", "hi", (F.col("chunks") == 1).alias("one_chunk"), (F.col("longest") <= chunk_size).alias("bounded")
    )


def q_group_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = _t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("v"))
    # customer keys are unique, so no value repeats within a nation
    return _chunk_check(group_values(cust, "k", "v", "vs", SMALL_CHUNK, distinct_values=True), ["vs"], SMALL_CHUNK)


def q_group_values_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three keys, each holding a third of lineitem: every key is split into many chunks."""
    li = _t(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("k"), F.col("l_orderkey").alias("v"))
    return _chunk_check(group_values(li, "k", "v", "vs", HOT_CHUNK), ["vs"], HOT_CHUNK)


def q_group_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that fit one chunk: the whole sorted list of every customer's orders, as text."""
    orders = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"))
    grouped = group_values(orders, "k", "v", "vs", HOT_CHUNK, sort_values=True)
    text = F.array_join(F.transform("vs", lambda v: v.cast("string")), ",")
    return grouped.select("k", "chunk", text.alias("vs"))


def q_sum_per_key_x10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = key_ones(_t(spark, sf_dir, "orders"), "o_orderpriority", "k", "one")
    return sum_per_key(pairs, "k", "one", JDBC_FACTOR, "v")


def q_group_fold_x10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JDBC program's literal shape: (name, 1) pairs grouped, each group folded to a sum, times ten."""
    pairs = key_ones(_t(spark, sf_dir, "customer"), "c_mktsegment", "k", "one")
    return fold_repeats(pairs, "k", "one", JDBC_FACTOR, "v")


def q_jdbc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    counts, _ = name_counts(rows, name_position=1)
    return counts


def q_cogroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("v"))
    b = _t(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("v"))
    # customer and supplier keys are unique, so no value repeats within a nation
    grouped = cogroup({"a": a, "b": b}, "k", "v", chunk_size=SMALL_CHUNK, distinct_values=True)
    return _chunk_check(grouped, ["a", "b"], SMALL_CHUNK)


def q_cogroup_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources sharing hot keys: each status holds about half of lineitem and a third of orders."""
    a = _t(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("k"), F.col("l_orderkey").alias("v"))
    b = _t(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("k"), F.col("o_orderkey").alias("v"))
    return _chunk_check(cogroup({"a": a, "b": b}, "k", "v", chunk_size=HOT_CHUNK), ["a", "b"], HOT_CHUNK)


def q_cogroup_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _t(spark, sf_dir, "part")
    a = count_per_element(words(part, "p_name", "word"), "word", "n")
    b = count_per_element(words(part, "p_type", "word"), "word", "n")
    # One count per word and input, so every list has at most one element.
    grouped = cogroup({"a": a, "b": b}, "word", "n", unique_keys=True)
    as_text = lambda c: F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), ",")
    return grouped.select("word", as_text("a").alias("a"), as_text("b").alias("b"))


def q_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_name")
    return route(part, "p_name", PART_RULES, PART_DEFAULT)


def q_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per output that has any, all outputs in one scan."""
    part = _t(spark, sf_dir, "part").select("p_name")
    return count_per_element(route(part, "p_name", PART_RULES, PART_DEFAULT), "tag", "n")


def q_branch_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A step of its own for every output, the table read once: bolts counted by first word,
    rings in upper case, the rest by their last word."""
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_name")
    one = F.lit(1).cast("long").alias("n")
    steps = {
        "bolt": lambda df: count_per_element(df.select(F.split("p_name", " ")[0].alias("v")), "v", "n"),
        "ring": lambda df: df.select(F.upper("p_name").alias("v"), one),
        PART_DEFAULT: lambda df: df.select(F.element_at(F.split("p_name", " "), -1).alias("v"), one),
    }
    done = line_branch_steps(part, staging_path(spark, "branch-steps"), steps, "p_name", PART_RULES, PART_DEFAULT)
    return reduce(lambda a, b: a.unionByName(b), [df.select(F.lit(tag).alias("tag"), "v", "n") for tag, df in done.items()])


def q_branch_bolt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One output alone: its suffix filter is pushed into the Parquet scan."""
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_name")
    return branches(part, "p_name", PART_RULES, PART_DEFAULT)["bolt"]


def q_branch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routed parts written in one pass, one folder per branch, and all rows read back."""
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_name")
    routed = route(part, "p_name", PART_RULES, PART_DEFAULT)
    path = staging_path(spark, "branches")
    write_branches(routed, path)
    # the known schema also reads an empty output, which has no file to infer from
    return spark.read.schema(routed.schema).parquet(path)


def q_parse_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_k(spark, sf_dir).select("event_id", "k")


def _page_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the last part of their address, which is a number for some."""
    last = F.element_at(F.split("url", "/"), -1)
    return _t(spark, sf_dir, "pages").select("page_id", F.element_at(F.split(last, "[?#]"), 1).alias("part"))


def q_parse_int_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and bad text in one column: null for what does not parse."""
    return parse_int(_page_numbers(spark, sf_dir), "part", "k", strict=False)


def q_parse_int_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the same column that do not parse."""
    return parse_int_rejects(_page_numbers(spark, sf_dir), "part")


def q_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return scale(lines, "l_linenumber", JDBC_FACTOR, "v").select("l_orderkey", F.col("v").cast("long").alias("v"))


def q_tap_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``tap`` counts while the joined rows pass to a sink, as a row."""
    docs, labels = _t(spark, sf_dir, "documents").select("doc_id"), _t(spark, sf_dir, "labels").select("doc_id", "quality")
    metrics = {"unlabelled": F.count_if(F.col("quality").isNull())}
    seen, obs = tap(docs.join(labels, "doc_id", "left"), "labelled", metrics)
    seen.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(obs.get["rows"], obs.get["unlabelled"])], "rows long, unlabelled long")


def q_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").select("doc_id")
    labels = _t(spark, sf_dir, "labels").select("doc_id", "quality")
    return not_null(docs.join(labels, "doc_id", "left"), ["quality"])


def q_sum_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sum_all(_events_k(spark, sf_dir), "k", "s")


def q_tumbling_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling_sum(_events_k(spark, sf_dir), "ts", "k", "5 seconds")


def q_nth_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nth_column(_t(spark, sf_dir, "events"), 0, "first_col")


class _Links(HTMLParser):
    """Targets of the links of a page, in order."""

    def __init__(self, html: str):
        super().__init__()
        self.found: list[str] = []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "a":
            self.found += [value for name, value in attrs if name == "href" and value]


def _page_links(batch: pd.DataFrame) -> pd.DataFrame:
    """Per-element user function: none or more ``(page_id, link, n)`` per page, by an HTML parser."""
    out = []
    for page, html in zip(batch["page_id"], batch["html"]):
        links = Counter(_Links(html).found if html else [])
        out += [(page, link, n) for link, n in links.items()]
    return pd.DataFrame(out, columns=["page_id", "link", "n"])


def q_map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _t(spark, sf_dir, "pages").select("page_id", "html")
    return map_rows(pages, _page_links, "page_id long, link string, n long")


class _Page(HTMLParser):
    """What one parse of a page gives: link targets, comments, start tags."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=False)
        self.links: Counter = Counter()
        self.comments: list[str] = []
        self.tags: Counter = Counter()
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags[tag] += 1
        if tag == "a":
            self.links.update(value for name, value in attrs if name == "href" and value)

    def handle_comment(self, data: str) -> None:
        self.comments.append(data)


#: The outputs of the page parser, each with a schema of its own.
PAGE_OUTPUTS = {
    "links": "page_id long, link string, n long",
    "comments": "page_id long, position int, comment string",
    "tags": "page_id long, n_tags long, n_paragraphs long",
}


def _page_outputs(batch: pd.DataFrame) -> dict[str, pd.DataFrame]:
    """User function with three outputs: none or more links and comments per page, one row of tag counts."""
    rows: dict[str, list[tuple]] = {name: [] for name in PAGE_OUTPUTS}
    for page, html in zip(batch["page_id"], batch["html"]):
        found = _Page(html or "")
        rows["links"] += [(page, link, n) for link, n in found.links.items()]
        rows["comments"] += [(page, i, text) for i, text in enumerate(found.comments)]
        rows["tags"].append((page, found.tags.total(), found.tags["p"]))
    names = {name: [c.split()[0] for c in schema.split(", ")] for name, schema in PAGE_OUTPUTS.items()}
    return {name: pd.DataFrame(own, columns=names[name]) for name, own in rows.items()}


def _page_output(name: str) -> QueryFn:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        pages = _t(spark, sf_dir, "pages").select("page_id", "html")
        return outputs_written(pages, staging_path(spark, "page-outputs"), _page_outputs, PAGE_OUTPUTS)[name]

    query.__doc__ = f"All pages parsed once by a function with three outputs, written in one pass; the output {name} read back."
    return query


def q_text_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word count over text files: the documents are written as text, read back and counted."""
    path = staging_path(spark, "lines")
    write_lines(_t(spark, sf_dir, "documents"), path, "text")
    return word_count(read_lines(spark, path))


def q_catalog_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events through the session catalog, under a name of this run's own that is dropped
    once it is resolved (the table is external: its files stay)."""
    spark.sql("CREATE DATABASE IF NOT EXISTS tallyloom_runs")
    name = f"tallyloom_runs.events_{uuid.uuid4().hex}"
    spark.catalog.createTable(name, path=table_path(sf_dir, "events"), source="parquet")
    column = catalog_first_column(spark, name)
    spark.sql(f"DROP TABLE {name}")
    return column


#: Buckets of the tables that the bucketed query writes.
BUCKETS = 8


def q_bucketed_cogroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and balances summed per customer and co-grouped, from two tables stored by customer:
    once they are written, neither the sums nor the co-group shuffle anything."""
    spark.sql("CREATE DATABASE IF NOT EXISTS tallyloom_runs")
    stored = {}
    orders = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"))
    customers = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.round(F.col("c_acctbal") * 100).cast("long").alias("v"))
    for kind, rows in (("orders", orders), ("customers", customers)):
        name = f"tallyloom_runs.{kind}_{uuid.uuid4().hex}"
        write_bucketed(rows, name, "k", BUCKETS, path=staging_path(spark, f"bucketed-{kind}"))
        stored[kind] = read_table(spark, name)
        stored[kind].schema  # resolved; the table is external, its files stay
        spark.sql(f"DROP TABLE {name}")
    sums = {kind: sum_per_key(rows, "k", "v", 1, "v") for kind, rows in stored.items()}
    grouped = cogroup_stored(sums["orders"], sums["customers"], "k", "v", ["orders", "customers"])
    return grouped.select("k", F.get("orders", F.lit(0)).alias("orders"), F.get("customers", F.lit(0)).alias("cents"))


def _event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of message records ``(key, value, timestamp)``.

    Stands in for a Kafka topic: key = event id, value = the text of ``props.k``.
    """
    path = table_path(sf_dir, "events")
    schema = _t(spark, sf_dir, "events").schema
    return read_stream_files(spark, path, schema, max_files_per_trigger=STREAM_FILES).select(
        F.col("event_id").cast("string").alias("key"),
        F.get_json_object("props", "$.k").alias("value"),
        F.col("ts").alias("timestamp"),
    )


def _finished(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _as_stream(df: DataFrame, kind: str, files: int, per_batch: int = 1) -> DataFrame:
    """``df`` written as about ``files`` files and read as a stream of ``per_batch`` files a micro-batch."""
    path = staging_path(df.sparkSession, kind)
    df.repartition(files).write.parquet(path)
    return read_stream_files(df.sparkSession, path, df.schema, max_files_per_trigger=per_batch)


def q_stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running word counts of the documents as they arrive, over several micro-batches, compacted on the way."""
    docs = _as_stream(_t(spark, sf_dir, "documents").select("text"), "stream-documents", files=8, per_batch=2)
    path = staging_path(spark, "stream-words")
    _finished(
        word_count_stream_job(docs, path, staging_path(spark, "stream-words-ckpt"), "text", compact_every=3, trigger={"availableNow": True})
    )
    return latest_keys(spark, path, StructType().add("word", "string").add("n", "long"), ["word"])


# Routing rules of the streamed branches over event types.
EVENT_RULES = [("click", "click"), ("view", "view")]
EVENT_DEFAULT = "other"


def q_stream_branch_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every output of a routed stream with a step of its own: clicks counted by user, views scaled, the rest in upper case."""
    rows = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    records = _as_stream(rows, "stream-events", files=4)
    own = "v string, n long"
    one = F.lit(1).cast("long").alias("n")
    steps = {
        "click": lambda df: df.groupBy(F.col("user_id").cast("string").alias("v")).agg(F.count("*").alias("n")),
        "view": lambda df: df.select(F.col("event_id").cast("string").alias("v"), (F.col("user_id") * JDBC_FACTOR).alias("n")),
        EVENT_DEFAULT: lambda df: df.select(F.upper("event_type").alias("v"), one),
    }
    path = staging_path(spark, "stream-steps")
    _finished(
        line_branch_steps_stream(
            records, path, staging_path(spark, "stream-steps-ckpt"), steps, "event_type", EVENT_RULES, EVENT_DEFAULT, {"availableNow": True}
        )
    )
    parts = {tag: read_stream_branch(spark, path, tag, own).drop("batch") for tag in steps}
    for tag in ("click", EVENT_DEFAULT):  # partial counts of the micro-batches
        parts[tag] = parts[tag].groupBy("v").agg(F.sum("n").alias("n"))
    return reduce(lambda a, b: a.unionByName(b), [df.select(F.lit(tag).alias("tag"), "v", "n") for tag, df in parts.items()])


def q_stream_tap_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``tap`` counts on a stream, recorded batch by batch by a listener and added up."""
    records = _as_stream(_t(spark, sf_dir, "events").select("event_id", "event_type", "user_id"), "stream-events", files=4)
    metrics = {"errors": F.count_if(F.col("event_type") == "error"), "users": F.sum(F.coalesce("user_id", F.lit(0)))}
    seen, _ = tap(records, "events_seen", metrics)
    path = staging_path(spark, "stream-metrics")
    with record_metrics(spark, path, "events_seen", metrics) as recorder:
        writer = seen.writeStream.format("noop").option("checkpointLocation", staging_path(spark, "stream-metrics-ckpt"))
        query = writer.trigger(availableNow=True).start()
        recorder.follow(query.id)
        _finished(query)
    add = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return batch_metrics(spark, path, metrics).agg(add("rows"), add("errors"), add("users"))


# Slices that a replayed table is cut into by event time, and how late a row may be.
REPLAY_SLICES, REPLAY_LATE = 6, "1 hour"


def _replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as message records in event-time order: equal slices of the time span, written one after another.

    The file source takes files by their age, so a micro-batch never holds a
    row older than the batches before it.
    """
    events = _t(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("key"), F.get_json_object("props", "$.k").alias("value"), F.col("ts").alias("timestamp")
    )
    path = staging_path(spark, "replay")
    lo, hi = events.agg(F.min("timestamp"), F.max("timestamp")).first()
    events.limit(0).write.parquet(path)
    if lo is not None:
        step = (hi - lo) / REPLAY_SLICES + timedelta(microseconds=1)
        for i in range(REPLAY_SLICES):
            at = F.col("timestamp")
            part = events.filter((at >= F.lit(lo + i * step)) & (at < F.lit(lo + (i + 1) * step)))
            part.coalesce(1).write.mode("append").parquet(path)
        untimed = events.filter(F.col("timestamp").isNull())
        untimed.write.mode("append").parquet(path)
    return read_stream_files(spark, path, events.schema, max_files_per_trigger=1)


def q_stream_tumbling_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windowed stream program in append mode: the watermark lies far below the span of the data, so
    finished windows are written and leave the state; those still open at the end are read from the state."""
    out, checkpoint = staging_path(spark, "final-sums"), staging_path(spark, "final-sums-ckpt")
    job = int_stream_job(
        _replay(spark, sf_dir), out, checkpoint, watermark=REPLAY_LATE, duration="5 seconds", trigger={"availableNow": True}, output_mode="append"
    )
    _finished(job)
    done = spark.read.schema("w_start timestamp, w_end timestamp, s long").parquet(out)
    return _as_wall_time(done.unionByName(open_windows(spark, checkpoint)))


def _as_wall_time(sums: DataFrame) -> DataFrame:
    return sums.select(F.col("w_start").cast("timestamp_ntz").alias("w_start"), F.col("w_end").cast("timestamp_ntz").alias("w_end"), "s")


def q_stream_parse_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live stream program: every message parsed to int, non-null ones kept, appended to files."""
    out = staging_path(spark, "stream-ints")
    records = event_time(_event_records(spark, sf_dir), "timestamp")
    _finished(int_parse_stream_job(records, out, staging_path(spark, "stream-ints-ckpt"), trigger={"availableNow": True}))
    return spark.read.parquet(out).select(F.col("key").cast("long").alias("event_id"), F.col("value").alias("k"))


def q_stream_window_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windowed stream program in update mode, over micro-batches of files in any order.

    The watermark is the lateness that the data can have at most: the span of
    its event times (from the file footers), so no row is late.
    """
    lo, hi = _t(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    span = int((hi - lo).total_seconds()) + 1 if lo else 1
    out = staging_path(spark, "window-sums")
    _finished(
        int_stream_job(
            _event_records(spark, sf_dir), out, staging_path(spark, "window-sums-ckpt"),
            watermark=f"{span} seconds", duration="5 seconds", trigger={"availableNow": True},
        )
    )
    return _as_wall_time(latest_windows(spark, out))


QUERIES: dict[str, QueryFn] = {
    "word_count": q_word_count,
    "word_count_kv": q_word_count_kv,
    "count_per_element": q_count_per_element,
    "pair_text": q_pair_text,
    "group_values": q_group_values,
    "group_values_hot": q_group_values_hot,
    "group_lists": q_group_lists,
    "sum_per_key_x10": q_sum_per_key_x10,
    "group_fold_x10": q_group_fold_x10,
    "jdbc_counts": q_jdbc_counts,
    "cogroup": q_cogroup,
    "cogroup_hot": q_cogroup_hot,
    "cogroup_words": q_cogroup_words,
    "route": q_route,
    "branches": q_branches,
    "branch_steps": q_branch_steps,
    "branch_bolt": q_branch_bolt,
    "branch_files": q_branch_files,
    "parse_int": q_parse_int,
    "parse_int_tolerant": q_parse_int_tolerant,
    "parse_int_rejects": q_parse_int_rejects,
    "scale": q_scale,
    "tap_metrics": q_tap_metrics,
    "not_null": q_not_null,
    "sum_all": q_sum_all,
    "tumbling_sum": q_tumbling_sum,
    "nth_column": q_nth_column,
    "map_rows": q_map_rows,
    "text_word_count": q_text_word_count,
    "catalog_read": q_catalog_read,
    "bucketed_cogroup": q_bucketed_cogroup,
    "stream_parse_int": q_stream_parse_int,
    "stream_tumbling_sum": q_stream_tumbling_sum,
    "stream_window_upserts": q_stream_window_upserts,
    "stream_word_count": q_stream_word_count,
    "stream_branch_steps": q_stream_branch_steps,
    "stream_tap_metrics": q_stream_tap_metrics,
    **{f"outputs_{name}": _page_output(name) for name in PAGE_OUTPUTS},
}


# ---------------------------------------------------------------- oracle SQL

_WORDS_OF_DOCS = """
WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
w AS (SELECT unnest(string_split(rtrim(line, ' '), ' ')) AS word FROM l
      WHERE NOT regexp_full_match(line, ' +'))
SELECT word, count(*) AS n FROM w GROUP BY word
"""

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def _words_sql(table: str, column: str) -> str:
    return (
        f"SELECT word, count(*) AS n FROM (SELECT unnest(string_split(rtrim({column}, ' '), ' ')) AS word "
        f"FROM {table} WHERE NOT regexp_full_match({column}, ' +')) GROUP BY word"
    )


_PART_TAG = "CASE WHEN suffix(p_name, 'bolt') THEN 'bolt' WHEN suffix(p_name, 'ring') THEN 'ring' ELSE 'other' END"

_PAGE_PARTS = (
    "SELECT page_id, regexp_split_to_array(string_split(url, '/')[-1], '[?#]')[1] AS part FROM pages"
)
_PAGE_NUMBER = "CASE WHEN regexp_full_match(trim(part), '[+-]?[0-9]+') THEN TRY_CAST(part AS INTEGER) END"


def _chunk_sql(rows: str, sides: list[str], chunk_size: int) -> str:
    """Facts of every key and side of ``rows (k, side, v)``; a side without values has n and s 0."""
    listed = ", ".join(f"('{s}')" for s in sides)
    return (
        f"WITH r AS ({rows}), t AS (SELECT k, count(*) AS total FROM r GROUP BY k) "
        "SELECT t.k AS k, x.side AS side, count(r.v) AS n, CAST(coalesce(sum(r.v), 0) AS BIGINT) AS s, min(r.v) AS lo, "
        f"max(r.v) AS hi, t.total <= {chunk_size} AS one_chunk, true AS bounded "
        f"FROM t CROSS JOIN (VALUES {listed}) x(side) LEFT JOIN r ON r.k = t.k AND r.side = x.side "
        "GROUP BY t.k, x.side, t.total"
    )


_PAGE_LINKS = (
    "SELECT page_id, link, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, "
    "'<a href=\"([^\"]*)\"', 1)) AS link FROM pages) GROUP BY page_id, link"
)

_WINDOW_SUMS = (
    "SELECT time_bucket(INTERVAL '5 seconds', ts) AS w_start, "
    "time_bucket(INTERVAL '5 seconds', ts) + INTERVAL '5 seconds' AS w_end, "
    f"CAST(sum({_K}) AS BIGINT) AS s FROM events GROUP BY 1, 2"
)

ORACLE_SQL: dict[str, str] = {
    "word_count": _WORDS_OF_DOCS,
    "word_count_kv": f"SELECT 'KV{{' || word || ', ' || n || '}}' AS kv FROM ({_WORDS_OF_DOCS}) WHERE word IS NOT NULL",
    "count_per_element": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "pair_text": "SELECT 'KV{' || event_type || ', ' || count(*) || '}' AS kv FROM events GROUP BY event_type",
    "group_values": _chunk_sql("SELECT c_nationkey AS k, 'vs' AS side, c_custkey AS v FROM customer", ["vs"], SMALL_CHUNK),
    "group_values_hot": _chunk_sql("SELECT l_returnflag AS k, 'vs' AS side, l_orderkey AS v FROM lineitem", ["vs"], HOT_CHUNK),
    "group_lists": (
        "SELECT o_custkey AS k, CAST(0 AS BIGINT) AS chunk, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS vs "
        "FROM orders GROUP BY o_custkey"
    ),
    "sum_per_key_x10": "SELECT o_orderpriority AS k, CAST(count(*) * 10 AS BIGINT) AS v FROM orders GROUP BY o_orderpriority",
    "group_fold_x10": "SELECT c_mktsegment AS k, CAST(count(*) * 10 AS BIGINT) AS v FROM customer GROUP BY c_mktsegment",
    "jdbc_counts": (
        "SELECT c_mktsegment AS name, CAST(count(*) * 10 AS VARCHAR) AS count FROM customer "
        "WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment"
    ),
    "cogroup": _chunk_sql(
        "SELECT c_nationkey AS k, 'a' AS side, c_custkey AS v FROM customer "
        "UNION ALL SELECT s_nationkey AS k, 'b' AS side, s_suppkey AS v FROM supplier",
        ["a", "b"], SMALL_CHUNK,
    ),
    "cogroup_hot": _chunk_sql(
        "SELECT l_linestatus AS k, 'a' AS side, l_orderkey AS v FROM lineitem "
        "UNION ALL SELECT o_orderstatus AS k, 'b' AS side, o_orderkey AS v FROM orders",
        ["a", "b"], HOT_CHUNK,
    ),
    "cogroup_words": (
        f"WITH a AS ({_words_sql('part', 'p_name')}), b AS ({_words_sql('part', 'p_type')}) "
        "SELECT coalesce(a.word, b.word) AS word, coalesce(CAST(a.n AS VARCHAR), '') AS a, "
        "coalesce(CAST(b.n AS VARCHAR), '') AS b FROM a FULL OUTER JOIN b ON a.word = b.word"
    ),
    "route": f"SELECT p_partkey, p_name, {_PART_TAG} AS tag FROM part",
    "branches": f"SELECT {_PART_TAG} AS tag, count(*) AS n FROM part GROUP BY 1",
    "branch_bolt": "SELECT p_partkey, p_name FROM part WHERE suffix(p_name, 'bolt')",
    "branch_files": f"SELECT p_partkey, p_name, {_PART_TAG} AS tag FROM part",
    "branch_steps": (
        "SELECT 'bolt' AS tag, string_split(p_name, ' ')[1] AS v, count(*) AS n FROM part WHERE suffix(p_name, 'bolt') GROUP BY 2 "
        "UNION ALL SELECT 'ring' AS tag, upper(p_name) AS v, 1 AS n FROM part WHERE suffix(p_name, 'ring') "
        "UNION ALL SELECT 'other' AS tag, string_split(p_name, ' ')[-1] AS v, 1 AS n FROM part "
        "WHERE NOT suffix(p_name, 'bolt') AND NOT suffix(p_name, 'ring')"
    ),
    "parse_int_tolerant": f"SELECT page_id, part, {_PAGE_NUMBER} AS k FROM ({_PAGE_PARTS})",
    "parse_int_rejects": f"SELECT page_id, part FROM ({_PAGE_PARTS}) WHERE {_PAGE_NUMBER} IS NULL",
    "scale": "SELECT l_orderkey, CAST(l_linenumber * 10 AS BIGINT) AS v FROM lineitem",
    "tap_metrics": (
        "SELECT count(*) AS rows, count(*) FILTER (WHERE l.quality IS NULL) AS unlabelled "
        "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
    ),
    "parse_int": f"SELECT event_id, {_K} AS k FROM events",
    "not_null": (
        "SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id "
        "WHERE l.quality IS NOT NULL"
    ),
    "sum_all": f"SELECT CAST(coalesce(sum({_K}), 0) AS BIGINT) AS s FROM events",
    "tumbling_sum": (
        "SELECT time_bucket(INTERVAL '5 seconds', ts) AS w_start, "
        "time_bucket(INTERVAL '5 seconds', ts) + INTERVAL '5 seconds' AS w_end, "
        f"CAST(sum({_K}) AS BIGINT) AS s FROM events GROUP BY 1, 2"
    ),
    "nth_column": "SELECT CAST(event_id AS VARCHAR) AS first_col FROM events",
    "map_rows": _PAGE_LINKS,
    "text_word_count": _WORDS_OF_DOCS,
    "catalog_read": "SELECT CAST(event_id AS VARCHAR) AS first_col FROM events",
    "bucketed_cogroup": (
        "SELECT coalesce(o.k, c.k) AS k, o.v AS orders, c.v AS cents FROM "
        "(SELECT o_custkey AS k, CAST(sum(o_orderkey) AS BIGINT) AS v FROM orders GROUP BY o_custkey) o FULL OUTER JOIN "
        "(SELECT c_custkey AS k, CAST(sum(round(c_acctbal * 100)) AS BIGINT) AS v FROM customer GROUP BY c_custkey) c ON c.k = o.k"
    ),
    "stream_parse_int": f"SELECT event_id, {_K} AS k FROM events WHERE {_K} IS NOT NULL",
    "stream_tumbling_sum": _WINDOW_SUMS,
    "stream_window_upserts": _WINDOW_SUMS,
    "stream_word_count": _WORDS_OF_DOCS,
    "stream_branch_steps": (
        "SELECT 'click' AS tag, CAST(user_id AS VARCHAR) AS v, count(*) AS n FROM events WHERE suffix(event_type, 'click') GROUP BY 2 "
        "UNION ALL SELECT 'view' AS tag, CAST(event_id AS VARCHAR) AS v, user_id * 10 AS n FROM events WHERE suffix(event_type, 'view') "
        "UNION ALL SELECT 'other' AS tag, upper(event_type) AS v, count(*) AS n FROM events "
        "WHERE NOT suffix(event_type, 'click') AND NOT suffix(event_type, 'view') GROUP BY 2"
    ),
    "stream_tap_metrics": (
        "SELECT count(*) AS rows, count(*) FILTER (WHERE event_type = 'error') AS errors, "
        "CAST(coalesce(sum(user_id), 0) AS BIGINT) AS users FROM events"
    ),
    "outputs_links": _PAGE_LINKS,
    "outputs_comments": (
        "SELECT page_id, CAST(unnest(range(len(c))) AS INTEGER) AS position, unnest(c) AS comment "
        "FROM (SELECT page_id, regexp_extract_all(html, '(?s)<!--(.*?)-->', 1) AS c FROM pages)"
    ),
    "outputs_tags": (
        "SELECT page_id, CAST(len(regexp_extract_all(html, '<[a-zA-Z][^>]*>')) AS BIGINT) AS n_tags, "
        "CAST(len(regexp_extract_all(html, '(?i)<p(\\s[^>]*)?/?>')) AS BIGINT) AS n_paragraphs FROM pages"
    ),
}


def _compact(sql: str) -> str:
    return re.sub(r"\s+", " ", sql).strip()


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: _compact(sql) for name, sql in ORACLE_SQL.items()}
