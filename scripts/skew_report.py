"""Measure how hot keys are spread over tasks; writes SKEW.md.

Usage: python scripts/skew_report.py [sf_dir] [out.md]

Each scenario runs once (local mode) with Spark's event log written to a new
scratch folder; the report lists, for the last shuffle-reading stage of each
run, the shuffled bytes the busiest task read next to the total, and the
longest value list a grouping built.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from tallyloom.operators import cogroup, group_values, text_words  # noqa: E402
from tallyloom.plans import word_count_text  # noqa: E402
from tallyloom.session import build_session  # noqa: E402


def scenarios(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_returnflag").alias("k"), F.col("l_orderkey").alias("v")
    )
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    status_a = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_linestatus").alias("k"), F.col("l_orderkey").alias("v")
    )
    status_b = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderstatus").alias("k"), F.col("o_orderkey").alias("v")
    )
    tagged = status_a.withColumn("t", F.lit("a")).unionByName(status_b.withColumn("t", F.lit("b")))
    return {
        "lineitem by return flag, naive collect_list (one group per key)": li.groupBy("k").agg(
            F.collect_list("v").alias("vs")
        ),
        "lineitem by return flag, group_values chunk_size=1000": group_values(li, "k", "v", "vs", chunk_size=1000),
        "lineitem by line status and orders by order status, naive co-group (one group per key)": tagged.groupBy(
            "k"
        ).agg(F.collect_list(F.when(F.col("t") == "a", F.col("v"))).alias("vs"),
              F.collect_list(F.when(F.col("t") == "b", F.col("v"))).alias("vs_b")),
        "lineitem by line status and orders by order status, cogroup chunk_size=1000": cogroup(
            {"vs": status_a, "vs_b": status_b}, "k", "v", chunk_size=1000
        ),
        "documents, words before counting (no aggregation)": text_words(docs).repartition(8, "word"),
        "documents, word_count (partial counts before the shuffle)": word_count_text(docs),
    }


def stage_reads(log_dir: str) -> dict[int, dict[int, list[int]]]:
    """job id -> stage id -> shuffle bytes read per task."""
    jobs: dict[int, list[int]] = {}
    reads: dict[int, list[int]] = {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith((".", "appstatus")):
            continue
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    jobs[e["Job ID"]] = [s["Stage ID"] for s in e["Stage Infos"]]
                elif e["Event"] == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    r = m.get("Shuffle Read Metrics") or {}
                    reads.setdefault(e["Stage ID"], []).append(
                        r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
                    )
    return {j: {s: reads[s] for s in stages if s in reads} for j, stages in jobs.items()}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(ROOT, "SKEW.md")
    log_dir = tempfile.mkdtemp(prefix="tallyloom-eventlog-")
    spark = build_session(
        "local[8]",
        shuffle_partitions=8,
        extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false"},
    )
    rows = []
    largest: dict[str, str] = {}
    for name, df in scenarios(spark, sf_dir).items():
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
        rows.append(name)
        if "vs" in df.columns:
            spark.sparkContext.setJobGroup("sizes", "sizes")
            longest = F.size("vs") + (F.size("vs_b") if "vs_b" in df.columns else F.lit(0))
            largest[name] = f"{df.agg(F.max(longest)).first()[0]:,}"
    spark.stop()
    per_job = stage_reads(log_dir)
    lines = [
        "# Hot keys and the busiest task",
        "",
        f"Generated by `scripts/skew_report.py` on `{sf_dir}` (`local[8]`, 8 shuffle partitions), from",
        "Spark's event log.  For the final shuffle-reading stage of each scenario: shuffled bytes read",
        "by the busiest task and by all tasks, the number of tasks that read any data, and for the",
        "grouping scenarios the most values one row holds.  Each return flag is a third of lineitem,",
        "each status about half of lineitem and a third of orders; at 100 TB the naive plans' busiest",
        "task would hold a third or half of a table in one row.",
        "",
        "| scenario | busiest task (bytes) | all tasks (bytes) | tasks with data | longest list |",
        "| --- | --- | --- | --- | --- |",
    ]
    groups = _group_jobs(log_dir)
    for name in rows:
        stages = {}
        for j in groups.get(name, []):
            stages.update(per_job.get(j, {}))
        reading = [(s, r) for s, r in sorted(stages.items()) if sum(r) > 0]
        if not reading:
            continue
        _, reads = reading[-1]
        lines.append(
            f"| {name} | {max(reads):,} | {sum(reads):,} | {sum(1 for r in reads if r)} | {largest.get(name, '-')} |"
        )
        print(lines[-1], flush=True)
    with open(out, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def _group_jobs(log_dir: str) -> dict[str, list[int]]:
    groups: dict[str, list[int]] = {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith((".", "appstatus")):
            continue
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    if g:
                        groups.setdefault(g, []).append(e["Job ID"])
    return groups


if __name__ == "__main__":
    main()
