"""Summarize the final physical plan of every registered query into PLANS.md.

Usage: python scripts/plan_report.py [sf_dir] [out.md]

Each query runs once (the final adaptive plan exists only after execution);
the result is fetched only to finish the plan, so use a small scale factor.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tallyloom.plans import registry  # noqa: E402
from tallyloom.session import build_session  # noqa: E402

SHUFFLE = re.compile(r"Exchange (hashpartitioning|RoundRobinPartitioning|SinglePartition|rangepartitioning)")


# Queries whose whole final plan is printed in the appendix.
APPENDIX = ("word_count", "cogroup_hot", "branches", "tumbling_sum")

# Why each query shuffles what it shuffles, and what happens at 1000x the data.
NOTES = {
    "word_count": "scan, split and partial count in one stage; one shuffle of partial counts",
    "word_count_kv": "as word_count; the text rendering fuses into the final aggregate's stage",
    "count_per_element": "partial + final count: one shuffle of at most one row per key per map task",
    "pair_text": "as count_per_element",
    "group_values": "ids do not repeat (distinct_values): totals of keys above the chunk size joined from the "
    "left, then one shuffle by (key, salt); every list is bounded; the folds of the lists add the last shuffle",
    "group_values_hot": "duplicates are collapsed first (partial aggregate); each key holds a third of lineitem "
    "and is spread over n / 1000 salts, so no task gathers a whole key",
    "group_lists": "as group_values_hot; every key fits one chunk",
    "sum_per_key_x10": "partial sums; the value list of the reference is never built",
    "group_fold_x10": "repeated (name, 1) rows are counted and folded as products; no list is built",
    "jdbc_counts": "partial sums; null names counted by an observation in the same pass",
    "cogroup": "one union and the group_values plan (one shuffle of the rows); no chain of outer joins",
    "cogroup_hot": "as group_values_hot for two sources; the shared statuses each hold about half of "
    "lineitem, spread over chunks",
    "cogroup_words": "two word counts (one shuffle each); both are partitioned by word, the union keeps "
    "that, so the co-group (at most one count per word and input: no chunking) adds no shuffle",
    "route": "no shuffle: a tag expression in the scan stage",
    "branches": "partial count per tag",
    "branch_steps": "one pass writes all outputs; every step reads its own folder",
    "branch_bolt": "one output alone: its suffix filter is pushed into the Parquet scan; no shuffle",
    "branch_files": "one-pass write partitioned by tag; all rows read back",
    "parse_int": "no shuffle",
    "not_null": "Catalyst turns the null-rejecting filter into an inner join; the small side is "
    "broadcast only under the size bounds",
    "sum_all": "partial sums, then one row per map task to a single partition",
    "tumbling_sum": "partial sums per window: a window holding a third of all rows costs one row per map task",
    "nth_column": "no shuffle; only column 0 is decoded",
    "map_rows": "no shuffle; Python once per Arrow batch",
    "text_word_count": "the documents are written as text files (text sink), then read split by bytes across tasks (text source); partial count per word",
    "catalog_read": "no shuffle; only column 0 is decoded",
    "stream_parse_int": "stateless stream: parse and filter in the scan stage, files committed once per batch",
    "stream_tumbling_sum": "stream state bounded by the watermark; the read of the sink keeps the newest "
    "value per window (partial max_by)",
}


def summarize(plan: str) -> dict[str, str]:
    final = plan.split("== Initial Plan ==")[0]
    kinds = [m.group(1) for line in final.splitlines() if "ReusedExchange" not in line for m in SHUFFLE.finditer(line)]
    return {
        "shuffles": str(len(kinds)) + (f" ({', '.join(sorted(set(kinds)))})" if kinds else ""),
        "reused": str(final.count("ReusedExchange")),
        "broadcasts": str(final.count("BroadcastExchange")),
        "python": "yes" if re.search(r"MapInPandas|ArrowEvalPython|BatchEvalPython", final) else "no",
        "read": "; ".join(sorted(set(re.findall(r"ReadSchema: struct<([^>]*)>", final)))) or "-",
        "pushed": "; ".join(sorted({p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", final) if p})) or "-",
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(ROOT, "PLANS.md")
    spark = build_session("local[8]", shuffle_partitions=8)
    lines = [
        "# Final physical plans of the registered queries",
        "",
        f"Generated by `scripts/plan_report.py` on `{sf_dir}` with adaptive execution on.",
        "Shuffles count the exchanges the final adaptive plan computes; `reused` counts",
        "exchanges read a second time without recomputation.  `read` is the columns the Parquet scan decodes, `pushed`",
        "the filters handed to it.  Stream queries show the plan that reads their output.",
        "",
        "| query | shuffles | reused | broadcasts | python | read | pushed | why |",
        "| --- | --- | --- | --- | --- | --- | --- | --- |",
    ]
    appendix: list[str] = []
    for name, fn in registry.queries().items():
        df = fn(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        if name in APPENDIX:
            tree = plan.split("== Initial Plan ==")[0].rstrip().rstrip("+-").rstrip()
            tree = re.sub(r"#\d+L?", "", tree)  # drop expression ids
            # show the line-separator literals of the text split escaped, not as line breaks
            tree = tree.replace("\r\n|\r|\n", "\\r\\n|\\r|\\n").replace("\r", "\\r")
            tree = tree.replace(", \n, -1)", ", \\n, -1)")
            tree = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: ...", tree)
            appendix += ["", f"### {name}", "", "```", tree, "```"]
        s = summarize(plan)
        lines.append(
            f"| {name} | {s['shuffles']} | {s['reused']} | {s['broadcasts']} | {s['python']} | {s['read']} "
            f"| {s['pushed']} | {NOTES.get(name, '')} |"
        )
        print(lines[-1], flush=True)
    spark.stop()
    lines += ["", "## Appendix: final plans of four queries"] + appendix
    with open(out, "w") as fh:
        fh.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
