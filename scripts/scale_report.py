"""How the hot-key grouping scales with input size; writes SCALING.md.

Usage: python scripts/scale_report.py [sf_dir] [out.md]

Larger inputs are derived from the given lineitem table: every row is
repeated ``k`` times (``explode(sequence(1, k))``) and the copy number is
folded into the value, so values stay distinct while each return flag keeps
holding a third of all rows.  For each ``k`` the naive plan (one
``collect_list`` per key) and ``group_values`` run through the ``noop``
sink; the report gives seconds, rows per second and the longest list.
"""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from tallyloom.operators import group_values  # noqa: E402
from tallyloom.session import build_session  # noqa: E402

FACTORS = (1, 4, 16)
CHUNK = 10_000


def timed(build) -> tuple[float, object]:
    """Seconds to build and run the query, and the frame."""
    t0 = time.perf_counter()
    df = build()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0, df


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(ROOT, "SCALING.md")
    spark = build_session("local[8]", shuffle_partitions=64, extra_conf={"spark.driver.memory": "16g"})
    base = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_returnflag", "l_orderkey")
    lines = [
        "# Hot-key grouping as the input grows",
        "",
        f"Generated by `scripts/scale_report.py` from `{sf_dir}/lineitem.parquet` (`local[8]`, 64 shuffle",
        "partitions, adaptive execution on).  Input ×k repeats every row k times with distinct values;",
        "each return flag stays a third of all rows.  Time is one run after a warm-up, through the",
        f"`noop` sink, building the query included; `group_values` uses chunks of {CHUNK:,} (a hard",
        "bound).  The naive plan is the fastest on one node but its longest list is a",
        "third of the input: at 100 TB it cannot run; the chunked plans keep every list within the bound.",
        "",
        "| ×k | rows | plan | seconds | rows / s | longest list |",
        "| --- | --- | --- | --- | --- | --- |",
    ]
    for k in FACTORS:
        rows = base.select(
            F.col("l_returnflag").alias("key"), "l_orderkey", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("copy")
        ).select("key", (F.col("l_orderkey") * 100 + F.col("copy")).alias("value"))
        n = base.count() * k
        plans = {
            "naive collect_list": lambda: rows.groupBy("key").agg(F.collect_list("value").alias("values")),
            "group_values": lambda: group_values(rows, chunk_size=CHUNK),
            # an order key repeats at most 7 times within a flag (once per line)
            "group_values, distinct_values": lambda: group_values(rows, chunk_size=CHUNK, distinct_values=True),
        }
        for name, build in plans.items():
            timed(build)  # warm-up
            sec, df = timed(build)
            longest = df.agg(F.max(F.size("values"))).first()[0]
            lines.append(f"| {k} | {n:,} | {name} | {sec:.2f} | {n / sec:,.0f} | {longest:,} |")
            print(lines[-1], flush=True)
    spark.stop()
    with open(out, "w") as fh:
        fh.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
