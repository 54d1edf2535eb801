"""Secret scans over an incremental blob ledger.

Every version of a text is addressed by its content (SHA-256).  A ledger table
holds the findings of each (blob, rule version) pair that was ever scanned; a
run scans only the pairs that are not in it, appends them, and joins the
findings back to every path (row) that holds the blob.  A text that a third of
all rows share is thus scanned once, and a new rule version rescans old blobs
for its own rules alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import RID, as_text, find_each, let, materialize, number_rows, text_or_empty  # noqa: F401

SPAN = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"
LEDGER = f"blob string, version string, spans {SPAN}"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


@dataclass(frozen=True)
class RuleSet:
    """Rules scanned together under one version; ``first`` is the rank of its first kind in the order of spans."""

    version: str
    rules: tuple[Rule, ...]
    first: int = 0


#: A run of at least n characters starts where the run of any length does, so
#: the least lengths of these two stand in the pattern.
BASE = RuleSet(
    "base-1",
    (
        Rule(
            "assign",
            r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            6,
            2,
        ),
        Rule("access", r"AKIA[A-Z0-9]{16,}"),
        Rule("hex", r"[0-9a-f]{24,}"),
    ),
)
#: Kinds with an unmistakable form of their own.
ADDED = RuleSet(
    "added-1",
    (
        Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
        Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
        Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
        Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    ),
    first=3,
)


def _spans(found: Column, rule: Rule, rank: int) -> Column:
    if rule.least:
        own = (lambda m: F.regexp_extract(m, rule.pattern, rule.group)) if rule.group else (lambda m: m)
        found = F.filter(found, lambda s: F.length(own(s["match"])) >= rule.least)
    return F.transform(
        found,
        lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), s["end"].alias("end")),
    ).cast(SPAN)


def scan(text: Column, rules: RuleSet) -> Column:
    """All spans of a rule set, in code points, end exclusive, in order of start, then kind."""

    def spans(found: Column) -> Column:
        return F.array_sort(F.concat(*[_spans(found[i], rule, rules.first + i) for i, rule in enumerate(rules.rules)]))

    return let(find_each(text, [rule.pattern for rule in rules.rules]), spans)


def scan_new(docs: DataFrame, ledger: DataFrame | None, rule_sets: list[RuleSet], text_col: str = "text") -> DataFrame:
    """Ledger rows ``(blob, version, spans)`` for the pairs that ``ledger`` does not hold.

    Copies of a blob are reduced to one before the shuffle, map-side first.
    """
    text = text_or_empty(text_col)
    blobs = docs.select(F.sha2(text, 256).alias("blob"), text.alias("text")).dropDuplicates(["blob"])
    versions = F.array(*[F.lit(r.version) for r in rule_sets])
    if ledger is None:
        todo = blobs.withColumn("todo", versions)
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set("version").alias("seen"))  # at most one entry per rule version
        todo = blobs.join(seen, "blob", "left").withColumn(
            "todo", F.array_except(versions, F.coalesce("seen", F.array().cast("array<string>")))
        )
        todo = todo.filter(F.size("todo") > 0)
    parts = [
        F.when(
            F.array_contains("todo", r.version),
            F.struct(F.lit(r.version).alias("version"), scan(F.col("text"), r).alias("spans")),
        )
        for r in rule_sets
    ]
    found = todo.select("blob", F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("f"))
    return found.select("blob", "f.version", "f.spans")


def update_ledger(
    spark: SparkSession, path: str, docs: DataFrame, rule_sets: list[RuleSet], text_col: str = "text", new: bool = False
) -> DataFrame:
    """Scan what the ledger at ``path`` lacks, append it there, and return the whole ledger; ``new`` starts one."""
    known = None if new else spark.read.schema(LEDGER).parquet(path)
    scan_new(docs, known, rule_sets, text_col).write.mode("errorifexists" if new else "append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def findings(
    docs: DataFrame, ledger: DataFrame, rule_sets: list[RuleSet], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(_rid, id_col, blob, <version>...)``: each row of ``docs`` with its blob's spans per rule version.

    A null text counts as empty and has no spans; rows that repeat (in id, text
    or both) each get their blob's spans; other columns are ignored; an empty
    table gives an empty result.
    """
    paths = materialize(number_rows(docs, id_col, F.sha2(text_or_empty(text_col), 256).alias("blob")), "paths")
    wide = ledger.groupBy("blob").agg(
        *[F.any_value(F.when(F.col("version") == r.version, F.col("spans")), ignoreNulls=True).alias(r.version) for r in rule_sets]
    )
    # stored, so that both sides of the join are dealt out by it and a hot blob's paths can be split
    return paths.join(materialize(wide, "findings"), "blob").select(RID, id_col, "blob", *[F.col(f"`{r.version}`") for r in rule_sets])
