"""Route rows to named outputs.

``route`` adds a tag column (exactly one tag per row, first matching rule
wins, a default for the rest).  ``branches`` gives one frame per tag whose
filter is stated on the source column, so Parquet sources skip row groups by
the suffix test.  To produce all branches in one pass over the input, write the
tagged frame partitioned by tag (``tallyloom.sinks.write_branches``), or cache
it once before taking several branches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tallyloom.functions.columns import suffix_branch_predicate, suffix_tag

SuffixRules = Sequence[tuple[str, str]]


def route(
    df: DataFrame, column: str, rules: SuffixRules, default: str, out: str = "tag"
) -> DataFrame:
    """Add ``out``: the tag of the first ``(suffix, tag)`` rule the column ends with."""
    return df.withColumn(out, suffix_tag(column, rules, default))


def branch_tags(rules: SuffixRules, default: str) -> list[str]:
    tags: list[str] = []
    for _, tag in [*rules, ("", default)]:
        if tag not in tags:
            tags.append(tag)
    return tags


def branches(df: DataFrame, column: str, rules: SuffixRules, default: str) -> dict[str, DataFrame]:
    """``{tag: rows routed to tag}`` -- lazy frames, one per output."""
    return {tag: df.filter(suffix_branch_predicate(column, rules, default, tag)) for tag in branch_tags(rules, default)}
