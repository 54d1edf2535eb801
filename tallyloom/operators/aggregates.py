"""Keyed aggregations: counts and sums.

All of them aggregate in two phases (a partial aggregate in the map stage,
then one shuffle of partial results), so a hot key costs one partial row per
map task, never a group held in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def count_per_element(df: DataFrame, element: str | Sequence[str] = "word", out: str = "n") -> DataFrame:
    """``(element, n)``: how often each distinct element occurs (64-bit count).

    Null is counted as an element of its own.
    """
    return df.groupBy(*_as_list(element)).agg(F.count(F.lit(1)).alias(out))


def sum_per_key(
    df: DataFrame, key: str | Sequence[str] = "key", value: str = "value", factor: int = 1, out: str = "value"
) -> DataFrame:
    """``(key, factor * sum(value))`` per key, without gathering the values.

    Integral sums are 64-bit; under ANSI mode an overflow raises instead of
    wrapping silently.
    """
    total = F.sum(value)
    if factor != 1:
        total = total * F.lit(factor)
    return df.groupBy(*_as_list(key)).agg(total.alias(out))


def sum_all(df: DataFrame, value: str = "value", out: str = "s") -> DataFrame:
    """One row: the sum of ``value`` over all rows, 0 for empty input.

    Integral values sum to ``bigint`` (ANSI mode raises on overflow).
    """
    return df.agg(F.coalesce(F.sum(value), F.lit(0)).alias(out))
