"""Row-level operators: projections, parsing and filters.

Each is a ``DataFrame -> DataFrame`` function (usable with ``df.transform``)
made of built-in expressions, valid on batch and streaming frames, and free of
shuffles: they all fuse into the stage of whatever reads the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import pair_text as pair_text_expr
from tallyloom.functions.columns import parse_int_strict, parse_int_tolerant, split_lines, split_words

ColumnRef = str | int


def _name(df: DataFrame, ref: ColumnRef) -> str:
    """Column name from a name or a 0-based position."""
    return df.columns[ref] if isinstance(ref, int) else ref


def lines(df: DataFrame, text: str = "text", out: str = "line", keep: Sequence[str] = ()) -> DataFrame:
    """One row per line of a multi-line text column (split on \\n, \\r\\n, \\r)."""
    return df.select(*keep, F.explode(split_lines(text)).alias(out))


def words(
    df: DataFrame, line: str = "line", out: str = "word", keep: Sequence[str] = (), drop_empty: bool = False
) -> DataFrame:
    """One row per word of each line (Java ``split(" ")`` rules, see ``split_words``).

    ``drop_empty`` removes the empty words that runs of spaces and empty
    lines produce; by default they are kept, as the reference keeps them.
    """
    out_df = df.select(*keep, F.explode(split_words(line)).alias(out))
    if drop_empty:
        out_df = out_df.filter(F.col(out) != "")
    return out_df


def text_words(
    df: DataFrame, text: str = "text", out: str = "word", keep: Sequence[str] = (), drop_empty: bool = False
) -> DataFrame:
    """Words of every line of a multi-line text column, in one pass."""
    return words(lines(df, text, "_line", keep), "_line", out, keep, drop_empty)


def key_ones(df: DataFrame, key: ColumnRef, out_key: str = "key", out_value: str = "value") -> DataFrame:
    """``(key, 1)`` per row; ``key`` is a name or a 0-based column position."""
    return df.select(F.col(_name(df, key)).alias(out_key), F.lit(1).alias(out_value))


def key_value(df: DataFrame, key: str = "key", value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Drop message metadata: keep the key and value (and any columns in ``keep``)."""
    return df.select(F.col(key).alias("key"), F.col(value).alias("value"), *keep)


def parse_int(
    df: DataFrame, text: str = "value", out: str | None = None, strict: bool = True
) -> DataFrame:
    """Parse a text column to ``int``.

    ``strict`` (default) follows Java's ``Integer.valueOf``: any null or
    malformed value fails the query.  ``strict=False`` gives null for such
    values instead; ``parse_int_rejects`` then lists them.
    """
    expr = parse_int_strict(text, text) if strict else parse_int_tolerant(text)
    return df.withColumn(out or text, expr)


def parse_int_rejects(df: DataFrame, text: str = "value") -> DataFrame:
    """Rows whose text the tolerant parse turns into null."""
    return df.filter(parse_int_tolerant(text).isNull())


def nth_column(df: DataFrame, index: int = 0, out: str = "first_col", keep_record: bool = False) -> DataFrame:
    """The column at ``index`` as text (nulls stay null).

    With ``keep_record`` the text is added next to the whole record, which is
    passed on unchanged.
    """
    expr = F.col(df.columns[index]).cast("string").alias(out)
    return df.select(*df.columns, expr) if keep_record else df.select(expr)


def pair_text(df: DataFrame, key: str = "key", value: str = "value", out: str = "kv") -> DataFrame:
    """Render each ``(key, value)`` pair as the text ``KV{key, value}``."""
    return df.select(pair_text_expr(key, value).alias(out))


def scale(df: DataFrame, column: str = "value", factor: int | float = 10, out: str | None = None) -> DataFrame:
    """Multiply a column by a constant (ANSI mode raises on overflow)."""
    return df.withColumn(out or column, F.col(column) * F.lit(factor))


def not_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows where none of ``columns`` (default: all) is null."""
    return df.dropna(how="any", subset=list(columns) if columns else None)
