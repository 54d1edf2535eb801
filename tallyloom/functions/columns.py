"""Column expressions shared by the operators.

Every function here returns a ``Column`` built from Spark's own expressions, so
it runs inside whole-stage code generation and never calls Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.fixed import LINE_SEPARATOR_PATTERN, PAIR_TEXT_FORMAT, WORD_SEPARATOR

ColumnOrName = Column | str



def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_words(line: ColumnOrName) -> Column:
    """Array of words of one line, with Java's ``String.split(" ")`` rules.

    One space separates; empty pieces in front and in the middle are kept;
    trailing empty pieces are dropped, so a line of blanks only has no words,
    while the empty line has one empty word.  Spark's ``split`` keeps trailing
    empty pieces, hence the ``rtrim`` (which trims ASCII spaces only) and the
    blank-line guard.  A null line gives a null array, which explodes to nothing.
    """
    line = _col(line)
    blanks_only = (line != "") & (F.rtrim(line) == "")
    return F.when(blanks_only, F.array().cast("array<string>")).otherwise(
        F.split(F.rtrim(line), WORD_SEPARATOR)
    )


def split_lines(text: ColumnOrName) -> Column:
    """Array of the lines of a text value, split as a text-file reader would.

    Text without a carriage return takes the literal ``\\n`` split, which
    skips the regular expression.
    """
    text = _col(text)
    return F.when(text.contains("\r"), F.split(text, LINE_SEPARATOR_PATTERN)).otherwise(F.split(text, "\n"))


def pair_text(key: ColumnOrName, value: ColumnOrName) -> Column:
    """``KV{key, value}`` for an integral value."""
    return F.format_string(PAIR_TEXT_FORMAT, _col(key), _col(value))


def parse_int_tolerant(text: ColumnOrName) -> Column:
    """Text to int; null for null, malformed or out-of-range text.

    Spark's cast trims surrounding blanks and accepts a leading sign.
    """
    return _col(text).try_cast("int")


def parse_int_strict(text: ColumnOrName, label: str = "value") -> Column:
    """Text to int that fails the job on anything Java's ``Integer.valueOf`` rejects.

    Accepted: an optional sign and ASCII digits, within the 32-bit range.
    Rejected (the query raises): null, empty, blanks or line ends around the
    digits, decimals, exponents, hex and out-of-range values.  Independent of the
    session's ANSI setting.
    """
    text = _col(text)
    parsed = text.try_cast("int")
    ok = text.rlike(r"\A[+-]?[0-9]+\z") & parsed.isNotNull()
    message = F.concat(
        F.lit(f"cannot parse {label} as int: "), F.coalesce(F.concat(F.lit("'"), text, F.lit("'")), F.lit("null"))
    )
    return F.when(ok, parsed).otherwise(F.raise_error(message).cast("int"))


def suffix_tag(value: ColumnOrName, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Tag of the first rule whose suffix ends the value, else ``default``.

    ``rules`` is an ordered list of ``(suffix, tag)``; the first match wins,
    exactly one tag per row, and a null value gets the default tag (a null
    condition in ``when`` counts as false).
    """
    value = _col(value)
    expr = None
    for suffix, tag in rules:
        cond = value.endswith(suffix)
        expr = F.when(cond, F.lit(tag)) if expr is None else expr.when(cond, F.lit(tag))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def suffix_branch_predicate(
    value: ColumnOrName, rules: Sequence[tuple[str, str]], default: str, tag: str
) -> Column:
    """Predicate selecting exactly the rows that ``suffix_tag`` gives ``tag``.

    Written on the source column itself (not on a derived tag), so the
    suffix tests reach the Parquet scan as ``StringEndsWith`` filters.
    A rule routes a row when its suffix matches and no earlier rule's does; a
    tag is the union of its rules; the default takes rows no rule matches,
    and null values.
    """
    value = _col(value)
    hits = [value.endswith(suffix) for suffix, _ in rules]
    pred = None
    for i, (_, rule_tag) in enumerate(rules):
        if rule_tag != tag:
            continue
        routed = hits[i]
        for earlier in hits[:i]:
            routed = routed & ~earlier
        pred = routed if pred is None else pred | routed
    if tag == default:
        if not hits:
            return F.lit(True)
        any_hit = hits[0]
        for h in hits[1:]:
            any_hit = any_hit | h
        unrouted = value.isNull() | ~any_hit
        pred = unrouted if pred is None else pred | unrouted
    if pred is None:
        raise ValueError(f"unknown tag {tag!r}")
    return pred
