"""Personal data: regular expressions propose, checksums confirm, nearby words adjust.

Every kind has a pattern whose leftmost non-overlapping matches are
candidates, a validator that drops false ones (Luhn for payment cards, mod-97
for account numbers, digit counts and ranges), and a prior score.  Words just
before or after a candidate raise or lower the score.  Kinds that stand by
their form alone are kept at any score; the others need ``THRESHOLD``.

Everything is one projection of built-in functions: no shuffle, no Python, and
each text is read once per kind, whatever the number of matches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import as_text, find_each, let, text_or_empty  # noqa: F401

SPAN = "array<struct<start:bigint,rank:int,kind:string,end:bigint,score:double>>"
#: Characters of context before and after a candidate.
BEFORE, AFTER = 48, 24
#: What a raising and a lowering context word add to a score.
RAISE, LOWER = 0.3, -0.3
#: The least score of a kind that needs one.
THRESHOLD = 0.5


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``raises`` and ``lowers`` are alternatives of whole lower-case words;
    ``scored`` kinds are dropped below the threshold.
    """

    name: str
    pattern: str
    prior: float
    raises: str
    lowers: str
    valid: Callable[[Column], Column] | None = None
    scored: bool = False


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def digit_sum(text: Column) -> Column:
    return F.aggregate(F.split(text, ""), F.lit(0), lambda acc, c: acc + F.when(c == "", 0).otherwise(F.ascii(c) - 48))


def luhn(number: Column) -> Column:
    """Whether a number of at most 20 digits passes Luhn's check (longer ones do not).

    Leading zeros add nothing, so the number is filled up to an even length:
    every first digit of a pair is doubled.
    """
    even = F.lpad(number, 20, "0")
    first = F.translate(F.regexp_replace(even, "(.)(.)", "$1"), "0123456789", "0246813579")
    second = F.regexp_replace(even, "(.)(.)", "$2")
    return (F.length(number) <= 20) & (digit_sum(F.concat(first, second)) % 10 == 0)


def mod_97(account: Column) -> Column:
    """Whether an account number (letters and digits, blanks ignored) leaves 1 by ISO 7064 mod 97-10."""
    plain = F.regexp_replace(account, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    value = lambda c: F.position(c, F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")) - 1
    step = lambda acc, c: F.when(c == "", acc).otherwise((acc * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _digit_count(least: int, most: int) -> Callable[[Column], Column]:
    return lambda m: F.length(digits(m)).between(least, most)


def _card(match: Column) -> Column:
    return _digit_count(14, 19)(match) & luhn(digits(match))


def _date(match: Column) -> Column:
    return F.regexp_like(match, F.lit(r"^(?:(?:19|20)[0-9]{2}[-/.](?:0?[1-9]|1[0-2])[-/.](?:0?[1-9]|[12][0-9]|3[01])|(?:0?[1-9]|[12][0-9]|3[01])[-/.](?:0?[1-9]|1[0-2])[-/.](?:19|20)[0-9]{2})$"))


# The patterns match what the kinds' plain forms match, in time linear in the
# text: possessive repetition where nothing can be given back, and starts only
# where a run of the first characters starts (or where the last match ended).
KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.7,
        "e-?mail|mail|mailto|contact|kontakt|correo|courriel|write|reply",
        "noreply|no-reply|example",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        0.5,
        "ip|address|adresse|host|server|client|login|from",
        "version|release|section|chapter|v",
        lambda m: F.regexp_like(m, F.lit(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]?)(?:\.|$)){4}$")),
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?+[0-9]){13,}+",
        0.6,
        "card|visa|mastercard|amex|credit|debit|karte|kreditkarte|carte|tarjeta|payment|cvv|cvc",
        "order|isbn|tracking|serial|invoice|id",
        _card,
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        0.6,
        "phone|tel|telephone|telefon|mobile|cell|call|fax|whatsapp|portable|movil",
        "score|version",
        _digit_count(10, 15),
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![A-Za-z0-9])",
        0.8,
        "iban|account|bank|konto|compte|cuenta|transfer|swift|bic",
        "serial|model|part",
        mod_97,
        True,
    ),
    Kind(
        "national_id",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        0.3,
        "ssn|social|security|insured|taxpayer",
        "order|part|model|serial|phone|fax",
        None,
        True,
    ),
    Kind(
        "birth_date",
        r"(?<![0-9./-])[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}(?![0-9./-])",
        0.3,
        "born|birth|birthday|birthdate|dob|geboren|geburtsdatum|naissance|nacido|nacimiento",
        "due|version|released",
        _date,
        True,
    ),
)


def _holds(context: Column, words: str) -> Column:
    return F.regexp_like(context, F.lit(rf"(?i)(?<![A-Za-z])(?:{words})(?![A-Za-z])"))


def _score(s: Column, kind: Kind) -> Column:
    """Prior of the kind, adjusted by the words around a match; the context ends at the next match of the kind."""
    around = F.concat(F.right(s["before"], F.lit(BEFORE)), F.lit(" \n "), F.left(s["after"], F.lit(AFTER)))
    change = F.when(_holds(around, kind.raises), RAISE).otherwise(0.0) + F.when(_holds(around, kind.lowers), LOWER).otherwise(0.0)
    return F.round(F.lit(kind.prior) + change, 2)


def _kept(s: Column, kind: Kind) -> Column:
    valid = kind.valid(s["match"]) if kind.valid else F.lit(True)
    return valid & (_score(s, kind) >= THRESHOLD) if kind.scored else valid


def spans(text: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """All spans of all kinds with their scores, in order of start, then kind."""

    def of(found: Column, kind: Kind, rank: int) -> Column:
        return F.transform(
            F.filter(found, lambda s: _kept(s, kind)),
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"), s["end"].alias("end"), _score(s, kind).alias("score")
            ),
        ).cast(SPAN)

    found = find_each(text, [k.pattern for k in kinds])
    return let(found, lambda f: F.array_sort(F.concat(*[of(f[i], k, i) for i, k in enumerate(kinds)])))


def detect(docs: DataFrame, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS, out: str = "pii") -> DataFrame:
    """``docs`` with the column ``out``: all spans in order of start, then kind.

    A span is ``(start, rank, kind, end, score)`` in code points, end
    exclusive.  Null and empty texts have no spans; repeated rows are scanned
    each; an older column ``out`` is replaced and all others pass through; an
    empty table gives an empty result.  Spans of different kinds may overlap.
    """
    return docs.withColumn(out, spans(text_or_empty(F.col(f"`{text_col}`")), kinds))


def _replaced(text: Column, kind: Kind) -> Column:
    """``text`` with the spans of one kind replaced by ``[KIND]``, joined from the pieces that ``find_each`` returns."""

    def piece(s: Column) -> Column:
        return F.concat(s["before"], F.when(_kept(s, kind), f"[{kind.name.upper()}]").otherwise(s["match"]))

    def joined(found: Column) -> Column:
        return F.when(F.size(found) == 0, text).otherwise(
            F.concat(F.array_join(F.transform(found, piece), ""), F.coalesce(F.try_element_at(found, F.lit(-1))["after"], F.lit("")))
        )

    return let(find_each(text, [kind.pattern])[0], joined)


def redact(docs: DataFrame, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with every span replaced by ``[KIND]``, one kind after another in the order of ``kinds``; null texts stay null."""
    for kind in kinds:
        docs = docs.withColumn(text_col, _replaced(F.col(f"`{text_col}`"), kind))
    return docs
