"""Spelling variants: words one letter apart, found in a bit-sliced position index.

The index of a set of words has a bitset over the words for every (position,
letter).  A word is looked up by a recurrence over its letters that moves whole
bitsets at once: the words that agree so far, and those with one error so far,
kept apart by the shift that the error left (replaced: none; a letter of the
query missing: one back; an extra letter: one ahead).  All queries of a set
move together, one row of bits each.

The vocabulary is cut so that every set is small and no pair is lost or found
twice.  A pair of words with a longer one of ``L`` letters has its error at the
first place where they differ; a set is a class ``(L, a, b)`` of pairs whose
error lies in ``[a, b)``, and in such a pair both words share the ``a`` letters
before and the ``L - b`` letters after.  Words that share these are a block.
Blocks start with the two halves of a word; a block over ``BLOCK`` words is cut
into the halves of its interval, until one place is left, where a block holds
at most one word per letter.  Blocks of a class are packed into sets of about
``SET`` words, which one task compares; the recurrence lets errors begin within
``[a, b)`` alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import materialize, ship, text_or_empty

#: Words of one block and of one set, and letters of a set (long words make smaller ones).
BLOCK, SET, LETTERS = 1024, 2048, 1 << 21
#: Rows of bits moved at a time.
ROWS = 512

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCHEMA = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())])
#: Letters of a word, as the inside of a character class.
LETTER_CLASS = "A-Za-zÀ-ÿ"


def vocabulary(
    docs: DataFrame, least_length: int = 5, least_count: int = 3, drop_every: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(word, n)``: the runs of letters of all texts, A-Z lower-cased, with at least ``least_count`` occurrences.

    With ``drop_every`` a run loses one letter where that number divides the
    crc32 of ``<id>:<run>`` (a null id is empty), the letter at the crc32
    modulo the run's length; lengths count what is left.  Null texts have no
    words, rows that repeat count each, an empty table has no words.
    """
    # a run shorter than the least length cannot become long enough
    pattern = F.lit(f"[{LETTER_CLASS}]{{{least_length},}}")
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id")
    runs = docs.select(key, F.explode(F.regexp_extract_all(text_or_empty(text_col), pattern, F.lit(0))).alias("run"))
    lowered = F.when(F.octet_length("run") == F.length("run"), F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER))
    runs = runs.select("id", lowered.alias("run"))
    if drop_every:
        runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        dropped = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
        runs = runs.select(F.when(F.col("h") % drop_every == 0, dropped).otherwise(F.col("run")).alias("run"))
    words = runs.filter(F.length("run") >= least_length).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))
    return words.filter(F.col("n") >= least_count)


def _cut(rows: DataFrame, intervals: Column) -> DataFrame:
    """``(word, n, long, a, b, block)`` for every ``(long, a, b)`` of ``intervals``."""
    each = rows.select("word", "n", F.explode(intervals).alias("c")).select("word", "n", "c.*")
    block = F.xxhash64("long", "a", "b", F.substr("word", F.lit(1), F.col("a")), F.right("word", F.col("long") - F.col("b")))
    return each.withColumn("block", block)


def _class(long: Column, a: Column, b: Column) -> Column:
    return F.struct(long.alias("long"), a.alias("a"), b.alias("b"))


def _at_most(words: int) -> Column:
    return F.greatest(F.lit(2), F.least(F.lit(words), F.floor(F.lit(LETTERS) / F.col("long"))))


def blocks(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """The words in blocks of bounded size: ``(word, n, long, a, b, block)``."""
    m = F.length("word")
    half = lambda x: F.ceil(x / 2).cast("int")
    halves = F.array(
        *[_class(x, lo, hi) for x in (m, m + 1) for lo, hi in ((F.lit(0), half(x)), (half(x), x))]
    )
    rest = materialize(_cut(words, halves), "blocks")
    done: list[DataFrame] = []
    while True:
        sizes = rest.groupBy("block").agg(F.count("*").alias("c"), F.first("long").alias("long"), F.first("b").alias("b"), F.first("a").alias("a"))
        large = materialize(sizes.filter((F.col("c") > _at_most(block)) & (F.col("b") - F.col("a") > 1)).select("block"), "large-blocks")
        if large.isEmpty():
            done.append(rest)
            break
        done.append(rest.join(large, "block", "left_anti").select(*rest.columns))
        mid = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
        parts = F.array(_class(F.col("long"), F.col("a"), mid), _class(F.col("long"), mid, F.col("b")))
        rest = materialize(_cut(rest.join(large, "block", "left_semi"), parts), "blocks")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


class Index:
    """Bitsets over ``words`` per (position, letter); ``longest`` positions."""

    def __init__(self, words: list[str], longest: int):
        n = len(words)
        letters = np.array(words, f"<U{longest}").view("<u4").reshape(n, longest) if n else np.zeros((0, longest), "<u4")
        known, code = np.unique(letters, return_inverse=True)
        self.codes = code.reshape(n, longest)
        self.lengths = np.array([len(w) for w in words])
        self.width = -(-n // 64)
        self.bits: list[np.ndarray] = []
        self.row = np.zeros((longest, len(known)), np.int32)  # of a letter at a position; 0: no word has it there
        for i in range(longest):
            own, first = np.unique(self.codes[:, i], return_inverse=True)
            at = np.zeros((len(own) + 1, 64 * self.width), bool)
            at[first + 1, np.arange(n)] = True
            present = known[own] > 0  # a word that has ended has no letter
            at[1:][~present] = False
            self.row[i, own] = np.arange(1, len(own) + 1)
            self.bits.append(self._packed(at))

    def _packed(self, flags: np.ndarray) -> np.ndarray:
        return np.packbits(flags, axis=-1, bitorder="little").view("<u8")

    def of_length(self, length: int) -> np.ndarray:
        flags = np.zeros(64 * self.width, bool)
        flags[: len(self.lengths)] = self.lengths == length
        return self._packed(flags)

    def near(self, queries: np.ndarray, long: int, a: int, b: int) -> np.ndarray:
        """Bits, one row per query (numbers of words, all ``long`` or all ``long - 1`` letters): the words one error away.

        The longer word of a pair has ``long`` letters and the first place
        where the two differ lies in ``[a, b)``.
        """
        codes = self.codes[queries]
        m = int(self.lengths[queries[0]])
        exact = np.broadcast_to(self.of_length(long) | self.of_length(long - 1), (len(queries), self.width))
        at = lambda i, j: self.bits[i][self.row[i][codes[:, j]]]
        same = back = ahead = np.zeros_like(exact)
        for i in range(m):
            if i < b:
                here = at(i, i)
                begun = exact & ~here if i >= a else None
                exact = exact & here
            else:
                here, begun = None, None
            if m == long:
                if i > a:
                    same = same & (at(i, i) if here is None else here)
                    back = back & at(i - 1, i)
                if begun is not None:
                    same, back = same | begun, back | begun
            elif i >= a:
                ahead = (ahead if begun is None else ahead | begun) & at(i + 1, i)
        if m == long:
            return same & self.of_length(long) | back & self.of_length(long - 1)
        if b == long:  # the extra letter is the last
            ahead = ahead | exact
        return ahead & self.of_length(long)


def compare(words: list[str], n: np.ndarray, long: int, a: int, b: int) -> pa.Table:
    """For every word with a near one in the class: how many, and the one of largest ``n``, then smallest."""
    index = Index(words, long)
    order = np.lexsort((np.array(words, f"<U{long}"), -n))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    count, best = np.zeros(len(words), np.int64), np.full(len(words), len(words))
    for length in (long, long - 1):
        members = np.flatnonzero(index.lengths == length)
        for i in range(0, len(members), ROWS):
            own = members[i : i + ROWS]
            found = index.near(own, long, a, b)
            r, w = np.nonzero(found)
            q, bit = np.nonzero(np.unpackbits(found[r, w].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            query, other = own[r[q]], 64 * w[q] + bit
            np.add.at(count, query, 1)
            np.minimum.at(best, query, rank[other])
    hit = np.flatnonzero(count)
    form = order[best[hit]]
    return pa.table({"word": [words[i] for i in hit], "n_near": count[hit], "form": [words[i] for i in form], "form_n": n[form]}, SCHEMA)


def nearest(words: DataFrame, block: int = BLOCK, size: int = SET) -> DataFrame:
    """``(word, n_near, form, form_n)`` for every word with near words; ``form`` is the most frequent one (ties: the smallest)."""
    ship(words.sparkSession)
    rows = materialize(blocks(words, block), "packed-blocks")
    classes = rows.groupBy("long", "a", "b").agg(F.count("*").alias("c"))
    sets = classes.select("long", "a", "b", F.ceil(F.col("c") / _at_most(size)).alias("sets"))
    packed = rows.join(sets, ["long", "a", "b"]).withColumn("set", F.pmod("block", F.col("sets")))

    def run(key: tuple, own: pa.Table) -> pa.Table:
        long, a, b, _ = (k.as_py() for k in key)
        return compare(own["word"].to_pylist(), own["n"].to_numpy(), long, a, b)

    found = packed.select("word", "n", "long", "a", "b", "set").groupBy("long", "a", "b", "set").applyInArrow(
        run, "word string, n_near long, form string, form_n long"
    )
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.n")).alias("form_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for the words of ``forms (word, form)`` that have a form: the end of the chain of forms.

    Every step takes all open chains one form further; a form is at least twice
    as frequent as its word, so there are at most log2 of the largest count.
    """
    known = forms.select(F.col("word").alias("at"), F.col("form").alias("next"))
    open_ = forms.filter("form IS NOT NULL").select("word", F.col("form").alias("at"))
    done: list[DataFrame] = []
    while True:
        step = materialize(open_.join(known, "at").select("word", "at", "next"), "chains")
        done.append(step.filter("next IS NULL").select("word", F.col("at").alias("root")))
        open_ = step.filter("next IS NOT NULL").select("word", F.col("next").alias("at"))
        if open_.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def variants(words: DataFrame, ratio: int = 2, block: int = BLOCK, size: int = SET) -> DataFrame:
    """``words (word, n)`` with ``n_near, form, form_n, root``.

    ``form`` is the near word of largest ``n``, if that is at least ``ratio``
    times the word's own, else null; ``root`` is the end of the chain of forms,
    the word itself if it has none.  Words must be distinct, not null and of
    two letters at least; an empty vocabulary gives an empty result.
    """
    words = materialize(words.select("word", "n"), "vocabulary")
    near = words.join(nearest(words, block, size), "word", "left")
    enough = F.col("form_n") >= ratio * F.col("n")
    near = materialize(
        near.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n")
        ),
        "forms",
    )
    ends = roots(near.select("word", "form"))
    return near.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
