"""Document fingerprints: a Merkle tree over sections, paragraphs and phrases.

A text is cut into sections (after blank lines), sections into paragraphs
(lines), paragraphs into phrases (after a clause end, at most 64 characters);
the cuts are exact, so the pieces joined are the text.  A phrase's node is its
SHA-256, a paragraph's node hashes its phrases, a section's its paragraphs, the
root its sections.  Equal roots mean equal texts.  Two trees are compared from
the root down: sections first, within the first that differs its paragraphs,
within the first of those its phrases, and the same from the end.  Branches
with equal nodes need no further look, and the two ways down locate the edit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import bucket_of, range_bounds, range_bucket, shuffle_partitions, text_or_empty

_SECTION = r"(?<=\n\n)(?!\n)"
_PARAGRAPH = r"(?<=\n)(?!\z)"
_PHRASE = r"(?s).{1,64}?(?:[.,;:!?|]+\s+|\z)|.{1,64}"


def phrases(text: Column) -> Column:
    """Sections of paragraphs of phrases: array<array<array<string>>>."""
    return F.transform(
        F.split(text, _SECTION, -1),
        lambda s: F.transform(F.split(s, _PARAGRAPH, -1), lambda p: F.regexp_extract_all(p, F.lit(_PHRASE), 0)),
    )


def phrase_nodes(pieces: Column) -> Column:
    """The phrase nodes, nested like the pieces."""
    return F.transform(pieces, lambda s: F.transform(s, lambda p: F.transform(p, lambda x: F.sha2(x, 256))))


def _node(level: str, children: Column) -> Column:
    return F.sha2(F.concat(F.lit(level), F.array_join(children, "")), 256)


def paragraph_nodes(phrase_nodes: Column) -> Column:
    """The paragraph nodes of every section."""
    return F.transform(phrase_nodes, lambda s: F.transform(s, lambda p: _node("p", p)))


def section_nodes(paragraph_nodes: Column) -> Column:
    return F.transform(paragraph_nodes, lambda s: _node("s", s))


def root(section_nodes: Column) -> Column:
    return _node("r", section_nodes)


def _leading(a: Column, b: Column) -> Column:
    """How many elements two arrays have in common at their start; 0 if either is null."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), False)
    common = F.when(differs > 0, differs - 1).otherwise(F.least(F.size(a), F.size(b)))
    return F.when(a.isNotNull() & b.isNotNull(), common).otherwise(0).cast("int")


def _descend(trees: DataFrame, a: str, b: str, out: str, end: bool) -> DataFrame:
    """``trees`` with ``<out>_s, <out>_p, <out>_f``: the way down to where two trees differ first (or last, counted from the end).

    ``s`` sections are equal, then ``p`` paragraphs of the next section, then
    ``f`` phrases of the next paragraph; ``<out>`` counts the phrases of all these.
    """
    turn = F.reverse if end else (lambda x: x)
    col = lambda tree, level: turn(F.col(f"{tree}_{level}"))
    s, p, f = (F.col(f"{out}_{x}") for x in "spf")
    within = lambda tree: turn(F.get(col(tree, "phrases"), s))  # noqa: E731  the paragraphs of the section that differs
    found = trees.withColumn(f"{out}_s", _leading(col(a, "sections"), col(b, "sections")))
    found = found.withColumn(
        f"{out}_p", _leading(turn(F.get(col(a, "paragraphs"), s)), turn(F.get(col(b, "paragraphs"), s)))
    )
    found = found.withColumn(f"{out}_f", _leading(turn(F.get(within(a), p)), turn(F.get(within(b), p))))
    equal = F.size(F.flatten(F.flatten(F.slice(col(a, "phrases"), F.lit(1), s))))
    return found.withColumn(out, equal + F.coalesce(F.size(F.flatten(F.slice(within(a), F.lit(1), p))), F.lit(0)) + f)


def compare(trees: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """``trees`` with ``<out>_near`` (0 to 1), ``<out>_lead`` and ``<out>_trail``: how the trees ``a`` and ``b`` are alike.

    The phrases of equal branches at the start and at the end (``lead``,
    ``trail``) agree as they are; what is between is compared as sets of
    phrases (moved passages).  ``near`` is the Dice coefficient of both, 1 for
    equal roots and less for others.
    """
    found = _descend(_descend(trees, a, b, f"{out}_lead", False), a, b, f"{out}_back", True)
    flat = lambda tree: F.flatten(F.flatten(F.col(f"{tree}_phrases")))
    lead, trail = F.col(f"{out}_lead"), F.col(f"{out}_trail")
    found = found.withColumn(f"{out}_trail", F.least(F.col(f"{out}_back"), F.least(F.size(flat(a)), F.size(flat(b))) - lead))
    middle = lambda tree: F.array_distinct(F.slice(flat(tree), lead + 1, F.size(flat(tree)) - lead - trail))
    found = found.withColumn("_a", middle(a)).withColumn("_b", middle(b))
    both = 2 * (lead + trail)
    total = both + F.size("_a") + F.size("_b")
    near = (both + 2 * F.size(F.array_intersect("_a", "_b"))) / F.greatest(total, F.lit(1))
    near = F.when(F.col(f"{a}_root") == F.col(f"{b}_root"), F.lit(1.0)).otherwise(F.least(near, 1 - 1 / (total + 1.0)))
    return found.withColumn(f"{out}_near", near).drop("_a", "_b")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, next_text)``: the next row's text in ascending id order, after the last row the first's.

    Ids are cut into ranges of similar counts.  Each range takes its rows and a
    copy of the next range's first row, so that no task sees more than a range;
    only the least id of every range comes to the driver.  Null ids go first;
    rows that share an id are in text order.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col(id_col).alias("doc_id"), key.alias("key"), text_or_empty(text_col).alias("text"))
    bounds = range_bounds(rows, "key", shuffle_partitions(spark))
    bucket = range_bucket(F.col("key"), bounds)
    heads = sorted(r["head"] for r in rows.groupBy(bucket.alias("b")).agg(F.min("key").alias("head")).collect())
    if not heads:
        return rows.select("doc_id", "text", F.col("text").alias("next_text"))
    # the range before each head's own; the first head closes the last range
    into = {h: bucket_of(heads[i - 1], bounds) for i, h in enumerate(heads)}
    table = spark.createDataFrame(list(into.items()), "head long, into int")
    placed = rows.withColumn("bucket", bucket).join(F.broadcast(table), F.col("key") == F.col("head"), "left")
    copies = F.array_compact(
        F.array(
            F.struct(F.col("bucket").alias("at"), F.lit(False).alias("guest")),
            F.when(F.col("into").isNotNull(), F.struct(F.col("into").alias("at"), F.lit(True).alias("guest"))),
        )
    )
    placed = placed.select("doc_id", "key", "text", F.explode(copies).alias("c")).select("doc_id", "key", "text", "c.*")
    order = Window.partitionBy("at").orderBy("guest", "key", "text")
    return placed.withColumn("next_text", F.lead("text").over(order)).filter(~F.col("guest")).select("doc_id", "text", "next_text")


def edited(text: Column, next_text: Column) -> Column:
    """``text`` with its last floor(n/4) code points replaced by the first as many (or all) of ``next_text``."""
    n = F.length(text)
    cut = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(next_text, F.lit(1), cut))


def fingerprints(pairs: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``pairs`` with, for every ``text column: prefix``, ``<prefix>_pieces/_phrases/_paragraphs/_sections/_root`` of its tree."""
    out = pairs
    for text, name in columns.items():
        out = out.withColumn(f"{name}_pieces", phrases(F.col(text)))
    for level, below, nodes in (
        ("phrases", "pieces", phrase_nodes), ("paragraphs", "phrases", paragraph_nodes), ("sections", "paragraphs", section_nodes), ("root", "sections", root),
    ):
        for name in columns.values():
            out = out.withColumn(f"{name}_{level}", nodes(F.col(f"{name}_{below}")))
    return out


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses.

    Columns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, edit_start, edit_end, edit_path``.  ``edit_path`` is
    the way down to the first difference between the text and its edited text
    (numbers of the section, of its paragraph, of its phrase); ``edit_start``
    is the place (code points) of that phrase in the text, ``edit_end`` the
    place where the phrases that agree to the end begin; all three are null
    where the roots are equal.  A null text counts as empty; a lone row is its
    own next row; repeated rows are kept; other columns are ignored; an empty
    table gives an empty result.
    """
    pairs = with_next(docs, id_col, text_col).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    trees = fingerprints(pairs, {"text": "own", "edited": "new", "next_text": "next"})
    found = compare(compare(trees, "own", "new", "edit"), "own", "next", "after")
    differ = F.col("own_root") != F.col("new_root")
    flat = F.flatten(F.flatten("own_pieces"))
    chars = lambda pieces: F.length(F.array_join(pieces, "")).cast("long")
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("own_root").alias("fingerprint"),
        F.col("new_root").alias("edited_fingerprint"),
        F.col("edit_near").alias("near_edited"),
        F.col("after_near").alias("near_next"),
        F.when(differ, chars(F.slice(flat, F.lit(1), F.col("edit_lead")))).alias("edit_start"),
        F.when(differ, chars(F.slice(flat, F.lit(1), F.size(flat) - F.col("edit_trail")))).alias("edit_end"),
        F.when(differ, F.array("edit_lead_s", "edit_lead_p", "edit_lead_f")).alias("edit_path"),
    )
