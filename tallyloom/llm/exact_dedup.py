"""Exact dedup by content-defined chunk recipes.

Each normalised text is cut into chunks where its content says so (after a
clause end, at least ``MIN_CHUNK`` and at most ``MAX_CHUNK`` characters apart),
so equal passages give equal chunks wherever they stand.  A chunk's identifier
is its 64-bit hash, *verified*: all distinct chunks are grouped by identifier
and where two contents share one, each content gets its own variant number.  A
document's recipe is the ordered list of its verified identifiers, and two
texts are equal exactly when their recipes are.  Only distinct chunks (after a
map-side reduction) and recipes are shuffled; whole documents never move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import RID, keep_rows, materialize, identified, identified_rows, text_or_empty

#: White space runs that are not already one space.
_SPACES = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
MIN_CHUNK, MAX_CHUNK = 128, 1024
_CHUNK = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK - 2}}}?(?:[.,;:!?%$#&*|] (?=[A-Na-n])|\z)|.{{1,{MAX_CHUNK}}}"


def normalise(text: str | Column) -> Column:
    """Every run of ASCII white space replaced by one space; null becomes empty."""
    return F.regexp_replace(text_or_empty(text), _SPACES, " ")


def chunks(text: Column) -> Column:
    """Content-defined chunks of ``text`` in order; joined together they are the text (none for the empty text)."""
    return F.regexp_extract_all(text, F.lit(_CHUNK), 0)


def chunk_id(chunk: Column, bits: int = 64) -> Column:
    """Identifier of a chunk before verification; fewer ``bits`` force collisions in tests."""
    h = F.xxhash64(chunk)
    return h if bits >= 64 else h.bitwiseAND(F.lit((1 << bits) - 1))


def _verified(numbered: DataFrame, table: DataFrame, bits: int) -> DataFrame:
    """``table`` with the recipe of every row that holds an ambiguous identifier resolved by content."""
    occurrence = numbered.select(RID, F.posexplode(chunks(F.col("_norm"))).alias("pos", "chunk")).withColumn(
        "id", chunk_id(F.col("chunk"), bits)
    )
    # contents are told apart by 128 bits of their SHA-256; those of ambiguous identifiers alone are moved and compared
    content = F.substring(F.unhex(F.sha2("chunk", 256)), 1, 16).alias("content")
    sides = occurrence.select("id", content).groupBy("id").agg(F.min("content").alias("lo"), F.max("content").alias("hi"))
    ambiguous = materialize(sides.filter("lo <> hi").select("id"), "chunk-clash")
    if ambiguous.isEmpty():
        return table
    clash = occurrence.join(ambiguous, "id", "left_semi")
    variant = clash.select("id", "chunk").distinct().withColumn(
        "variant", F.row_number().over(Window.partitionBy("id").orderBy("chunk"))
    )
    fixes = (
        clash.join(variant, ["id", "chunk"])
        .groupBy(RID)
        .agg(F.map_from_entries(F.collect_list(F.struct("pos", "variant"))).alias("fix"))
    )
    resolved = F.transform(
        "recipe", lambda e, i: F.struct(e["id"].alias("id"), F.coalesce(F.try_element_at("fix", i), F.lit(0)).alias("variant"))
    )
    return table.join(fixes, RID, "left").withColumn("recipe", resolved).drop("fix")


def recipes(numbered: DataFrame, id_col: str, bits: int = 64) -> DataFrame:
    """``(_rid, id_col, recipe, text_sha256)`` per row of stored ``(_rid, id_col, _norm)``: the verified chunk identifiers in order."""
    recipe = F.transform(
        chunks(F.col("_norm")), lambda c: F.struct(chunk_id(c, bits).alias("id"), F.lit(0).alias("variant"))
    )
    table = materialize(
        numbered.select(RID, id_col, recipe.alias("recipe"), F.sha2(F.col("_norm"), 256).alias("text_sha256")), "recipes"
    )
    return _verified(numbered, table, bits)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """One row per input row: ``_rid, id_col, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after each run of ASCII white space is
    replaced by one space.  Of equal texts the row with the smallest id stays
    (null ids come last; among rows that repeat one id, the first of the scan).
    A null text counts as empty, and all empty texts are one group.  An empty
    table gives an empty result; other input columns are ignored.
    """
    return _groups(identified(docs, F.col(id_col), normalise(text_col).alias("_norm")), id_col, bits)


def _groups(numbered: DataFrame, id_col: str, bits: int = 64) -> DataFrame:
    """``exact_dedup`` of stored ``(_rid, id_col, _norm)``."""
    table = recipes(numbered, id_col, bits)
    order = F.struct(F.col(id_col).isNull(), F.col(id_col).alias("id"), F.col(RID))
    groups = table.groupBy("recipe").agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
    # the narrow side of a join on recipes: the hash first, so that long lists are seldom compared in full
    key = F.xxhash64("recipe").alias("recipe_hash")
    joined = table.select("*", key).join(groups.select("*", key), ["recipe_hash", "recipe"])
    return joined.select(
        RID,
        id_col,
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col(RID) == F.col(f"first.{RID}")).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that repeat an earlier text; columns unchanged."""
    stored, row = identified_rows(docs), F.col("row")
    numbered = stored.select(RID, row[id_col].alias(id_col), normalise(row[text_col]).alias("_norm"))
    return keep_rows(stored, _groups(numbered, id_col).filter("kept"))
