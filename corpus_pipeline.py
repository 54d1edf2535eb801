"""The training-data pipeline: quality, exact dedup, near dedup, mixing, tokens.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which is written as Parquet and reread as
the next stage's ``docs``.  All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe, exact_dedup, minhash, mixing, quality
from tallyloom.llm.common import documents, materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from ``labels``."""
    return quality.keep_good(docs, documents(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of equal texts."""
    return exact_dedup.keep_first(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (five-word shingles, similarity of 0.8 or more)."""
    return minhash.keep_representatives(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: left out, once, or repeated up to three times."""
    return mixing.mixed(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix: ``doc_id, source, n_tokens, ids, round_trip``."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(docs.select("doc_id", "source", "text"), ranks, public_tokenizers.PATTERN)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return bpe.decode(encoded, ranks).select(
        "doc_id", "source", bpe.count_ids(F.col("ids")).alias("n_tokens"), "ids", same.alias("round_trip")
    )


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: The classifier, the sketches and the encoder cannot be stated in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
