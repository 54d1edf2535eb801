"""One registered query per operator of this package, over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe, exact_dedup, fingerprint, langid, manifest, minhash, mixing, oracles, pii, quality, repeats, secret_scan, spelling, token_output
from tallyloom.llm.common import crc_mod, documents
from tallyloom.session import staging_path

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edits(documents(spark, sf_dir))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = langid.predict(docs, langid.train(docs))
    return found.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "n_words", "n_switches")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rule_sets = [secret_scan.BASE, secret_scan.ADDED]
    # the added rules come later: every blob is known by then, and is scanned for its unseen version alone
    path = staging_path(spark, "ledger")
    secret_scan.update_ledger(spark, path, docs, rule_sets[:1], new=True)
    ledger = secret_scan.update_ledger(spark, path, docs, rule_sets)
    found = secret_scan.findings(docs, ledger, rule_sets)
    base, added = F.col(f"`{secret_scan.BASE.version}`"), F.col(f"`{secret_scan.ADDED.version}`")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(rule.kind) for rule in secret_scan.BASE.rules],
        F.sha2(secret_scan.as_text(base), 256).alias("base_sha256"),
        secret_scan.as_text(F.array_sort(F.concat(base, added))).alias("spans"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded.drop("text"), ranks).select(
        "doc_id",
        bpe.count_ids(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "tokens")
    token_output.write_tokens(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_output.read_tokens(spark, path).select(
        "doc_id", "start", bpe.count_ids(F.col("ids")).alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_dedup(documents(spark, sf_dir), width=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(documents(spark, sf_dir), least_length=5, least_count=3, drop_every=97)
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    base = [k.name for k in pii.KINDS if not k.scored]
    of = lambda kinds: F.filter("pii", lambda s: s["kind"].isin(kinds))
    return pii.detect(docs).select(
        "doc_id",
        *[F.size(of([k])).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(pii.as_text(of(base)), 256).alias("base_sha256"),
        pii.as_text(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda s: F.format_string("%.2f", s["score"])), ",").alias("scores"),
    )


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = manifest.build(documents(spark, sf_dir), tampered=F.when(hit, manifest.lower_ascii(F.col("text")))).proofs()
    folded = found.withColumn("folded_root", manifest.fold(F.coalesce("changed", "digest"), F.col("path")))
    return folded.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.sha2(manifest.proof_text(F.col("path")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES: dict[str, QueryFn] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_langid": op2_langid,
    "op3_secret_scan": op3_secret_scan,
    "op4_quality": op4_quality,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_mixing": op6_mixing,
    "op7_bpe": op7_bpe,
    "op8_token_output": op8_token_output,
    "op9_minhash": op9_minhash,
    "op10_repeats": op10_repeats,
    "op11_spelling": op11_spelling,
    "op12_pii": op12_pii,
    "op13_manifest": op13_manifest,
}

_NORMALISED = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

ORACLE_SQL: dict[str, str] = oracles.ORACLE_SQL | {
    "op5_exact_dedup": (
        f"WITH n AS (SELECT doc_id, {_NORMALISED} AS t FROM documents), "
        "g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t) "
        "SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256 "
        "FROM n JOIN g ON n.t = g.t"
    ),
}


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
