"""Places where an operator once did less than its whole job."""

from __future__ import annotations

from collections import Counter
from itertools import cycle
from zlib import crc32

import numpy as np
import pytest

from awkward import docs, docs_dir, table  # noqa: F401  (fixtures)

from tallyloom.llm import common, exact_dedup, langid, minhash, mixing, quality, queries, repeats

SPLITS = "spark.sql.files.minPartitionNum"


def rows_of(df):
    return Counter(map(str, df.drop(common.RID).collect()))


OPERATORS = {
    "op5_exact_dedup": lambda docs, labels: exact_dedup.exact_dedup(docs, bits=5),
    "op9_minhash": lambda docs, labels: minhash.near_dedup(docs),
    "op10_repeats": lambda docs, labels: repeats.remove_repeats(docs).drop("kept"),
    "quality stage": quality.keep_good,
    "exact_dedup stage": lambda docs, labels: exact_dedup.keep_first(docs),
    "near_dedup stage": lambda docs, labels: minhash.keep_representatives(docs),
    "mixing stage": lambda docs, labels: mixing.mixed(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_scans_may_be_split_differently(spark, docs, docs_dir, scratch, monkeypatch, name):
    # file sizes differ, so that other splits put the files in another order
    for i in range(6):
        part = docs.filter(f"pmod(xxhash64(doc_id), 21) BETWEEN {i * (i + 1) // 2} AND {i * (i + 3) // 2}").coalesce(1)
        part.write.mode("append").parquet(f"{scratch}/documents.parquet")
    many, labels = spark.read.parquet(f"{scratch}/documents.parquet"), spark.read.parquet(f"{docs_dir}/labels.parquet")
    assert many.count() == docs.count()
    expected = rows_of(OPERATORS[name](many, labels))
    staging, splits = common.staging_path, cycle([1, 6, 2])

    def resplit(*args):
        spark.conf.set(SPLITS, next(splits))
        return staging(*args)

    monkeypatch.setattr(common, "staging_path", resplit)
    try:
        found = OPERATORS[name](many, labels)
        spark.conf.set(SPLITS, next(splits))
        assert rows_of(found) == expected
    finally:
        spark.conf.unset(SPLITS)


def test_op2_long_words_are_judged_whole():
    rng = np.random.default_rng(3)
    text = lambda letters, n: "".join(rng.choice(list(letters), n))
    rows = [(lang, " ".join(text(letters, 12) for _ in range(120))) for lang, letters in (("xa", "abcdef"), ("xb", "uvwxyz")) for _ in range(30)]
    model = langid.fit(["xa", "xb"], rows)
    ends_alike = "abcdef" * 5, "fedcba"
    for middle, lang in (("uvwxyz", 1), ("abcdef", 0)):
        for n in (400, 90_000):
            word = ends_alike[0] + text(middle, n) + ends_alike[1]
            assert model.posteriors([[word]])[0].argmax() == lang
            assert len(model.features(word)) >= 2 * len(word)
    short = ["abc", "uvw", "a"]
    one = np.array([model.emission[model.features(w)].sum(axis=0) for w in short])
    np.testing.assert_allclose(model.sums(model.feature_lists(short)), one, atol=1e-4)


def test_op2_learns_every_language(spark, scratch):
    # 70 languages, each with words of its own; the rarest come last in number and name
    rng = np.random.default_rng(5)
    own = {f"l{k:02}": ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(12)] for k in range(70)}
    rows = [(lang, " ".join(rng.choice(words, 40))) for k, (lang, words) in enumerate(own.items()) for _ in range(20 if k < 64 else 12)]
    data = [(i, *row) for i, row in enumerate(rows)]
    spark.createDataFrame(data, "doc_id long, lang string, text string").write.parquet(f"{scratch}/documents.parquet")
    found = queries.op2_langid(spark, scratch).collect()
    lang = {i: x for i, x, _ in data}
    for rare in (False, True):
        held = [r for r in found if r.held_out and (lang[r.doc_id] >= "l64") == rare]
        assert held and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.9 * len(held)


def test_op2_forward_backward_of_many_languages_is_exact(monkeypatch):
    rng = np.random.default_rng(0)
    lengths, w = np.array([1, 70, 33, 64, 70]), np.exp(rng.normal(size=(3, 3)))
    scores = rng.normal(size=(lengths.sum(), 3))
    blocked = langid.forward_backward(scores, lengths, w)
    monkeypatch.setattr(langid, "FULL_LANGS", 2)
    np.testing.assert_allclose(langid.forward_backward(scores, lengths, w), blocked, atol=1e-12)
    assert [langid.docs_per_lang(k) for k in (0, 1, 2, 4, 1000)] == [400, 400, 400, 200, 20]


def test_op2_copies_of_one_row_leave_room_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(langid, "DOCS_PER_LANG", 80)
    rows = [(0, "xa", "hot text")] * 3000 + [(i, "xa", f"text {i}") for i in range(1, 40)] + [(None, "xa", f"no id {i}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    used = {t for i, _, t in rows if crc32(str("" if i is None else i).encode()) % 4 != 2}
    assert "no id 3" in used and "hot text" in used
    langs, found = langid.sample(df, "doc_id", "text", "lang", 2, 4)
    assert langs == ["xa"] and sorted(t for _, t in found) == sorted(used)


def test_op4_copies_of_one_id_leave_room_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(quality, "TRAIN_ROWS", 200)
    width, got = len(quality.FEATURES), []
    monkeypatch.setattr(quality, "fit", lambda x, y: got.append((x, y)))
    rows = [(0, [0.0] * width)] * 3000 + [(i, [float(i)] * width) for i in range(1, 60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    quality.train(spark.createDataFrame(rows, "doc_id long, x array<double>"), labels)
    used = [i for i in range(60) if crc32(str(i).encode()) % 3 != 1]
    assert 0 in used and got[0][0][:, 0].tolist() == used and got[0][1].tolist() == [i % 2 for i in used]


def test_mixing_stage_leaves_no_source_out(spark, scratch):
    # source b is one long document with a target below half its size; c has one above
    rows = [(0, "w " * 5000, "b"), (1, "w " * 30, "a"), (2, "w " * 30, "c")]
    rows += [(10 + i, "w " * 50, f"d{i:02}") for i in range(90)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{scratch}/documents.parquet")
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    mix = {r.doc_id: r for r in mixing.mix(docs).collect()}
    assert 0 < mix[0].target < 0.5 * mix[0]["size"]
    copies = Counter(r.doc_id for r in mixing.mixed(docs).collect())
    assert copies[0] == 1
    for i, r in mix.items():
        assert i == 0 or copies[i] == int(r.taken / r["size"] + 0.5)
