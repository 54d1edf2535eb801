"""Every operator over the awkward corpus against a brute-force version, and over empty tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from awkward import docs, docs_dir, empty_dir, table  # noqa: F401  (fixtures)

from tallyloom.llm import bpe, exact_dedup, fingerprint, langid, minhash, mixing, quality, queries, repeats, secret_scan, token_output
from tallyloom.llm.bpe import Encoder, load_ranks
from tallyloom.session import staging_path

SF = "/root/testdata/sf0.001"


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def multiset(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def by_id(key):
    return (key[0] is not None, key[0] or 0, key[1] or "")


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_empty_tables(spark, empty_dir, docs_dir, name):
    empty, full = queries.queries()[name](spark, empty_dir), queries.queries()[name](spark, docs_dir)
    assert empty.dtypes == full.dtypes and empty.count() == 0


def test_op1_fingerprints(spark, docs_dir, table):
    rows = sorted(((i, t or "") for i, t in table), key=by_id)
    expected = Counter()
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 4
        expected[i, len(text), sha(text[: len(text) - cut] + after[:cut])] += 1
    got = queries.op1_fingerprints(spark, docs_dir)
    assert multiset(got, "doc_id", "n_chars", "edited_sha256") == expected
    texts = {sha(t): t for _, t in rows}
    found = got.collect()
    assert len({r.fingerprint for r in found}) == len(texts)
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_edited == 1.0) == (r.fingerprint == r.edited_fingerprint) == (r.edit_start is None)
        assert r.edit_start is None or r.edit_start <= r.n_chars - r.n_chars // 4
    assert all(r.near_edited > 0.6 for r in found if r.n_chars > 400 and r.edit_start is not None and r.doc_id != 30)


def test_op1_pieces_join_to_the_text(docs):
    from pyspark.sql import functions as F

    own = F.coalesce("text", F.lit(""))
    joined = F.array_join(F.flatten(F.flatten(fingerprint.phrases(own))), "")
    assert docs.filter(joined != own).count() == 0


def test_op2_blocked_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    lengths, w = np.array([1, 70, 33, 64, 46]), np.exp(rng.normal(size=(3, 3)))
    scores = rng.normal(size=(lengths.sum(), 3))
    got, a, at = langid.forward_backward(scores, lengths, w), w / w.sum(1, keepdims=True), 0
    for n in lengths:
        e, alpha, beta, v = np.exp(scores[at : at + n]), [], [np.ones(3)], np.full(3, 1 / 3)
        for t in range(n):
            v = (v @ a) * e[t]
            alpha.append(v := v / v.sum())
        for t in range(n - 1, 0, -1):
            beta.append((e[t] * beta[-1]) @ a.T)
            beta[-1] /= beta[-1].sum()
        p = np.array(alpha) * np.array(beta[::-1])
        np.testing.assert_allclose(got[at : at + n], p / p.sum(1, keepdims=True), atol=1e-12)
        at += n


def test_op2_held_out_accuracy_and_code_switching(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = queries.op2_langid(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in found) >= 0.97 * len(found)
    model = langid.train(docs)
    texts = {r.lang: r.text for r in docs.filter("lang in ('en', 'de') AND n_chars > 400").collect()}
    mixed = spark.createDataFrame([(texts["en"][:200] + " " + texts["de"][:200],), (None,), ("12 34",)], "text string")
    words = [r.words for r in langid.label_words(mixed, model).collect()]
    assert sum(w.lang == "en" for w in words[0][: len(words[0]) // 3]) > 0.7 * (len(words[0]) // 3)
    assert sum(w.lang == "de" for w in words[0][-len(words[0]) // 4 :]) > 0.7 * (len(words[0]) // 4)
    assert words[1] == words[2] == []


def test_op2_awkward_rows(spark, docs_dir, table):
    found = queries.op2_langid(spark, docs_dir).collect()
    assert len(found) == len(table)
    assert {r.doc_id for r in found if r.lang_pred == "und"} == {24, 25, 26}
    assert all(0 <= r.score <= 1 for r in found)
    for r in found:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2)


BASE = [
    ("assign", re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
     lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    return sorted((m.start(), k, kind, m.end()) for k, (kind, p, ok) in enumerate(BASE) for m in p.finditer(text) if ok(m))


@pytest.mark.parametrize("where", ["awkward", SF])
def test_op3_base_spans(spark, docs_dir, where):
    where = docs_dir if where == "awkward" else where
    expected = Counter()
    for r in spark.read.parquet(f"{where}/documents.parquet").select("doc_id", "text").collect():
        s = base_spans(r.text or "")
        n = Counter(kind for _, _, kind, _ in s)
        expected[r.doc_id, n["assign"], n["access"], n["hex"], sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in s))] += 1
    got = queries.op3_secret_scan(spark, where)
    assert multiset(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == expected


def test_op3_many_matches_and_hard_cases(spark, scratch):
    texts = ["token=abcdef1 " * 700, "token: secret: abcdefgh", "password==abcdef token=ab token=abcdefg", "AKIA" + "A" * 16,
             "\U0001f600" * 3 + "API_KEY='abcdef'", "0" * 23 + "g" + "0" * 24]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{scratch}/documents.parquet")
    got = {r.doc_id: r for r in queries.op3_secret_scan(spark, scratch).collect()}
    for i, text in enumerate(texts):
        assert got[i].spans == ",".join(f"{k}:{a}:{b}" for a, _, k, b in base_spans(text)), text[:60]


def test_op3_ledger_scans_only_unseen_pairs(spark, scratch):
    old = spark.createDataFrame([(1, "token=abcdefg"), (2, "plain")], "doc_id long, text string")
    new = spark.createDataFrame([(1, "token=abcdefg"), (3, "ghp_" + "Z" * 36)], "doc_id long, text string")
    path, base, added = f"{scratch}/ledger", secret_scan.BASE, secret_scan.ADDED
    assert secret_scan.update_ledger(spark, path, old, [base], new=True).count() == 2
    assert secret_scan.scan_new(old, spark.read.parquet(path), [base]).count() == 0
    again = secret_scan.scan_new(new, spark.read.parquet(path), [base, added])
    assert sorted((r.version, len(r.spans)) for r in again.collect()) == [("added-1", 0), ("added-1", 1), ("base-1", 0)]
    ledger = secret_scan.update_ledger(spark, path, new, [base, added])
    found = secret_scan.findings(new, ledger, [base, added]).collect()
    assert {r.doc_id: (len(r["base-1"]), len(r["added-1"])) for r in found} == {1: (1, 0), 3: (0, 1)}


def test_op4_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = queries.op4_quality(spark, SF).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in found) >= 0.9 * len(found)


def test_op4_tables_add_up_and_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 7] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean() > 0.9 and (2, 7) in model.pairs
    none = quality.fit(np.zeros((0, len(quality.FEATURES))), np.zeros(0))
    assert none.score(x[:2]).tolist() == [0.5, 0.5]


def test_op4_awkward_rows(spark, docs_dir, table):
    found = queries.op4_quality(spark, docs_dir).collect()
    assert len(found) == len(table) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)


@pytest.mark.parametrize("bits", [64, 5])
def test_op5_exact_dedup(docs, table, bits):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in table:
        groups[norm(t)].append(i)
    first = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    found = exact_dedup.exact_dedup(docs, bits=bits)
    assert multiset(found, "doc_id", "keep_id", "group_size", "text_sha256") == Counter(
        (i, first[norm(t)], len(groups[norm(t)]), sha(norm(t))) for i, t in table
    )
    kept = found.filter("kept").collect()
    assert sorted(r.text_sha256 for r in kept) == sorted(map(sha, groups)) and all(r.doc_id == r.keep_id for r in kept)


def water_fill(sizes: dict) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, rest = {}, set(names), sum(sizes.values())
    while True:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
        free -= over
        if not free:
            return target


def test_op6_mixing(spark, docs, docs_dir):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    sizes = Counter()
    for r in docs.select("source", "text").collect():
        sizes[r.source] += count(r.text)
    target = water_fill(dict(sizes))
    found, taken = queries.op6_mixing(spark, docs_dir).collect(), Counter()
    assert Counter((r.doc_id, r["size"]) for r in found) == Counter((r.doc_id, count(r.text)) for r in docs.collect())
    for r in found:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(1, 0.02 * target[s]), (s, taken[s], target[s])
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, queries.op6_mixing(spark, docs_dir).collect()), key=str)


def test_op6_caps_are_reshared(spark, scratch):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(5000, "a"), (100, "b"), (100, "c"), (3000, None)])]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{scratch}/documents.parquet")
    got = {r.doc_id: r for r in queries.op6_mixing(spark, scratch).collect()}
    target = water_fill({"a": 5000, "b": 100, "c": 100, None: 3000})
    assert target["b"] == target["c"] == 300
    for i, s in enumerate(["a", "b", "c", None]):
        assert abs(got[i].target - target[s]) < 1e-6 and abs(got[i].taken - target[s]) <= 0.01 * target[s] + 1
    copies = Counter(r.doc_id for r in mixing.mixed(spark.read.parquet(f"{scratch}/documents.parquet")).collect())
    assert copies[1] == copies[2] == 3


RANKS = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference_encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_op7_bpe(spark, docs_dir, table, reference_encoding):
    expected = Counter()
    for i, t in table:
        ids = np.array(reference_encoding.encode_ordinary(t or ""), "<u4")
        expected[i, len(ids), sha(ids.tobytes()), sha(t or "")] += 1
    assert multiset(queries.op7_bpe(spark, docs_dir), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected


def test_op7_long_pre_tokens(reference_encoding):
    encoder = Encoder(RANKS, public_tokenizers.PATTERN)
    for text in ("a" * 5000, "ab" * 4000, "é" * 700, "xyz" * 999 + "\n" * 300, "=" * 1234):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == reference_encoding.encode_ordinary(text)


def test_op7_random_texts_and_forgetting(reference_encoding, monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(bpe, "CACHE_TOKENS", 20)
    monkeypatch.setattr(bpe, "_LONG_TEXT", 150)
    monkeypatch.setattr(bpe, "_PIECES", 7)
    encoder = Encoder(RANKS, public_tokenizers.PATTERN)
    parts = ["a", "ab", "the", " ", "\n", "é", "日本", "!", "\x1c", "\x85", "\u2028", "\xa0", "12", "²", "'s", "\U0001f600", "aaaa", "<|endoftext|>"]
    for _ in range(200):
        text = "".join(rng.choice(parts, int(rng.integers(0, 120))))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == reference_encoding.encode_ordinary(text)
    assert len(encoder) <= 20


def test_op8_token_output(spark, docs_dir, table):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, expected = 0, Counter()
    for i, t in sorted(((i, t or "") for i, t in table), key=by_id):
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4")
        expected[i, start, len(ids), zlib.crc32(ids.tobytes())] += 1
        start += len(ids)
    got = queries.op8_token_output(spark, docs_dir)
    assert multiset(got, "doc_id", "start", "n_tokens", "ids_crc32") == expected


def test_op8_many_shards(spark, docs_dir, monkeypatch):
    whole = multiset(queries.op8_token_output(spark, docs_dir), "doc_id", "start", "n_tokens", "ids_crc32")
    monkeypatch.setattr(token_output, "shuffle_partitions", lambda spark: 1)
    monkeypatch.setattr(token_output, "SHARD_IDS", 500)
    path = staging_path(spark, "one-part")
    token_output.write_tokens(spark.read.parquet(f"{docs_dir}/documents.parquet"), path, public_tokenizers.path("word_bpe_49k.json"))
    got = token_output.read_tokens(spark, path).collect()
    assert Counter((r.doc_id, r.start, len(r.ids) // 4, zlib.crc32(r.ids)) for r in got) == whole
    assert spark.read.parquet(path).count() > 5


def test_op8_words_by_piece():
    path = public_tokenizers.path("word_bpe_49k.json")
    words, tokenizer = token_output._Words(path), Tokenizer.from_file(path)
    assert words.by_piece and words.mark is not None
    rng = np.random.default_rng(9)
    parts = ["a", "Don't", "'S", "'", "!", "12", "x_y", "<|endoftext|>", "<", "é", "Σ", "\t", "\x1c", "日本", "--", "'ll", "e\u0301", "\u0130", " ", "\n"]
    texts = ["".join(rng.choice(parts, int(rng.integers(0, 30)))) for _ in range(400)]
    assert [np.frombuffer(x, "<u4").tolist() for x in words.encode(texts)] == [
        e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)
    ]
    words.by_piece, words.mark = False, None
    words.clear()
    words[""] = b""
    assert len(words.encode(texts[:5])) == 5


def test_op8_blocks_round_trip():
    rng = np.random.default_rng(5)
    for n in (0, 1, 255, 256, 257, 5000):
        for high in (1, 2, 300, 1 << 16, 1 << 32):
            ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
            if n > 300:
                ids[::97] = 0xFFFFFFFF
            index, data = token_output.pack(ids)
            assert (token_output.unpack(index, data, n) == ids).all()


def components(sets: dict[int, frozenset]) -> dict[int, list[int]]:
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    groups = defaultdict(list)
    for a in sets:
        groups[find(a)].append(a)
    return {a: g for g in groups.values() for a in g}


def shingle_sets(texts: list[str], width: int) -> dict[int, frozenset]:
    out = {}
    for k, t in enumerate(texts):
        w = t.encode().lower().split()
        n = min(width, len(w))
        out[k] = frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()
    return out


@pytest.mark.parametrize("width", [4, 5])
def test_op9_minhash(docs, table, width):
    sets = shingle_sets([t or "" for _, t in table], width)
    member, expected = components(sets), Counter()
    for k, (i, _) in enumerate(table):
        ids = [table[m][0] for m in member[k] if table[m][0] is not None]
        expected[i, len(sets[k]), min(ids, default=None)] += 1
    found = minhash.near_dedup(docs, width=width)
    assert multiset(found, "doc_id", "n_shingles", "component_id") == expected
    assert found.filter("kept").count() == len({tuple(g) for g in member.values()})


def test_op9_links_between_non_leaders(spark, scratch):
    # chains: each text is near the next, but far from the first of its chain
    rows, at = [], 0
    for chain in range(6):
        words = [f"w{chain}x{i}" for i in range(200)]
        for step in range(8):
            rows.append((at, " ".join(words)))
            at += 1
            words = [f"c{chain}s{step}e{i}" if i // 10 == step * 2 else w for i, w in enumerate(words)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{scratch}/documents.parquet")
    member = components(shingle_sets([t for _, t in rows], 4))
    got = {r.doc_id: r.component_id for r in queries.op9_minhash(spark, scratch).collect()}
    assert got == {k: min(g) for k, g in member.items()}


def test_op9_sketches_estimate_similarity():
    rng = np.random.default_rng(2)
    both, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (600, 100, 100))
    x, y = np.unique(np.r_[both, a]), np.unique(np.r_[both, b])
    s = minhash.sketch([x, y, x[:1]], 2048)
    assert abs((s[0] == s[1]).mean() - 0.75) < 0.05 and (s != minhash._EMPTY).all()


def brute_repeats(texts: list[bytes], least: int) -> list[tuple[int, int, int, str]]:
    count = Counter(t[k : k + least] for t in texts for k in range(len(t) - least + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - least + 1):
            if count[t[k : k + least]] > 1:
                gone[k : k + least] = b"\x01" * least
        runs = sum(1 for k in range(len(t)) if gone[k] and not (k and gone[k - 1]))
        out.append((len(t), sum(gone), runs, sha(bytes(c for c, g in zip(t, gone) if not g))))
    return out


@pytest.mark.parametrize("group,small", [(4096, 32), (4096, 1), (1, 32)])
def test_op10_repeats(docs, table, group, small, monkeypatch):
    monkeypatch.setattr(repeats, "SMALL_GROUP", small)
    expected = Counter((i, *x) for (i, _), x in zip(table, brute_repeats([(t or "").encode() for _, t in table], 200)))
    found = repeats.remove_repeats(docs, group_variants=group)
    assert multiset(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected


def test_op10_small_alphabet(spark):
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("ab"), 400)) for _ in range(25)]
    texts += [texts[0][37:150] + texts[1][5:90], "ab" * 150, "a" * 90, "a" * 30, texts[2][:60] * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3, "doc_id")
    path = staging_path(spark, "small-alphabet")
    df.write.parquet(path)
    for group in (4096, 2):
        found = repeats.remove_repeats(spark.read.parquet(path), least=16, k=6, group_variants=group).collect()
        expected = brute_repeats([t.encode() for t in texts], 16)
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == dict(enumerate(expected))


def test_op10_long_texts_are_cut_without_loss(docs, table, monkeypatch):
    texts = [(t or "").encode() for _, t in table]
    whole = {i: (p.tolist(), h.tolist()) for i, p, h in repeats.text_anchors(texts)}
    monkeypatch.setattr(repeats, "PIECE", 1000)
    assert {i: (p.tolist(), h.tolist()) for i, p, h in repeats.text_anchors(texts)} == whole


def test_op10_large_groups_reach_as_far_as_the_listed_repeats(monkeypatch):
    rng = np.random.default_rng(6)
    for n in (2, 3, 40, 300):
        variants = []
        for i in range(n):
            left, right = (bytes(rng.choice([97, 98], int(rng.integers(0, 12)))) for _ in range(2))
            variants.append((i, left + b"##" + right, len(left)))
        monkeypatch.setattr(repeats, "SMALL_GROUP", n)
        listed = sorted(repeats._covers(variants, 8))
        monkeypatch.setattr(repeats, "SMALL_GROUP", 1)
        assert sorted(repeats._covers(variants, 8)) == listed and (n < 40 or listed)


def test_op10_maximal_repeats_with_all_occurrences():
    text = [b"xxabcabcdzz", b"yyabcabcdww", b"qqabcabq", b"ppabcabq"]
    rights, lefts = [t[2:] for t in text], [t[:2][::-1] for t in text]
    groups = {(left, right, tuple(sorted(m))) for left, right, m in repeats.maximal_repeats(rights, lefts, 3)}
    assert groups == {(0, 7, (0, 1)), (0, 6, (2, 3)), (0, 5, (0, 1, 2, 3))}
    assert list(repeats.intervals([3, 1, 2])) == [(3, 0, 1), (2, 2, 3), (1, 0, 3)]
