"""Spelling variants, personal data and the manifest against brute-force versions."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from awkward import docs, docs_dir, table  # noqa: F401  (fixtures)

from tallyloom.llm import common, manifest, pii, queries, spelling

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n int, word string, pii string, rank int, place int, digest string"
EXTRA = (9, "w", "p", 8, 7, "d")


def sha(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def stored(spark, path, texts):
    """A ``documents`` table of the texts, each in four rows (one of them without an id), with clashing columns."""
    rows = [(None if k == 3 else 4 * i + k, t, None, None if i % 3 else "s", None, *EXTRA) for i, t in enumerate(texts) for k in range(4)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return [(r[0], r[1]) for r in rows]


# --- spelling ---------------------------------------------------------------


def vocabulary(rows):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += len(run) >= 5
    return {w: n for w, n in count.items() if n >= 3}


def one_apart(x, y):
    if abs(len(x) - len(y)) > 1 or x == y:
        return False
    k = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
    return x[k + (len(x) >= len(y)) :] == y[k + (len(y) >= len(x)) :]


def variants(n):
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v), default=None) for w, vs in near.items()}
    form = {w: b if b and n[b] >= 2 * n[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def found_variants(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("block, size", [(1024, 2048), (4, 8), (40, 130)])
def test_op11_every_pair_once_at_every_cut(spark, block, size):
    rng = random.Random(7)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(2, 8))): rng.randint(3, 40) for _ in range(700)}
    words |= {"x" * k: 5 for k in range(2, 40)}  # errors that fit at many places
    words |= {"q" * 3000 + c: 3 for c in ("", "a", "ab", "b")}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    found = spelling.variants(df, block=block, size=size)
    assert found.count() == len(words) and found_variants(found) == variants(words)


def test_op11_hot_prefix_is_cut_until_blocks_are_small(spark):
    rng = random.Random(8)
    words = {"internationalisation" + "".join(rng.choice("abcdefgh") for _ in range(4)): rng.randint(3, 9) for _ in range(1500)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    sizes = spelling.blocks(df, 60).groupBy("long", "a", "b", "block").count().collect()
    assert max(r["count"] for r in sizes if r.b - r.a > 1) <= 60
    assert found_variants(spelling.variants(df, block=60, size=100)) == variants(words)


def test_op11_index_tracks_both_errors():
    words = ["abcde", "abcd", "abxde", "abcdef", "zabcde", "abcdf"]
    index = spelling.Index(words, 6)
    bits = lambda q, long, a, b: [words[k] for k in np.flatnonzero(np.unpackbits(index.near(np.array([q]), long, a, b).view(np.uint8), bitorder="little"))]
    assert bits(0, 5, 0, 5) == ["abcd", "abxde", "abcdf"]
    assert bits(0, 5, 0, 3) == ["abxde"]  # only errors that begin in the interval
    assert bits(0, 6, 0, 6) == ["abcdef", "zabcde"]


def test_op11_awkward_tables(spark, docs_dir, table, scratch):
    assert found_variants(queries.op11_spelling(spark, docs_dir)) == variants(vocabulary(table))
    texts = [None, "", "12 34", "Große Größe grosse Grösse ÀÉÎ×÷õü àÉÎ×÷õü", "colour color COLOR colors colours", "aaaaaa aaaaa aaaaaaa", "w" * 5000]
    rows = stored(spark, scratch, texts)
    found = found_variants(queries.op11_spelling(spark, scratch))
    assert found == variants(vocabulary(rows)) and len(found) >= 12


def test_op11_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    count = vocabulary(rows)
    found = {r.word: r for r in queries.op11_spelling(spark, SF).collect()}
    assert {w: r.n for w, r in found.items()} == count
    parts = defaultdict(set)  # the words that each word becomes without one letter, by its place
    for w in count:
        for k in range(len(w)):
            parts[w[:k] + w[k + 1 :]].add(w)
    for w, r in found.items():
        close = {v for k in range(len(w)) for v in parts[w[:k] + w[k + 1 :]]} | parts[w] | {w[:k] + w[k + 1 :] for k in range(len(w))} & count.keys()
        assert r.n_near == sum(one_apart(w, v) for v in close)


# --- personal data ----------------------------------------------------------


def luhn(number):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(number))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def only_digits(m):
    return re.sub("[^0-9]", "", m[0])


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(only_digits(m)) <= 19 and luhn(only_digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(only_digits(m)) <= 15),
]
TEXTS = [
    None, "", " \n", "a@b.c_d@e.f x@y z@w. q@r..s 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004 1.2.3 4111 1111 1111 1111",
    "card 4111-1111-1111-1111, 4111  1111 1111 1111, 4111111111111112 and 41111111111111111111 +1 (555) 010-9999 - +1(2)3 +49 151 2345678.",
    "é日本😀 mail ñ.x@müller.de me@exa-mple.co.uk +44.20.7946.0958 10.0.0.1", "x" * 3000 + "@" + "b.c" * 2000, "7" * 4000, "9 " * 2000,
    "1.1.1." * 500, "a@b.c " * 300 + "+1 234 567 8901 " * 300, "0000000000000000 000.000.000.000 +0000000000",
]


def base_spans(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, p, ok) in enumerate(BASE) for m in re.finditer(p, text or "") if ok(m)]
    return sorted(found)


def joined(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def expected_pii(rows):
    out = Counter()
    for i, text in rows:
        spans = base_spans(text)
        out[(i, *[sum(s[1] == k for s in spans) for k in range(4)], sha(joined(spans)))] += 1
    return out


def found_pii(df):
    return Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in df.collect())


def test_op12_awkward_tables(spark, docs_dir, table, scratch):
    assert found_pii(queries.op12_pii(spark, docs_dir)) == expected_pii(table)
    rows = stored(spark, scratch, TEXTS)
    assert found_pii(queries.op12_pii(spark, scratch)) == expected_pii(rows)


def test_op12_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = expected_pii(map(tuple, rows))
    assert found_pii(queries.op12_pii(spark, SF)) == expected and sum(sum(k[1:5]) for k in expected) > 15


def test_op12_checksums_and_context(spark):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00. GB82WEST12345698765432 and GB82WEST12345698765431",
        "her SSN: 078-05-1120", "part 078-05-1120", "born 1990-02-03", "due 1990-02-03", "born 1990-13-03",
        "pay by card 4111 1111 1111 1111", "order 4111 1111 1111 1111",
    ]
    found = pii.detect(spark.createDataFrame([(t, "kept") for t in texts], "text string, pii string")).collect()
    kinds = {r.text: [(s.kind, s.score) for s in r.pii] for r in found}
    assert [kinds[t] for t in texts] == [
        kinds[texts[0]], [("national_id", 0.6)], [], [("birth_date", 0.6)], [], [], [("card", 0.9)], [("card", 0.3)],
    ]
    assert [k for k, _ in kinds[texts[0]]] == ["iban", "iban"]
    gone = [r.text for r in pii.redact(spark.createDataFrame([(texts[1],), (texts[6] + "!",), (None,)], "text string")).collect()]
    assert gone == ["her SSN: [NATIONAL_ID]", "pay by card [CARD]!", None]


def test_op12_mod_97_against_integers(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("0123456789ABCXYZ") for _ in range(rng.randint(15, 34))) for _ in range(300)] + ["GB82WEST12345698765432"]
    plain = lambda t: int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", pii.mod_97(F.col("t")).alias("ok")).collect()
    assert all(r.ok == plain(r.t) for r in got) and any(r.ok for r in got)


# --- manifest ---------------------------------------------------------------


def leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes, fan):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + fan]) for i in range(0, len(levels[-1]), fan)])
    return levels


def way(levels, k, fan):
    out = []
    for nodes in levels[:-1]:
        g = k // fan * fan
        out.append(("".join(nodes[g:k]), "".join(nodes[k + 1 : g + fan])))
        k //= fan
    return out


def expected_manifest(rows, fan=16):
    """Of ``(doc_id, source, lang, n_chars, text)``."""
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(((r[0] is not None, r[0] or 0), leaf(r), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda x: x[:2])
        trees[s] = tree([x[1] for x in by[s]], fan)
    upper, out = tree([trees[s][-1][0] for s in order], fan), Counter()
    for place, s in enumerate(order):
        for k, (_, own, r) in enumerate(by[s]):
            path = way(trees[s], k, fan) + way(upper, place, fan)
            node = own
            if r[0] is not None and crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                node = leaf((*r[:4], r[4].translate(LOWER)))
            for left, right in path:
                node = sha(left, node, right)
            out[(r[0], own, trees[s][-1][0], upper[-1][0], sha(*[x + y for x, y in path]), node, node == upper[-1][0])] += 1
    return out


def rows_of(df):
    return [tuple(r) for r in df.select(*manifest.FIELDS).collect()]


@pytest.mark.parametrize("fan", [16, 2, 3])
def test_op13_awkward_table(spark, docs, docs_dir, monkeypatch, fan):
    monkeypatch.setattr(manifest, "FAN", fan)
    found = Counter(map(tuple, queries.op13_manifest(spark, docs_dir).collect()))
    assert found == expected_manifest([(i, s, lang, n, t) for i, lang, s, n, t in docs.select("doc_id", "lang", "source", "n_chars", "text").collect()], fan)


def test_op13_sources_of_all_sizes(spark, scratch, monkeypatch):
    rng = random.Random(3)
    sizes = {"a": 1, "b": 16, "Z": 17, "é": 257, "": 2, None: 33, "hot": 700}
    rows = [(rng.randint(0, 10**6), s, rng.choice([None, "xa"]), rng.choice([None, 5]), rng.choice([None, "", "Text É", "text"])) for s, n in sizes.items() for _ in range(n)]
    rows += [(7, "hot", None, None, "Same")] * 40 + [(None, "hot", "xa", 1, "no id")] * 3
    rows += [(5, f"lone{i}", None, None, "X") for i in range(30)]
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, n int, word string, pii string, rank int, place int, digest string")
    df.repartition(4).write.parquet(f"{scratch}/documents.parquet")
    found = Counter(map(tuple, queries.op13_manifest(spark, scratch).collect()))
    assert found == expected_manifest(rows)
    assert all(r[-1] for r in found) is False and any(r[-1] for r in found)


def test_op13_one_row(spark, scratch):
    row = (3, None, None, None, None)
    spark.createDataFrame([row], "doc_id long, source string, lang string, n_chars long, text string").write.parquet(f"{scratch}/documents.parquet")
    only = queries.op13_manifest(spark, scratch).first()
    assert only.leaf == only.subroot == only.root == only.folded_root == leaf(row) and only.proof_sha256 == sha("") and only.verified


def test_op13_labels_nest(spark, docs):
    made = manifest.build(docs)
    for below, level in zip([made.leaves.withColumn("lo", F.col("rank")).withColumn("hi", F.col("rank")), *made.levels], made.levels):
        for r in level.collect():
            assert [r.lo, r.hi] == [r.kids[0].lo, r.kids[-1].hi] and r.bucket * 16 <= r.hi
            assert all(x.hi + 1 == y.lo for x, y in zip(r.kids, r.kids[1:]))
        assert sum(len(r.kids) for r in level.collect()) <= below.count()


# --- shared helpers ---------------------------------------------------------


def test_many_matches_in_one_text_take_linear_time(spark):
    import time

    text = "token=abcdefgh1 " * 100_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    from tallyloom.llm import secret_scan

    began = time.time()
    last = df.select(secret_scan.scan(F.col("text"), secret_scan.BASE).alias("s")).select(F.size("s").alias("n"), F.element_at("s", -1).alias("last")).first()
    assert (last.n, last.last.start, last.last.end) == (100_000, len(text) - 16, len(text) - 1)
    assert time.time() - began < 20


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 16_384, 16_385, 40_000])
def test_running_sums(spark, n):
    values = [(3 * k) % 7 - 2 for k in range(n)]
    got = spark.createDataFrame([(values,)], "v array<long>").select(common.running_sums(F.col("v"))).first()[0]
    assert got == np.cumsum(values, dtype=np.int64).tolist()
