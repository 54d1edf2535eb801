"""Pre-tokens merged together get the ids that each gets alone, whatever the order of the ranks."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest

from tallyloom.llm import bpe
from tallyloom.llm.bpe import Encoder


def naive(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        at = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if at is None:
            return [ranks[p] for p in parts]
        i = at[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def vocabulary(rng):
    """Random tokens under random ranks: a merge may open pairs of lower ranks than its own."""
    tokens = {bytes([c]) for c in b"abc"} | {bytes(rng.choices(b"abc", k=rng.randint(2, 6))) for _ in range(60)}
    order = list(range(0, 900, 7))
    rng.shuffle(order)
    return dict(zip(sorted(tokens), order))


@pytest.mark.parametrize("seed", range(20))
def test_pieces_merge_together(seed):
    rng = random.Random(seed)
    ranks = vocabulary(rng)
    pieces = [bytes(rng.choices(b"abc", k=rng.randint(1, 40))) for _ in range(50)] + [b"a" * 300, b"ab" * 90]
    got = Encoder(ranks, r"\S+").merge(pieces)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == [naive(p, ranks) for p in pieces]


def test_texts_of_all_lengths(monkeypatch):
    monkeypatch.setattr(bpe, "TOGETHER_CHARS", 40)
    monkeypatch.setattr(bpe, "MERGE_BYTES", 25)
    monkeypatch.setattr(bpe, "_LONG_TEXT", 30)
    monkeypatch.setattr(bpe, "_PIECES", 2)
    monkeypatch.setattr(bpe, "CACHE_TOKENS", 10)
    rng = random.Random(5)
    ranks = vocabulary(rng)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 45))) for _ in range(60)]
    texts = ["", *(" ".join(rng.choices(words, k=rng.randint(0, 5))) for _ in range(100)), "", "a" * 30, ""]
    encoder = Encoder(ranks, r"\S+")
    got = encoder.encode_all(texts)
    expected = [[x for w in t.split() for x in naive(w.encode() if w.encode() not in ranks else b"", ranks) or [ranks[w.encode()]]] for t in texts]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == expected
    assert len(encoder) <= 10


def test_a_byte_without_a_rank_is_an_error():
    with pytest.raises(KeyError):
        Encoder({b"a": 0, b"b": 1, b"ab": 2}, r"\S+").encode("abxab")


def test_decode_of_nothing_and_of_all_ids(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokens = bpe._vocabulary(path)
    every = np.arange(len(tokens), dtype="<u4").tobytes()
    for rows in ([(1, b""), (2, None)], [(1, every), (2, b""), (3, every[:40]), (4, None)]):
        got = bpe.decode(spark.createDataFrame(rows, "doc_id long, ids binary"), path).select("doc_id", "decoded").collect()
        assert {r.doc_id: bytes(r.decoded) for r in got} == {i: b"".join(tokens[x] for x in np.frombuffer(ids or b"", "<u4")) for i, ids in rows}
