"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The pre-tokens of a batch that are not remembered merge together: each is a
linked list of byte positions.  Every adjacent pair that is a vocabulary entry
waits in the bucket of its rank; a hierarchy of two bitmap levels says which
buckets hold anything, so the lowest rank is found by find-first-set on one
word per level.  The positions of that bucket merge next, the leftmost first,
until it is empty or a lower rank waits; entries whose pair has changed
meanwhile are stale and skipped.  No pair reaches over the end of a pre-token,
so pre-tokens do not change each other's merges, and one lookup in the queue
serves all of them.  Every step costs two words and a small heap operation, at
any length of a pre-token.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator
from heapq import heappop, heappush
from itertools import filterfalse, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tallyloom.llm.common import arrow_slices, by_size, ship, text_or_empty

#: Pre-tokens of a generation remembered by a task (it keeps two), and the longest remembered one.
CACHE_TOKENS, CACHE_LENGTH = 200_000, 32
#: Rows turned at a time are those of about this many characters or ids.
BATCH_CHARS = 1 << 20
#: Texts encoded together are those of about this many characters, and pre-tokens that
#: merge together of so many bytes: what is at work then fits a core's cache.
TOGETHER_CHARS, MERGE_BYTES = 1 << 16, 1 << 13
#: Longer texts are split into pre-tokens piecemeal.
_LONG_TEXT, _PIECES = 1 << 20, 100_000


class Encoder(dict):
    """Ids of pre-tokens as little-endian unsigned 32-bit integers; a bounded memory of those seen.

    The rank queue is two bitmap levels of about sqrt(ranks) bits a word and a
    heap of positions per rank that holds any.  It is empty between calls.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=1)
        self.shift = (max(ranks.values(), default=0).bit_length() + 1) // 2
        self.pattern = regex.compile(pattern)
        self.older: dict[str, bytes] = {}
        self.single, self.double = np.full(1 << 8, -1, np.int64), np.full(1 << 16, -1, np.int64)
        for token, rank in ranks.items():
            if len(token) == 1:
                self.single[token[0]] = rank
            elif len(token) == 2:
                self.double[token[0] << 8 | token[1]] = rank

    def learn(self, tokens: list[str]) -> None:
        """Every one of ``tokens`` gets its ids, known from the older generation or merged now."""
        unseen, raws = [], []
        for token in tokens:
            ids = self.older.get(token)
            if ids is None:
                raw = token.encode("utf-8")
                whole = self.ranks.get(raw)
                if whole is None:
                    unseen.append(token)
                    raws.append(raw)
                    continue
                ids = whole.to_bytes(4, "little")
            self[token] = ids
        for i, j in by_size(raws, MERGE_BYTES):
            self.update(zip(unseen[i:j], self.merge(raws[i:j])))

    def forget(self, tokens: list[str]) -> None:
        """Keeps the last two generations, without those of ``tokens`` that are long."""
        for token in tokens:
            if len(token) > CACHE_LENGTH:
                del self[token]
        if len(self) > CACHE_TOKENS:
            self.older = dict(self)
            self.clear()

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of non-empty pieces, each merged for itself."""
        get, longest, shift = self.ranks.get, self.longest, self.shift
        mask = (1 << shift) - 1
        data = b"".join(pieces)
        n = len(data)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        raw = np.frombuffer(data, np.uint8)
        first = np.zeros(n + 1, np.uint8)  # is it the start of a piece?
        first[0] = 1
        first[ends] = 1
        first = first.tobytes()
        two = np.append(self.double[raw[:-1].astype(np.int64) << 8 | raw[1:]], -1)
        two[ends - 1] = -1
        own = self.single[raw].tolist()  # rank of the part that starts here; -2: none does
        pair = two.tolist()  # rank of a part joined with the next one
        after = list(range(1, n + 1))  # the start of the next part
        before = list(range(-1, n))
        buckets: dict[int, list[int]] = {}  # by rank: positions, some of them stale
        leaves: dict[int, int] = {}  # by high bits of a rank: which low bits have a bucket
        top = 0  # which high bits have a leaf
        fresh: list[tuple[int, int]] = []  # pairs whose rank has no bucket
        filled = np.flatnonzero(two >= 0)
        filled = filled[np.argsort(two[filled], kind="stable")]
        cuts = np.flatnonzero(np.diff(two[filled], prepend=-1))
        positions, bounds = filled.tolist(), [*cuts.tolist(), len(filled)]
        for r, i, j in zip(two[filled[cuts]].tolist(), bounds, bounds[1:]):
            buckets[r] = positions[i:j]  # ascending, so a heap
            high = r >> shift
            leaves[high] = leaves.get(high, 0) | 1 << (r & mask)
            top |= 1 << high
        while top:
            high = (top & -top).bit_length() - 1
            leaf = leaves[high]
            rank = high << shift | (leaf & -leaf).bit_length() - 1
            bucket, lower = buckets[rank], False
            while bucket and not lower:
                i = heappop(bucket)
                if pair[i] != rank:
                    continue  # stale
                j = after[i]
                k = after[j]
                after[i] = k
                before[k] = i
                pair[j] = -1
                own[j] = -2
                own[i] = rank
                # the merged part with the next one, and the one before with the merged part
                if first[k]:
                    pair[i] = -1
                else:
                    to = after[k]
                    r = pair[i] = get(data[i:to], -1) if to - i <= longest else -1
                    if r in buckets:
                        heappush(buckets[r], i)
                    elif r >= 0:
                        fresh.append((r, i))
                    lower |= 0 <= r < rank
                if not first[i]:
                    at = before[i]
                    r = pair[at] = get(data[at:k], -1) if k - at <= longest else -1
                    if r in buckets:
                        heappush(buckets[r], at)
                    elif r >= 0:
                        fresh.append((r, at))
                    lower |= 0 <= r < rank
                while fresh:
                    r, at = fresh.pop()
                    if r in buckets:
                        heappush(buckets[r], at)
                        continue
                    buckets[r] = [at]
                    over = r >> shift
                    leaves[over] = leaves.get(over, 0) | 1 << (r & mask)
                    top |= 1 << over
            if not bucket:
                del buckets[rank]
                leaf = leaves[high] ^ 1 << (rank & mask)
                if leaf:
                    leaves[high] = leaf
                else:
                    del leaves[high]
                    top ^= 1 << high
        own = np.array(own, np.int64)
        parts = own != -2
        ids = own[parts]
        if (ids < 0).any():
            raise KeyError(bytes([raw[np.flatnonzero(parts)[np.argmin(ids)]]]))
        blob = ids.astype("<u4").tobytes()
        bounds = [0, *(np.cumsum(parts)[ends - 1] * 4).tolist()]
        return [blob[i:j] for i, j in zip(bounds, bounds[1:])]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of every text."""
        out = []
        for i, j in by_size(texts, TOGETHER_CHARS):
            group = texts[i:j]
            if max(map(len, group)) < _LONG_TEXT:
                out += self._ids([self.pattern.findall(text) for text in group])
            else:
                out += map(self._long, group)
        return out

    def _ids(self, found: list[list[str]]) -> list[bytes]:
        new = list(filterfalse(self.__contains__, set().union(*found)))
        self.learn(new)
        out = [b"".join(map(self.__getitem__, own)) for own in found]
        self.forget(new)
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def _long(self, text: str) -> bytes:
        found = (m.group() for m in self.pattern.finditer(text))
        parts = []
        while part := list(islice(found, _PIECES)):
            parts += self._ids([part])
        return b"".join(parts)


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f) if token}


def _vocabulary(path: str) -> list[bytes]:
    ranks = load_ranks(path)
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def _turned(docs: DataFrame, column: str, out: str, turn: Callable[[], Callable[[list], list[bytes]]]) -> DataFrame:
    """``docs`` with the binary column ``out``: ``turn()`` applied to the values of ``column``, a bounded batch at a time."""
    schema = StructType([f for f in docs.schema if f.name != out] + [StructField(out, BinaryType())])
    names = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = turn()  # what it remembers goes with the task
        for part in arrow_slices(batches, column, BATCH_CHARS):
            made = pa.array(each(part.column(column).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), made], [*names, out])

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the binary column ``out``: the text's ids, little-endian unsigned 32-bit.

    A null text counts as empty (and is null no more) and gives no ids;
    repeated rows are encoded each; an older column ``out`` is replaced, other
    columns pass through untouched.  Special tokens in a text are ordinary
    text.
    """
    ship(docs.sparkSession)
    known = docs.withColumn(text_col, text_or_empty(text_col))
    return _turned(known, text_col, out, lambda: Encoder(load_ranks(ranks_path), pattern).encode_all)


def decode(docs: DataFrame, ranks_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the binary column ``out``: the bytes that the ids stand for (null ids: none)."""
    ship(docs.sparkSession)

    def turn() -> Callable[[list[bytes]], list[bytes]]:
        tokens = pa.array(_vocabulary(ranks_path), pa.large_binary())

        def each(column: list[bytes]) -> list[bytes]:
            taken = tokens.take(pa.array(np.frombuffer(b"".join(column), "<u4").astype(np.uint32)))
            _, places, data = taken.buffers()
            ends = np.cumsum([0, *(len(ids) // 4 for ids in column)])
            bounds = np.frombuffer(places, np.int64, len(taken) + 1)[ends].tolist()
            whole = data.to_pybytes() if data else b""
            return [whole[i:j] for i, j in zip(bounds, bounds[1:])]

        return each

    known = docs.withColumn(ids_col, F.coalesce(F.col(ids_col), F.lit(b"")))
    return _turned(known, ids_col, out, turn)


def count_ids(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
