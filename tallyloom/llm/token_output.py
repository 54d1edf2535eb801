"""Token ids as files of patched frame-of-reference blocks.

Documents are put in ascending id order over range partitions; every partition
is a sequence of shards, each a self-contained byte image kept as one row of a
Parquet table (so that any store Spark can reach will do)::

    magic "TLPF", block size u16, documents u32, ids u64, blocks u32
    document ids i64 each, a validity byte each, id counts u32 each
    block index: start of every block, u32 each
    blocks: minimum u32, width u8, exceptions u16,
            exception positions u16 each, exception values u32 each,
            ids less the minimum, packed at ``width`` bits

A block's width is the smallest that holds ``PERCENTILE`` percent of its
values; the rest are exceptions.  All integers are little-endian.
"""

from __future__ import annotations

import json
import os
import struct
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import arrow_slices, ship, shuffle_partitions, text_or_empty

BLOCK, PERCENTILE = 256, 95
#: A shard is closed after the document that brings it to this many ids.
SHARD_IDS = 1 << 18
#: Words, and pieces of words, remembered by a worker; texts encoded at a time, in bytes.
CACHE, BATCH_BYTES = 300_000, 8 << 20
#: New words encoded together.
TOGETHER = 1000
# The normaliser and the pre-tokenizers of a word tokenizer that
# encodes the pieces of a word one by one.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": _PIECES}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: Anything but letters and signs that need no composition and have a lower case each of its own, and ASCII white space.
_NOT_PLAIN = r"[^\t\n\r !-;=-~\x{a1}-\x{ff}]"
END_ID = 1
#: A shard row: its partition and number, the ids of the partition's earlier shards, its ids, its image.
SHARDS = "part int, shard int, before long, n_ids long, image binary"

_HEAD = struct.Struct("<4sHIQI")
_MAGIC = b"TLPF"


def pack(ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> tuple[np.ndarray, bytes]:
    """Start of every block, and the blocks."""
    n = len(ids)
    blocks = -(-n // block)
    if not blocks:
        return np.zeros(0, "<u4"), b""
    v = np.empty(blocks * block, np.uint32)
    v[:n] = ids
    v[n:] = ids[-1]  # fills the last block; not counted when read
    v = v.reshape(blocks, block)
    low = v.min(axis=1)
    v = v - low[:, None]
    bits = np.frexp(v.astype(np.float64))[1]
    at = min(block - 1, -(-block * percentile // 100) - 1)
    width = np.partition(bits, at, axis=1)[:, at]
    over = bits > width[:, None]
    count = over.sum(axis=1)
    packed: list[bytes] = [b""] * blocks
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        size = -(-block * int(w) // 8)
        for r, b in zip(rows, _squeeze(v[rows], int(w)).view(np.uint8)):
            packed[r] = b[:size].tobytes()
    out = []
    for r in range(blocks):
        where = np.flatnonzero(over[r]) if count[r] else np.zeros(0, int)
        out.append(
            struct.pack("<IBH", int(low[r]), int(width[r]), len(where))
            + where.astype("<u2").tobytes()
            + v[r][where].astype("<u4").tobytes()
            + packed[r]
        )
    size = np.array([len(x) for x in out])
    return (np.cumsum(size) - size).astype("<u4"), b"".join(out)


def _squeeze(v: np.ndarray, w: int) -> np.ndarray:
    """The low ``w`` bits of every value of a row, one after another from the lowest bit of the first 64-bit word."""
    n = v.shape[1]
    out = np.zeros((len(v), -(-n * w // 64)), "<u8")
    if w:
        columns = np.ascontiguousarray(v.T).astype(np.uint64) & np.uint64((1 << w) - 1)
        for j in range(n):
            at, shift = divmod(j * w, 64)
            out[:, at] |= columns[j] << np.uint64(shift)
            if shift + w > 64:
                out[:, at + 1] |= columns[j] >> np.uint64(64 - shift)
    return out


def _spread(words: np.ndarray, w: int, n: int) -> np.ndarray:
    """The ``n`` values of every row of ``_squeeze``."""
    columns, mask = np.ascontiguousarray(words.T), np.uint64((1 << w) - 1)
    out = np.empty((n, len(words)), np.uint32)
    for j in range(n):
        at, shift = divmod(j * w, 64)
        value = columns[at] >> np.uint64(shift)
        if shift + w > 64:
            value = value | columns[at + 1] << np.uint64(64 - shift)
        out[j] = value & mask
    return out.T


def unpack(index: np.ndarray, data: bytes, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` ids of ``pack``'s blocks."""
    raw = np.frombuffer(data, np.uint8)
    heads = [struct.unpack_from("<IBH", data, int(i)) for i in index]
    v = np.zeros((len(index), block), np.uint32)
    width = np.array([h[1] for h in heads], int)
    body = np.array([int(i) + 7 + 6 * h[2] for i, h in zip(index, heads)], np.int64)
    for w in np.unique(width):
        if not w:
            continue
        rows = np.flatnonzero(width == w)
        length = -(-block * int(w) // 8)
        whole = np.zeros((len(rows), -(-length // 8) * 8), np.uint8)
        whole[:, :length] = raw[body[rows][:, None] + np.arange(length)]
        v[rows] = _spread(whole.view("<u8"), int(w), block)
    for r, (i, h) in enumerate(zip(index, heads)):
        if h[2]:
            at = int(i) + 7
            where = np.frombuffer(data, "<u2", h[2], at)
            v[r, where] = np.frombuffer(data, "<u4", h[2], at + 2 * h[2])
    v += np.array([h[0] for h in heads], np.uint32)[:, None]
    return v.reshape(-1)[:n]


def write_shard(keys: np.ndarray, valid: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One shard image: document ids and whether they are not null, how many ids each has, and all ids."""
    index, blocks = pack(ids)
    head = _HEAD.pack(_MAGIC, BLOCK, len(keys), len(ids), len(index))
    return b"".join([head, keys.astype("<i8").tobytes(), valid.astype(np.uint8).tobytes(), counts.astype("<u4").tobytes(), index.tobytes(), blocks])


def read_shard(image: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, their id counts, and all ids of a shard image."""
    magic, block, docs, n, blocks = _HEAD.unpack_from(image)
    if magic != _MAGIC:
        raise ValueError("not a token shard")
    at = _HEAD.size
    keys = np.frombuffer(image, "<i8", docs, at)
    valid = np.frombuffer(image, np.uint8, docs, at + 8 * docs)
    counts = np.frombuffer(image, "<u4", docs, at + 9 * docs)
    index = np.frombuffer(image, "<u4", blocks, at + 13 * docs)
    ids = unpack(index, image[at + 13 * docs + 4 * blocks :], n, block)
    return [int(k) if v else None for k, v in zip(keys, valid)], counts, ids


class _Words(dict):
    """Ids of words as bytes; words are encoded by the tokenizer in batches."""

    def __init__(self, path: str):
        super().__init__()
        self.pieces: dict[str, bytes] = {}
        self.tokenizer, self.mark, self.mark_text, self.bytes_as = _tokenizer(path)
        self.by_piece = self.bytes_as is not None

    def learn(self, words: list[str]) -> None:
        """Ids of new words."""
        self._encode(words, self)

    def learn_pieces(self, pieces: list[str]) -> None:
        """Ids of new pieces of plain texts, which need neither normaliser nor pre-tokenizer."""
        one, as_text = self.tokenizer.model.tokenize, self.bytes_as
        for piece in pieces:
            text = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(as_text)
            self.pieces[piece] = array("I", [t.id for t in one(text)]).tobytes()

    def _encode(self, words: list[str], into: dict[str, bytes]) -> None:
        """Encode words, many at a time where a mark can part them."""
        if self.mark is None:
            rest = words
        else:
            rest = [w for w in words if self.mark_text[0] in w]  # might hold the mark, or a part of it
            words = [w for w in words if self.mark_text[0] not in w]
            for i in range(0, len(words), TOGETHER):
                part = words[i : i + TOGETHER]
                ids = np.array(self.tokenizer.encode(self.mark_text.join(part), add_special_tokens=False).ids, "<u4")
                raw, at = ids.tobytes(), 0
                for w, end in zip(part, [*np.flatnonzero(ids == self.mark).tolist(), len(ids)], strict=True):
                    into[w] = raw[4 * at : 4 * end]
                    at = end + 1
        for w, e in zip(rest, self.tokenizer.encode_batch(rest, add_special_tokens=False)):
            into[w] = np.array(e.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as bytes."""
        ids, counts = self.encode_all(pa.array(texts, pa.string()))
        raw, ends = ids.tobytes(), np.cumsum(counts)
        return [raw[4 * (e - c) : 4 * (e - 1)] for e, c in zip(ends.tolist(), counts.tolist())]

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, ``END_ID`` after each text, and how many each text has.

        The tokenizer drops white space and never looks across it, so a text's
        ids are its words' ids joined.  It encodes the pieces of a word one by
        one, and Arrow parts plain texts into pieces.
        """
        plain = np.zeros(len(texts), bool)
        if self.by_piece:
            plain = ~pc.match_substring_regex(texts, _NOT_PLAIN).to_numpy(zero_copy_only=False)
        parts = []
        if plain.any():
            spaced = pc.replace_substring_regex(pc.utf8_lower(texts.filter(pa.array(plain))), _PIECES, r"\0 ")
            parts.append(self._joined(pc.ascii_split_whitespace(spaced), self.pieces, self.learn_pieces))
        if not plain.all():
            words = pc.replace_substring(texts.filter(pa.array(~plain)), "\n", " ")
            parts.append(self._joined(pc.split_pattern(words, " "), self, self.learn))
        if len(parts) == 1:
            return parts[0]
        ids, counts = map(np.concatenate, zip(*parts))
        back = np.argsort(np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)]))
        return ids[_ranges((np.cumsum(counts) - counts)[back], counts[back])], counts[back]

    def _joined(self, split: pa.Array, known: dict[str, bytes], learn: Callable[[list[str]], None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lists of units: units are numbered by Arrow, each different one is looked up once, ids are gathered by offsets."""
        offsets = split.offsets.to_numpy()
        numbered = split.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        own = numbered.dictionary.to_pylist()
        if len(known) > CACHE:
            known.clear()
        learn([u for u in own if u and u not in known])
        end = np.array([END_ID], "<u4").tobytes()
        found = [known[u] if u else b"" for u in own]
        size = np.array([*map(len, found), 4], np.int64) // 4
        flat = np.frombuffer(b"".join([*found, end]), "<u4")
        ends = offsets[1:].astype(np.int64) - offsets[0]
        # the end id stands after the last unit of a text
        units = np.insert(numbered.indices.to_numpy(), ends, len(own))
        ids = flat[_ranges((np.cumsum(size) - size)[units], size[units])]
        total = np.cumsum(size[units])[ends + np.arange(len(ends))]
        return ids, np.diff(total, prepend=0)


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[0], first[0] + 1, ...`` (``size[0]`` of them), then the same for the others."""
    after = np.cumsum(size)
    return np.repeat(first - (after - size), size) + np.arange(after[-1] if len(after) else 0)


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> tuple:
    """The tokenizer; an added token whose text always stands alone (id, text), to tell words apart that are encoded
    together; and how it writes bytes as letters, if it encodes the pieces of a word one by one by known rules."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    alone = [(i, t) for i, t in tokenizer.get_added_tokens_decoder().items() if not (t.normalized or t.lstrip or t.rstrip or t.single_word)]
    mark, mark_text = (alone[0][0], alone[0][1].content) if alone else (None, None)
    parts = json.loads(tokenizer.to_str())
    known = parts["normalizer"] == _NORMALIZER and (parts["pre_tokenizer"] or {}).get("pretokenizers") == _PRE_TOKENIZERS
    if not known or any(t.content < "<" or t.content[0] != "<" for t in tokenizer.get_added_tokens_decoder().values()):
        return tokenizer, mark, mark_text, None
    as_text = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    # the letters of the two bytes of every letter from 0x80 to 0xFF
    as_letters = {}
    for code in range(0x80, 0x100):
        letters = as_text(chr(code))[0][0]
        as_letters |= dict(zip(chr(code).encode("utf-8"), letters))
    return tokenizer, mark, mark_text, as_letters


@lru_cache(maxsize=1)
def _words(path: str) -> _Words:
    """The one bounded memory of a worker."""
    return _Words(path)


class _Shards:
    """Documents and their ids on the way into the shards of one partition."""

    def __init__(self, part: int, size: int):
        self.part, self.number, self.before, self.size = part, 0, 0, size
        self.held: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def add(self, keys: np.ndarray, valid: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The shards that are full now: each is closed after the document that brings it to ``size`` ids."""
        ends = np.cumsum(counts)
        done = at = 0
        while done < len(counts):
            last = int(np.searchsorted(ends, at + self.size - self.n))
            upto = min(last + 1, len(counts))
            self.held.append((keys[done:upto], valid[done:upto], counts[done:upto], ids[at : ends[upto - 1]]))
            self.n += int(ends[upto - 1]) - at
            done, at = upto, int(ends[upto - 1])
            if self.n >= self.size:
                yield self.row()

    def row(self) -> pa.RecordBatch:
        image = write_shard(*map(np.concatenate, zip(*self.held)))
        values = {"part": [self.part], "shard": [self.number], "before": [self.before], "n_ids": [self.n], "image": [image]}
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        out = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values.values(), types)], list(values))
        self.number, self.before, self.held, self.n = self.number + 1, self.before + self.n, [], 0
        return out


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``END_ID``, and write shards in ascending id order (null ids first).

    Null and empty texts are the end id alone; rows that repeat an id follow
    one another in text order; an empty table writes no shard.
    """
    spark = docs.sparkSession
    ship(spark)
    size = SHARD_IDS

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out = _words(tokenizer_path), _Shards(TaskContext.get().partitionId(), size)
        for part in arrow_slices(batches, "text", BATCH_BYTES):
            ids, counts = encoder.encode_all(part.column("text"))
            yield from out.add(part.column("key").to_numpy(), part.column("known").to_numpy(zero_copy_only=False), counts, ids)
        if out.held:
            yield out.row()

    key = F.col(id_col).cast("long")
    rows = docs.select(key.alias("key"), text_or_empty(text_col).alias("text"))
    ordered = rows.repartitionByRange(shuffle_partitions(spark), "key").sortWithinPartitions("key", "text")
    ready = ordered.select(F.coalesce("key", F.lit(0)).alias("key"), F.col("key").isNotNull().alias("known"), "text")
    ready.mapInArrow(shards, SHARDS).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, ids)`` from the files: ids as little-endian bytes, ``start`` counts all ids before.

    A start is the ids of earlier partitions (a sum over one row per
    partition, which is broadcast), of earlier shards of the partition (kept
    with the shard), and of earlier documents of the shard.
    """
    ship(spark)
    table = spark.read.schema(SHARDS).parquet(path)
    total = table.groupBy("part").agg(F.sum("n_ids").alias("n"))
    base = total.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in arrow_slices(batches, "image", 1):
            part, before, image = (shard.column(c)[0].as_py() for c in ("part", "before", "image"))
            keys, counts, ids = read_shard(image)
            ends = np.cumsum(counts, dtype=np.int64)
            raw = pa.py_buffer(ids.astype("<u4"))
            offsets = pa.py_buffer(np.concatenate([[0], 4 * ends]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(keys), part, np.int32)),
                    pa.array(keys, pa.int64()),
                    pa.array(before + ends - counts),
                    pa.Array.from_buffers(pa.binary(), len(keys), [None, offsets, raw]),
                ],
                ["part", "doc_id", "local", "ids"],
            )

    read = table.select("part", "before", "image").mapInArrow(documents, "part int, doc_id long, local long, ids binary")
    return read.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("local")).alias("start"), "ids")
