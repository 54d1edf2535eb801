"""Removal of long repeated strings by common-prefix intervals over sparse suffix arrays.

Every 200-byte string holds a k-gram whose hash is least among its k-grams
(an anchor); equal strings choose equal anchors at equal places.  So two
occurrences of a repeat meet in a group of occurrences of one anchor, and what
matters of each is its context: the bytes that 200-byte strings around the
anchor can cover.  Anchors that occur once are dropped by a count.  Occurrences
with equal contexts are one *variant*.

A group's variants form a sparse suffix array (the suffixes that start at the
anchor, sorted).  A stack scan over the common-prefix lengths of neighbours
gives its interval tree; within an interval, the same scan over the common
suffixes of the left contexts tests left-extension diversity and splits it into
maximal repeats, each with all its occurrences.  Groups of more than
``GROUP_VARIANTS`` variants are compared by counting their 200-byte strings
instead (grouped by string, so a hot group is spread over all tasks); both ways
are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import RID, materialize, ship, shuffle_partitions, identified, text_or_empty

LEAST = 200
#: Bytes of an anchor; a 200-byte string has LEAST - ANCHOR + 1 of them.
ANCHOR = 32
#: Largest group that one task compares (contexts of up to 368 bytes each), and
#: the largest whose repeats are listed one by one.
GROUP_VARIANTS, SMALL_GROUP = 1 << 16, 32
#: Bytes hashed at a time; longer texts are cut with an overlap.
PIECE = 1 << 17
#: Anchors passed on at a time.
FRAME_ROWS = 100_000

_BASE = 0x9E3779B97F4A7C15 | 1
_M = np.uint64(0xBF58476D1CE4E5B9)
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        for name, b in (("up", _BASE), ("down", inverse)):
            x = np.full(n, b, np.uint64)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
    return _powers["up"][:n], _powers["down"][:n]


def kgram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A non-zero 64-bit hash of every k-gram of ``data`` (uint8)."""
    n = len(data)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = _power(n)
    c = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[data] * up, out=c[1:])
    h = (c[k:] - c[:-k]) * down[: n - k + 1]
    h = (h ^ (h >> np.uint64(31))) * _M
    return np.maximum(h ^ (h >> np.uint64(29)), np.uint64(1))


def _sliding(x: np.ndarray, w: int, op: np.ufunc, pad: int) -> np.ndarray:
    """``op`` over every ``w`` consecutive elements."""
    n = len(x)
    blocks = -(-n // w)
    padded = np.full(blocks * w, np.uint64(pad), np.uint64)
    padded[:n] = x
    rows = padded.reshape(blocks, w)
    forward = op.accumulate(rows, axis=1).ravel()
    back = op.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[: n - w + 1], forward[w - 1 : n])


def anchors(pieces: list[bytes], least: int = LEAST, k: int = ANCHOR) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and hashes of the anchors of every piece, hashed together.

    A k-gram is an anchor when it is least in any string of ``least`` bytes
    that lies within its piece; equal least k-grams all are.
    """
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    w = least - k + 1
    if len(data) < least:
        return [(np.zeros(0, np.int64), np.zeros(0, np.uint64)) for _ in pieces]
    h = kgram_hashes(data, k)
    low = _sliding(h, w, np.minimum, (1 << 64) - 1)
    start = np.arange(len(low))
    low[start + least > np.repeat(ends, sizes)[: len(low)]] = 0  # strings across pieces
    edge = np.zeros(w - 1, np.uint64)
    high = _sliding(np.concatenate([edge, low, edge]), w, np.maximum, 0)
    at = np.flatnonzero(high == h)
    cut = np.searchsorted(at, np.concatenate([[0], ends]))
    return [(at[a:b] - (e - s), h[at[a:b]]) for a, b, e, s in zip(cut[:-1], cut[1:], ends, sizes)]


def text_anchors(texts: list[bytes], least: int = LEAST, k: int = ANCHOR) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(index of the text, places, hashes)``; long texts are cut into overlapping pieces."""
    held: list[tuple[int, int, bytes]] = []
    total = 0

    def flush() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        found = anchors([p for _, _, p in held], least, k)
        parts: dict[int, list] = {}
        for (i, at, _), (places, hashes) in zip(held, found):
            parts.setdefault(i, []).append((places + at, hashes))
        for i, own in parts.items():
            places, first = np.unique(np.concatenate([p for p, _ in own]), return_index=True)
            yield i, places, np.concatenate([h for _, h in own])[first]

    for i, text in enumerate(texts):
        if len(text) < least:
            continue
        if total and total + len(text) > PIECE:
            yield from flush()
            held, total = [], 0
        if len(text) <= PIECE:
            held.append((i, 0, text))
            total += len(text)
            continue
        places, hashes = [], []
        for at in range(0, len(text), PIECE):  # each piece has the strings that start in it
            piece = text[at : at + PIECE + least - 1]
            own, h = anchors([piece], least, k)[0]
            places.append(own + at)
            hashes.append(h)
        all_, first = np.unique(np.concatenate(places), return_index=True)
        yield i, all_, np.concatenate(hashes)[first]
    if held:
        yield from flush()


def _occurrences(rows: DataFrame, least: int, k: int) -> DataFrame:
    """``(anchor, context, _rid, at, more, lo, hi)`` of stored ``(_rid, text)``: every anchor with a hash of its context ``[at - lo, at + hi)``.

    Anchors of one text with equal contexts are one row: ``at`` is the first
    place, ``more`` has the others (null if there are none).
    """
    reach = least - k

    def frame(found: list[tuple]) -> pd.DataFrame:
        rid, count, h, context, at, lo, hi, more = zip(*found)
        at = np.concatenate(at)
        return pd.DataFrame(
            {
                "anchor": np.concatenate(h).view(np.int64),
                "context": np.concatenate(context).view(np.int64),
                RID: np.repeat(np.array(rid, np.int64), count),
                "at": at.astype(np.int32),
                "more": [x for own in more for x in own],
                "lo": (at - np.concatenate(lo)).astype(np.int16),
                "hi": (np.concatenate(hi) - at).astype(np.int16),
            }
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            texts = [t.encode("utf-8") for t in batch["text"]]
            rids = batch[RID].tolist()
            found, total = [], 0
            for i, at, h in text_anchors(texts, least, k):
                text = texts[i]
                lo = np.maximum(at - reach, 0)
                hi = np.minimum(at + least, len(text))
                context = np.fromiter(
                    (digest(text[a:b], p - a) for a, b, p in zip(lo.tolist(), hi.tolist(), at.tolist())), np.uint64, len(at)
                )
                _, first, count = np.unique(context, return_index=True, return_counts=True)
                more: list = [None] * len(first)
                if len(first) < len(at):
                    places = np.split(at[np.argsort(context, kind="stable")], np.cumsum(count)[:-1])
                    more = [p[1:].astype(np.int32) if len(p) > 1 else None for p in places]
                found.append((rids[i], len(first), h[first], context[first], at[first], lo[first], hi[first], more))
                total += len(first)
                if total >= FRAME_ROWS:
                    yield frame(found)
                    found, total = [], 0
            if found:
                yield frame(found)

    return rows.select(RID, "text").mapInPandas(run, f"anchor long, context long, {RID} long, at int, more array<int>, lo short, hi short")


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """``(depth, first, last)`` of every interval of the tree over neighbours' common prefixes, deepest first on a path."""
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*lcp, 0]):
        first = i
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            yield d, first, i
        if depth and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def maximal_repeats(rights: list[bytes], lefts: list[bytes], least: int) -> Iterator[tuple[int, int, list[int]]]:
    """``(left, right, members)`` of every maximal repeat of at least ``least`` bytes around a common place.

    ``rights[i]`` is what follows the place in occurrence ``i``, ``lefts[i]``
    what precedes it, reversed.  The members of a repeat share ``right`` bytes
    after the place and ``left`` before it, and not all share more on either
    side.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    lcp = [common_prefix(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    longest = max(map(len, lefts), default=0)
    for right, first, last in intervals(lcp):
        if right + longest < least:
            continue
        own = sorted(order[first : last + 1], key=lefts.__getitem__)
        lcs = [common_prefix(lefts[a], lefts[b]) for a, b in zip(own, own[1:])]
        if right >= least and min(lcs) == 0:
            yield 0, right, own
        for left, i, j in intervals(lcs):
            if left + right >= least:
                yield left, right, own[i : j + 1]


def _reaches(rights: list[bytes], lefts: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray]:
    """How far the maximal repeats of ``maximal_repeats`` reach before and after the place, per occurrence.

    For large groups: the left contexts are sorted once, common suffixes of
    any two members are range minima over that order, and of every interval
    only the deepest repeat of each member is looked at.
    """
    n = len(rights)
    order = np.array(sorted(range(n), key=rights.__getitem__))
    lcp = [common_prefix(rights[a], rights[b]) for a, b in zip(order[:-1].tolist(), order[1:].tolist())]
    by_left = sorted(range(n), key=lefts.__getitem__)
    levels = [np.array([common_prefix(lefts[a], lefts[b]) for a, b in zip(by_left, by_left[1:])], np.int32)]
    while len(levels[-1]) > 1 << (len(levels) - 1):
        last, step = levels[-1], 1 << (len(levels) - 1)
        levels.append(np.minimum(last[:-step], last[step:]))
    table = np.zeros((len(levels), n - 1), np.int32)
    for k, level in enumerate(levels):
        table[k, : len(level)] = level
    rank = np.empty(n, np.int64)
    rank[by_left] = np.arange(n)
    member = np.array(by_left)
    ranks = rank[order]
    before, after = np.zeros(n, np.int32), np.zeros(n, np.int32)
    longest = max(map(len, lefts))
    for right, first, last in intervals(lcp):
        if right + longest < least:
            continue
        own = np.sort(ranks[first : last + 1])
        k = np.frexp((own[1:] - own[:-1]).astype(np.float64))[1] - 1  # floor of log2
        shared = np.minimum(table[k, own[:-1]], table[k, own[1:] - (1 << k)])
        deepest = np.maximum(np.append(shared, 0), np.insert(shared, 0, 0))
        good = deepest + right >= least
        m = member[own[good]]
        before[m] = np.maximum(before[m], deepest[good])
        after[m] = np.maximum(after[m], right)
    return before, after


def _covers(variants: list[tuple[int, bytes, int]], least: int) -> list[tuple[int, int, int]]:
    """``(context, before, after)``: how far repeats of at least ``least`` bytes reach around the anchor of each variant."""
    reach: dict[int, tuple[int, int]] = {}
    rights = [c[p:] for _, c, p in variants]
    lefts = [c[:p][::-1] for _, c, p in variants]
    if len(variants) > SMALL_GROUP:
        before, after = _reaches(rights, lefts, least)
        return [(variants[m][0], int(before[m]), int(after[m])) for m in np.flatnonzero(after)]
    for left, right, members in maximal_repeats(rights, lefts, least):
        for m in members:
            before, after = reach.get(m, (0, 0))
            reach[m] = max(before, left), max(after, right)
    return [(variants[m][0], before, after) for m, (before, after) in reach.items()]


def _small_groups(contexts: DataFrame, least: int) -> DataFrame:
    """Covers of the variants of groups that fit one task, found group by group in streams sorted by anchor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchor, held = None, []
        found: list[tuple[int, int, int, int]] = []
        for batch in batches:
            for a, c, data, p in zip(batch["anchor"].tolist(), batch["context"].tolist(), batch["bytes"], batch["lo"].tolist()):
                if a != anchor:
                    if len(held) > 1:
                        found += [(anchor, *x) for x in _covers(held, least)]
                    anchor, held = a, []
                held.append((c, data, p))
            if found:
                yield pd.DataFrame(found, columns=["anchor", "context", "before", "after"])
                found = []
        if len(held) > 1:
            found = [(anchor, *x) for x in _covers(held, least)]
            yield pd.DataFrame(found, columns=["anchor", "context", "before", "after"])

    parts = contexts.repartition(shuffle_partitions(contexts.sparkSession), "anchor").sortWithinPartitions("anchor")
    return parts.mapInPandas(run, "anchor long, context long, before int, after int")


def _large_groups(contexts: DataFrame, least: int) -> DataFrame:
    """Covers of the variants of larger groups: their strings, aligned to the anchor, are counted."""
    place = F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - least))
    windows = contexts.select("anchor", "context", "lo", "bytes", place.alias("i"))
    string = F.col("bytes").substr(F.col("i") + 1, F.lit(least))
    windows = windows.select(
        "anchor", "context", (F.col("lo") - F.col("i")).cast("int").alias("before"), F.xxhash64(string).alias("h1"), F.crc32(string).alias("h2")
    )
    key = ["anchor", "before", "h1", "h2"]
    twice = windows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    hit = windows.join(twice, key).groupBy("anchor", "context")
    return hit.agg(F.max("before").alias("before"), (F.lit(least) - F.min("before")).alias("after"))


def repeated_intervals(rows: DataFrame, least: int = LEAST, k: int = ANCHOR, group_variants: int = GROUP_VARIANTS) -> DataFrame:
    """``(_rid, first, last)`` of stored ``(_rid, text)``: byte ranges ``[first, last)``, together all bytes that repeated strings cover."""
    ship(rows.sparkSession)
    occurrences = _occurrences(rows, least, k)
    places = F.lit(1) + F.coalesce(F.array_size("more"), F.lit(0))
    # stored, so that both sides of the join are dealt out by it and a hot anchor's occurrences can be split
    repeated = occurrences.groupBy("anchor").agg(F.sum(places).alias("n")).filter("n > 1").select("anchor")
    repeated = materialize(repeated, "repeated-anchors")
    hits = materialize(occurrences.join(repeated, "anchor"), "anchor-hits")
    one = F.min(F.struct(RID, "at", "lo", "hi")).alias("one")
    variants = hits.groupBy("anchor", "context").agg(F.sum(places).alias("n"), one)
    groups = variants.groupBy("anchor").agg(F.count("*").alias("variants")).filter("variants > 1")
    chosen = materialize(variants.join(groups, "anchor").select("anchor", "context", "n", "variants", "one.*"), "variants")
    # the bytes of one occurrence per variant, cut out of its text in place
    wanted = chosen.groupBy(RID).agg(F.collect_list(F.struct("anchor", "context", "n", "variants", "at", "lo", "hi")).alias("w"))
    cut = rows.select(RID, F.col("text").cast("binary").alias("data")).join(wanted, RID).select(F.explode("w").alias("w"), "data")
    contexts = cut.select(
        "w.anchor", "w.context", "w.n", "w.variants", "w.lo",
        F.col("data").substr(F.col("w.at") - F.col("w.lo") + 1, F.col("w.lo") + F.col("w.hi")).alias("bytes"),
    )
    contexts = materialize(contexts, "contexts")
    small = _small_groups(contexts.filter(F.col("variants") <= group_variants), least)
    large = _large_groups(contexts.filter(F.col("variants") > group_variants), least)
    covers = small.unionByName(large).withColumnRenamed("context", "c").withColumnRenamed("anchor", "a")
    # what equal contexts share whole needs no cover
    alone = chosen.filter("n = 1").select(F.col("anchor").alias("a"), F.col("context").alias("c"))
    covers = materialize(covers.join(alone, ["a", "c"], "left_semi"), "covers")
    equal = variants.filter("n > 1").select(F.col("anchor").alias("a"), F.col("context").alias("c"))
    whole = hits.join(equal, (F.col("anchor") == F.col("a")) & (F.col("context") == F.col("c")), "left_semi")
    at = F.explode(F.concat(F.array("at"), F.coalesce("more", F.array().cast("array<int>")))).alias("at")
    whole = whole.select(RID, at, "lo", "hi")
    whole = whole.select(RID, (F.col("at") - F.col("lo")).alias("first"), (F.col("at") + F.col("hi")).alias("last"))
    parts = hits.join(covers, (F.col("anchor") == F.col("a")) & (F.col("context") == F.col("c")))
    parts = parts.select(RID, (F.col("at") - F.col("before")).alias("first"), (F.col("at") + F.col("after")).alias("last"))
    return whole.unionByName(parts)


def _merged(firsts: list[int], lasts: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(firsts, lasts)):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, k: int = ANCHOR, group_variants: int = GROUP_VARIANTS
) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``.

    Every byte covered by a ``least``-byte string that also starts elsewhere in
    the table (same text included, overlaps count) is removed; ``kept`` holds
    the other bytes, ``n_spans`` counts the maximal removed runs.  A null text
    counts as empty; rows that repeat a text of ``least`` bytes or more lose
    all of it; matches never cross rows; other columns are ignored; an empty
    table gives an empty result.
    """
    rows = identified(docs, F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    found = repeated_intervals(rows, least, k, group_variants)
    spans = found.groupBy(RID).agg(F.collect_list("first").alias("first"), F.collect_list("last").alias("last"))
    empty = F.array().cast("array<int>")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, firsts, lasts in zip(batch["text"], batch["first"], batch["last"]):
                data, runs = text.encode("utf-8"), _merged(list(firsts), list(lasts))
                edges = [0, *(x for r in runs for x in r), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
            frame = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
            frame.insert(0, "doc_id", batch["doc_id"].array)
            yield frame

    joined = rows.join(spans, RID, "left").select(
        "doc_id", "text", F.coalesce("first", empty).alias("first"), F.coalesce("last", empty).alias("last")
    )
    return joined.mapInPandas(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
