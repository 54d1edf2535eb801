"""Quality scores by a generalised additive model with pairwise interactions.

A text's features are counted in one pass.  Each feature is cut into bins at
quantiles of the training rows, and shallow trees boosted in turns, a feature
at a time at a low rate, add up to one lookup table per feature; then the pairs
of features whose joint bins explain most of what is left get tables of their
own in the same way.  A score is the logistic of the sum of looked-up values.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import RID, by_size, crc_mod, number_rows, ship, text_or_empty, whole_row

#: Bound of the training sample, in labelled rows chosen by a hash of their id.
TRAIN_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 64, 16, 6
ROUNDS, PAIR_ROUNDS, RATE, RIDGE = 120, 60, 0.15, 1.0
#: Characters of texts whose features are counted at a time.
BATCH_CHARS = 4 << 20

FEATURES = (
    "chars", "words", "word_length", "longest_word", "letters", "upper", "digits", "clause_marks", "symbols", "spaces",
    "lines", "other_bytes", "distinct_words", "top_word", "upper_words", "repeated_lines", "marked_words", "same_neighbours",
    "sentence_words", "short_words",
)

_CLASSES = [
    range(65, 91), range(97, 123), range(48, 58), b".,;:!?", b"#$%&*@^~|<>{}[]/\\=+_`", b" \t\r\v\f", b"\n", range(128, 256), b".!?",
]
_CLASS_OF = np.zeros((256, len(_CLASSES)))
for _i, _c in enumerate(_CLASSES):
    _CLASS_OF[list(_c), _i] = 1


def features(texts: list[str]) -> np.ndarray:
    """One row of ``FEATURES`` per text; all 0 for the empty text."""
    n = len(texts)
    counts = np.zeros((n, 256))
    words_of = np.zeros((n, 10))
    for i, text in enumerate(texts):
        data = text.encode("utf-8")
        counts[i] = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        words = text.split()
        if not words:
            continue
        lines = [x for x in text.split("\n") if x]
        seen = Counter(words)
        marked = sum(not w[-1].isalnum() and w[-1] not in ".,;:!?" or len(w) > 1 and not w[-2].isalnum() for w in seen)
        words_of[i] = (
            len(text), len(words), max(map(len, seen)), len(seen), max(seen.values()),
            sum(c for w, c in seen.items() if w.isupper()), 1 - len(set(lines)) / max(1, len(lines)),
            marked / len(seen), sum(map(str.__eq__, words, words[1:])), sum(c for w, c in seen.items() if len(w) < 4),
        )
    upper, lower, digits, clause, symbols, spaces, breaks, other, ends = (counts @ _CLASS_OF).T
    chars, words, longest, distinct, top, caps, lines, marked, same, short = words_of.T
    size, w = np.maximum(counts.sum(axis=1), 1), np.maximum(words, 1)
    return np.column_stack(
        [
            np.log1p(chars), np.log1p(words), chars / w, np.log1p(longest), (upper + lower + other) / size,
            upper / np.maximum(upper + lower, 1), digits / size, clause / size, symbols / size, spaces / size,
            breaks / size, other / size, distinct / w, top / w, caps / w, lines, marked, same / w, words / (ends + 1), short / w,
        ]
    )


@dataclass
class Model:
    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: a sum of looked-up bins."""
        s = np.full(len(x), self.intercept)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            s += table[np.searchsorted(cuts, x[:, j], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            s += table[
                np.searchsorted(self.coarse[a], x[:, a], side="right"), np.searchsorted(self.coarse[b], x[:, b], side="right")
            ]
        return 1 / (1 + np.exp(-s))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)


def _best(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of ordered bins with gradient and weight sums."""
    if len(g) < 2:
        return 0.0, 0
    cg, ch = np.cumsum(g), np.cumsum(h)
    left = cg[:-1] ** 2 / (ch[:-1] + RIDGE)
    right = (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + RIDGE)
    gain = left + right - cg[-1] ** 2 / (ch[-1] + RIDGE)
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def _step(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values of a tree of at most ``depth`` cuts on a path, per bin."""
    gain, at = _best(g, h) if depth else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + RIDGE))
    return np.concatenate([_step(g[:at], h[:at], depth - 1), _step(g[at:], h[at:], depth - 1)])


def _pair_step(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best tree over two features: one cut of the first, then one of the second on each side."""
    cg, ch = np.cumsum(g, axis=0), np.cumsum(h, axis=0)
    best, out = -1.0, np.zeros_like(g)
    for at in range(1, g.shape[0]):
        gain, cuts = 0.0, []
        for own_g, own_h in ((cg[at - 1], ch[at - 1]), (cg[-1] - cg[at - 1], ch[-1] - ch[at - 1])):
            own, cut = _best(own_g, own_h)
            gain += own + own_g.sum() ** 2 / (own_h.sum() + RIDGE)
            cuts.append((own_g, own_h, cut))
        if gain > best:
            best = gain
            rows = [_step_at(*c) for c in cuts]
            out = np.vstack([np.tile(rows[0], (at, 1)), np.tile(rows[1], (g.shape[0] - at, 1))])
    return best, out


def _step_at(g: np.ndarray, h: np.ndarray, cut: int) -> np.ndarray:
    parts = [(g[:cut], h[:cut]), (g[cut:], h[cut:])]
    return np.concatenate([np.full(len(a), a.sum() / (b.sum() + RIDGE)) for a, b in parts if len(a)])


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost lookup tables for every feature in turns, then for the pairs that explain most of the rest."""
    n, width = len(x), len(FEATURES)
    rate = (y.sum() + 1) / (n + 2)
    cuts = [_cuts(x[:, j], BINS) for j in range(width)]
    coarse = [_cuts(x[:, j], PAIR_BINS) for j in range(width)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    model = Model(float(np.log(rate / (1 - rate))), cuts, tables, coarse, [], [])
    if not n or y.min() == y.max():
        return model
    bins = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)]
    s = np.full(n, model.intercept)
    for _ in range(ROUNDS):
        for j in range(width):
            p = 1 / (1 + np.exp(-s))
            size = len(tables[j])
            step = RATE * _step(np.bincount(bins[j], y - p, size), np.bincount(bins[j], p * (1 - p), size))
            tables[j] += step
            s += step[bins[j]]
    low = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(coarse)]

    def sums(a: int, b: int, own: np.ndarray) -> np.ndarray:
        shape = len(coarse[a]) + 1, len(coarse[b]) + 1
        return np.bincount(low[a] * shape[1] + low[b], own, shape[0] * shape[1]).reshape(shape)

    p = 1 / (1 + np.exp(-s))
    gains = sorted(
        ((-_pair_step(sums(a, b, y - p), sums(a, b, p * (1 - p)))[0], a, b) for a in range(width) for b in range(a + 1, width))
    )
    model.pairs = [(a, b) for _, a, b in gains[:PAIRS]]
    model.pair_tables = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            p = 1 / (1 + np.exp(-s))
            step = RATE * _pair_step(sums(a, b, y - p), sums(a, b, p * (1 - p)))[1]
            table += step
            s += step[low[a], low[b]]
    return model


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """``(_rid, doc_id, x)``: the features of every whole text; ``more`` columns are taken along."""
    ship(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def features_of(texts: pd.Series) -> pd.Series:
        # a slice at a time: what is built from the texts is several times their size
        all_texts = texts.tolist()
        return pd.Series([row for i, j in by_size(all_texts, BATCH_CHARS) for row in features(all_texts[i:j])], dtype=object)

    return number_rows(docs, F.col(id_col).alias("doc_id"), features_of(text_or_empty(text_col)).alias("x"), *more)


def _picked(labels: DataFrame, label_col: str, fold: int, folds: int) -> DataFrame:
    """``(doc_id, y)`` of the training sample, about ``TRAIN_ROWS`` rows."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & (crc_mod("doc_id", folds) != fold))
    known = known.groupBy("doc_id").agg(F.max(label_col).cast("double").alias("y"))
    size = max(1, known.count())
    h = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1_000_000))
    return known.filter(h < 1_000_000 * min(1.0, TRAIN_ROWS / size))


def _trained(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str = "quality", fold: int = 1, folds: int = 3) -> Model:
    """``train`` on the rows of ``docs`` that the sample names: only their features are counted for it."""
    order = [F.xxhash64(F.lit("quality"), "doc_id"), "doc_id"]
    ids = _picked(labels, label_col, fold, folds).select("doc_id").orderBy(*order).limit(TRAIN_ROWS + TRAIN_ROWS // 10)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sample = rows.join(F.broadcast(ids), "doc_id", "left_semi")  # at most that many ids
    return train(feature_table(sample, "doc_id", "text"), labels, label_col, fold, folds)


def train(table: DataFrame, labels: DataFrame, label_col: str = "quality", fold: int = 1, folds: int = 3) -> Model:
    """A model from at most ``TRAIN_ROWS`` labelled rows outside the held-out fold (crc32 of the id, modulo ``folds``).

    A label is the greatest of a document's labels; null labels are not used.
    Rows that repeat an id train once, by the least of their features.
    """
    picked = _picked(labels, label_col, fold, folds).join(table.select("doc_id", "x"), "doc_id")
    once = picked.groupBy("doc_id", "y").agg(F.min("x").alias("x")).orderBy(F.xxhash64(F.lit("quality"), "doc_id"), "doc_id")
    rows = once.limit(TRAIN_ROWS + TRAIN_ROWS // 10).toPandas().sort_values("doc_id")
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    return fit(x, (rows["y"].to_numpy() > 0).astype(float))


def scored(table: DataFrame, model: Model) -> DataFrame:
    """A feature table with ``score``."""
    shared = table.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for x in batches:
            yield pd.Series(own.score(np.array(x.tolist(), float).reshape(len(x), len(FEATURES))))

    return table.withColumn("score", score_of("x"))


def predict(table: DataFrame, model: Model, fold: int = 1, folds: int = 3) -> DataFrame:
    """``(_rid, doc_id, held_out, score, predicted)`` of a feature table."""
    return scored(table, model).select(
        RID, "doc_id", (crc_mod("doc_id", folds) == fold).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``_rid, doc_id, held_out, score, predicted``.

    Only the text is scored: null and empty texts have all features 0 and are
    scored like any other; repeated rows are scored each (and, if labelled,
    train once).  Without labelled rows, or with one label only, the score is
    the smoothed share of label 1.  An empty table gives an empty result.
    """
    return predict(feature_table(docs, id_col, text_col), _trained(docs, labels, id_col, text_col))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows predicted to be of low quality; columns unchanged."""
    model = _trained(docs, labels, id_col, text_col)
    return scored(feature_table(docs, id_col, text_col, whole_row(docs)), model).filter("score >= 0.5").select("row.*")
