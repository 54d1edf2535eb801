"""Language of words and texts by a linear-chain conditional random field.

A word's features are its prefixes and suffixes, its character n-grams, the
word itself and the language whose training text uses it most (lexicon).
Emission weights and the transitions between languages are learned together on
code-switched sequences made of pieces of training texts, by gradient steps on
the exact likelihood.  Words are labelled by their posteriors from
forward-backward; a text's language is the one with the greatest sum of them.

Forward-backward over a text of any length runs in blocks: each block's
transfer matrix is computed for all blocks at once, messages pass between
blocks, then all blocks are filled in at once.  The result is exact.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import by_lengths, by_size, crc_mod, ship, text_or_empty

#: Bounds of the training sample: texts of each language (of more than
#: ``FULL_LANGS`` languages fewer each, but at least ``LEAST_DOCS``) and
#: characters of each (a window at a place chosen by a hash).
DOCS_PER_LANG, LEAST_DOCS, FULL_LANGS, SAMPLE_CHARS = 400, 20, 64, 1500
EPOCHS, RATE, SEQUENCE, BATCH = 2, 0.3, 48, 64
#: Hashed features; features summed at a time.
BUCKETS, SUM_FEATURES = 1 << 15, 1 << 16
#: Words remembered by a worker; characters labelled at a time; words of a block.
#: The first two hold for up to ``FULL_LANGS`` languages and shrink with more.
CACHE_WORDS, BATCH_CHARS, BLOCK = 700_000, 2 << 20, 32
LEXICON_WORDS, LEXICON_LEAST = 20_000, 3
UNKNOWN = "und"

_WORD = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def docs_per_lang(langs: int) -> int:
    """How many texts of each language train: all of them together stay bounded as languages grow."""
    return max(LEAST_DOCS, DOCS_PER_LANG * FULL_LANGS // max(FULL_LANGS, langs))


@dataclass
class Model:
    langs: list[str]
    emission: np.ndarray  # (features, languages)
    transition: np.ndarray  # (languages, languages), logarithms
    lexicon: dict[str, int]
    _seen: dict[str, int] = field(default_factory=dict, repr=False)
    _rows: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_seen": {}, "_rows": None}

    def features(self, word: str) -> list[int]:
        """All features of a word, however long: affixes and every character n-gram."""
        base = len(self.langs)
        mark = f"^{word}$"
        own = [f"w{word}"]
        own += [f"p{word[:n]}" for n in (1, 2, 3) if len(word) > n] + [f"s{word[-n:]}" for n in (1, 2, 3) if len(word) > n]
        own += [f"g{mark[i : i + n]}" for n in (3, 2) for i in range(len(mark) - n + 1)]
        out = [base + crc32(f.encode()) % BUCKETS for f in own]
        lex = self.lexicon.get(word)
        return out if lex is None else [lex, *out]

    def feature_lists(self, words: list[str]) -> list[np.ndarray]:
        return [np.array(self.features(w), np.int32) for w in words]

    def sums(self, features: list[np.ndarray]) -> np.ndarray:
        """Emission scores of words given by their features, ``SUM_FEATURES`` or one longer word at a time."""
        out = np.zeros((len(features), len(self.langs)), np.float32)
        sizes = [len(f) for f in features]
        for i, j in by_lengths(sizes, SUM_FEATURES):
            if sizes[i] > SUM_FEATURES:
                out[i] = np.bincount(features[i], minlength=len(self.emission)) @ self.emission
            else:
                starts = np.cumsum([0, *sizes[i : j - 1]])
                out[i:j] = np.add.reduceat(self.emission[np.concatenate(features[i:j])], starts, axis=0)
        return out

    def share(self, bound: int) -> int:
        """A bound that holds for up to ``FULL_LANGS`` languages, for as many as the model has."""
        return max(1, bound * FULL_LANGS // max(FULL_LANGS, len(self.langs)))

    def emissions(self, words: list[str]) -> np.ndarray:
        """Emission scores of every word; new words are added to a bounded memory."""
        seen = self._seen
        new = list({w for w in words if w not in seen})
        if self._rows is None or len(seen) + len(new) > len(self._rows):
            seen.clear()
            new = list(set(words))
            self._rows = np.zeros((max(self.share(CACHE_WORDS), len(new)), len(self.langs)), np.float32)
        at = len(seen)
        for i in range(0, len(new), 10_000):
            part = new[i : i + 10_000]
            self._rows[at + i : at + i + len(part)] = self.sums(self.feature_lists(part))
        seen.update(zip(new, range(at, at + len(new))))
        return self._rows[np.fromiter(map(seen.__getitem__, words), np.int64, len(words))]

    def posteriors(self, words: list[list[str]]) -> np.ndarray:
        """Posterior of every language for every word of several texts, the texts' words one after another."""
        return forward_backward(
            self.emissions([w for own in words for w in own]), np.array([len(w) for w in words]), np.exp(self.transition)
        )


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transition: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Word posteriors of chains laid one after another (all lengths at least 1)."""
    n, k = scores.shape
    if not n:
        return np.zeros((0, k))
    a = transition / transition.sum(axis=1, keepdims=True)
    e = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64)
    e = np.maximum(e, 1e-12)
    if k > FULL_LANGS:
        return _stepwise(e, lengths, a)
    count = -(-lengths // block)
    first = np.cumsum(count) - count
    total = int(count.sum())
    # word i of chain c stands in block first[c] + i // block at place i % block
    starts = np.cumsum(lengths) - lengths
    i = np.arange(n) - np.repeat(starts, lengths)
    row, place = np.repeat(first, lengths) + i // block, i % block
    x = np.ones((total, block, k))
    real = np.zeros((total, block, 1), bool)
    x[row, place], real[row, place] = e, True
    # transfer matrix of every block
    p = np.broadcast_to(np.eye(k), (total, k, k)).copy()
    for t in range(block):
        step = (p.reshape(-1, k) @ a).reshape(total, k, k) * x[:, t, None, :]
        p = np.where(real[:, t, :, None], step, p)
        if t % 8 == 7:
            p /= p.max(axis=(1, 2), keepdims=True)
    p /= p.max(axis=(1, 2), keepdims=True)
    # messages into and out of the blocks of every chain
    into, back = np.full((total, k), 1.0 / k), np.ones((total, k))
    order = np.argsort(-count, kind="stable")
    sorted_count, sorted_first = count[order], first[order]
    for j in range(1, int(count.max())):
        at = sorted_first[: np.searchsorted(-sorted_count, -j, side="left")] + j
        m = np.einsum("bi,bij->bj", into[at - 1], p[at - 1])
        into[at] = m / m.sum(axis=1, keepdims=True)
    for j in range(int(count.max()) - 2, -1, -1):
        at = sorted_first[: np.searchsorted(-sorted_count, -(j + 1), side="left")] + j
        m = np.einsum("bij,bj->bi", p[at + 1], back[at + 1])
        back[at] = m / m.sum(axis=1, keepdims=True)
    # within all blocks
    alpha = np.empty((total, block, k))
    v = into
    for t in range(block):
        step = (v @ a) * x[:, t]
        v = np.where(real[:, t], step / step.sum(axis=1, keepdims=True), v)
        alpha[:, t] = v
    v = back
    for t in range(block - 1, -1, -1):
        alpha[:, t] *= v
        step = (x[:, t] * v) @ a.T
        v = np.where(real[:, t], step / step.sum(axis=1, keepdims=True), v)
    out = alpha[row, place]
    return out / out.sum(axis=1, keepdims=True)


def _stepwise(e: np.ndarray, lengths: np.ndarray, a: np.ndarray) -> np.ndarray:
    """``forward_backward`` a word of every chain at a time: with many languages transfer matrices cost more than steps."""
    order = np.argsort(-lengths, kind="stable")
    sizes, starts = lengths[order], (np.cumsum(lengths) - lengths)[order]
    alpha = np.empty_like(e)
    v = np.full((len(lengths), e.shape[1]), 1.0 / e.shape[1])
    longest = int(sizes[0])
    open_ = np.searchsorted(-sizes, -np.arange(longest), side="left")
    for t in range(longest):
        at = starts[: open_[t]] + t
        step = (v[: open_[t]] @ a) * e[at]
        v = step / step.sum(axis=1, keepdims=True)
        alpha[at] = v
    v = np.ones((len(lengths), e.shape[1]))
    for t in range(longest - 1, -1, -1):
        at = starts[: open_[t]] + t
        alpha[at] *= v[: open_[t]]
        step = (e[at] * v[: open_[t]]) @ a.T
        v[: open_[t]] = step / step.sum(axis=1, keepdims=True)
    return alpha / alpha.sum(axis=1, keepdims=True)


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, fold: int, folds: int) -> tuple[list[str], list[tuple[str, str]]]:
    """The languages and the bounded training sample of ``(lang, text)``; rows of the held-out fold are never used.

    Rows are chosen by a hash of id and text, and copies of a row count once.
    """
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (crc_mod(id_col, folds) != fold))
    known = known.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    known = known.withColumn("key", F.xxhash64(F.lit("langid"), "id", "text"))
    counts = known.select("lang", "key").distinct().groupBy("lang").count().collect()
    if not counts:
        return [], []
    langs = sorted(r["lang"] for r in counts)
    bound = docs_per_lang(len(langs))
    h = F.pmod("key", F.lit(1 << 40))
    share = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, bound / r["count"])) for r in counts], "lang string, share double")
    picked = known.join(F.broadcast(share), "lang").filter(h < F.col("share") * (1 << 40))
    offset = F.pmod(F.xxhash64(F.lit("window"), "id"), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1) + 1
    window = F.substring("text", offset.cast("int"), SAMPLE_CHARS)
    once = picked.select("lang", "key", window.alias("text")).dropDuplicates(["lang", "key"])
    rows = once.orderBy("key", "lang").limit(2 * bound * len(langs)).collect()
    return langs, sorted((r["lang"], r["text"]) for r in rows)


def fit(langs: list[str], rows: list[tuple[str, str]], seed: int = 7) -> Model:
    """Learn emissions and transitions on code-switched sequences made of pieces of the sample."""
    rng = np.random.default_rng(seed)
    k = len(langs)
    index = {lang: i for i, lang in enumerate(langs)}
    use: dict[str, Counter] = defaultdict(Counter)
    pieces: list[tuple[int, list[str]]] = []
    for lang, text in rows:
        own = words_of(text)
        for w in own:
            use[w][index[lang]] += 1
        while own:
            cut = int(rng.integers(5, 26))
            pieces.append((index[lang], own[:cut]))
            own = own[cut:]
    totals = np.array([max(1, sum(c[i] for c in use.values())) for i in range(k)])
    common = sorted((w for w, c in use.items() if c.total() >= LEXICON_LEAST), key=lambda w: (-use[w].total(), w))
    lexicon = {w: int(np.argmax([use[w][i] / totals[i] for i in range(k)])) for w in common[:LEXICON_WORDS]}
    model = Model(langs, np.zeros((k + BUCKETS, k), np.float32), np.zeros((k, k)), lexicon)
    words = sorted(use)
    number = {w: i for i, w in enumerate(words)}
    features = model.feature_lists(words)
    # sequences of SEQUENCE words, cut across pieces
    rng.shuffle(pieces)
    xs = np.array([number[w] for _, p in pieces for w in p], np.int64)
    ys = np.array([lang for lang, p in pieces for _ in p], np.int64)
    n = len(xs) // SEQUENCE
    if not n or k < 2:
        return model
    xs, ys = xs[: n * SEQUENCE].reshape(n, SEQUENCE), ys[: n * SEQUENCE].reshape(n, SEQUENCE)
    square_w, square_t = np.full(model.emission.shape, 1e-6, np.float32), np.full((k, k), 1e-6)
    for _ in range(EPOCHS):
        for at in np.array_split(rng.permutation(n), -(-n // BATCH)):
            rows, grad_w, grad_t = _gradient(model, features, xs[at], ys[at])
            square_w[rows] += grad_w**2
            square_t += grad_t**2
            model.emission[rows] -= RATE * grad_w / np.sqrt(square_w[rows])
            model.transition -= RATE * grad_t / np.sqrt(square_t)
    return model


def _gradient(model: Model, features: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradient of the mean negative log-likelihood of a batch of equal-length sequences of words.

    That of the emissions is given for the features that occur, with their numbers first.
    """
    b, t = x.shape
    k = len(model.langs)
    own, word = np.unique(x.ravel(), return_inverse=True)
    lists = [features[i] for i in own]
    scores = model.sums(lists)[word].reshape(b, t, k)
    e = np.exp(scores - scores.max(axis=2, keepdims=True)).astype(np.float64)
    w = np.exp(model.transition)
    a = w / w.sum(axis=1, keepdims=True)
    alpha, beta = np.empty((t, b, k)), np.ones((t, b, k))
    v = np.full((b, k), 1.0 / k)
    for i in range(t):
        v = (v @ a) * e[:, i]
        v /= v.sum(axis=1, keepdims=True)
        alpha[i] = v
    for i in range(t - 2, -1, -1):
        v = (e[:, i + 1] * beta[i + 1]) @ a.T
        beta[i] = v / v.sum(axis=1, keepdims=True)
    post = alpha * beta
    post /= post.sum(axis=2, keepdims=True)
    # expected pairs, summed over all places, without a matrix for each place
    after = (np.swapaxes(e, 0, 1)[1:] * beta[1:]).reshape(-1, k)
    before = alpha[:-1].reshape(-1, k)
    pair = a * ((before / ((before @ a) * after).sum(axis=1, keepdims=True)).T @ after)
    want = np.zeros((k, k))
    np.add.at(want, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
    # transitions are normalised by row: the gradient of log a given expected and observed pairs
    gap = pair - want
    grad_t = gap - a * gap.sum(axis=1, keepdims=True)
    diff = np.swapaxes(post, 0, 1).copy()
    diff[np.arange(b)[:, None], np.arange(t), y] -= 1
    diff = diff.reshape(-1, k) / b
    rows, place = np.unique(np.concatenate(lists), return_inverse=True)
    sizes = [len(f) for f in lists]
    grad_w = np.empty((len(rows), k), np.float32)
    for j in range(k):
        of_word = np.bincount(word, diff[:, j], minlength=len(own))
        grad_w[:, j] = np.bincount(place, np.repeat(of_word, sizes), minlength=len(rows))
    return rows, grad_w, grad_t / b


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fold: int = 2, folds: int = 4) -> Model:
    """A model from the bounded sample of rows outside the held-out fold (crc32 of the id, modulo ``folds``)."""
    langs, rows = sample(docs, id_col, text_col, lang_col, fold, folds)
    return fit(langs, rows)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, lang_pred, score, n_words, n_switches``.

    ``score`` is the mean posterior of ``lang_pred`` over all words of the
    whole text; ``n_switches`` counts neighbouring words with different
    labels.  A text that is null or has no letter (or a model without any
    language) gives ``und``, 0.  Ties go to the first language in order.  Only
    the text is read; repeated rows are kept; an empty table gives an empty
    result.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            texts = batch["text"].tolist()
            for i, j in by_size(texts, own.share(BATCH_CHARS)):
                words = [words_of(t) for t in texts[i:j]]
                yield _summary(own, words).assign(doc_id=batch["doc_id"].iloc[i:j].array)[
                    ["doc_id", "lang_pred", "score", "n_words", "n_switches"]
                ]

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, lang_pred string, score double, n_words long, n_switches long")


def _summary(model: Model, words: list[list[str]]) -> pd.DataFrame:
    n = len(words)
    lengths = np.array([len(w) for w in words])
    out = pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0, "n_words": lengths, "n_switches": 0})
    full = np.flatnonzero(lengths) if model.langs else np.zeros(0, int)
    if len(full):
        post = model.posteriors([words[i] for i in full])
        at = np.cumsum(lengths[full]) - lengths[full]
        mean = np.add.reduceat(post, at, axis=0) / lengths[full][:, None]
        best = mean.argmax(axis=1)
        label = post.argmax(axis=1)
        change = np.zeros(len(label), np.int64)
        change[1:] = label[1:] != label[:-1]
        change[at] = 0
        pred, score, switches = out["lang_pred"].to_numpy(object, copy=True), np.zeros(n), np.zeros(n, np.int64)
        pred[full] = [model.langs[i] for i in best]
        score[full] = np.clip(mean[np.arange(len(full)), best], 0.0, 1.0)
        switches[full] = np.add.reduceat(change, at)
        out = out.assign(lang_pred=pred, score=score, n_switches=switches)
    return out


def label_words(docs: DataFrame, model: Model, text_col: str = "text", out: str = "words") -> DataFrame:
    """``docs`` with an array of ``(word, lang, p)`` in order of the text; empty without letters."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<struct<word:string,lang:string,p:double>>")
    def labels(texts: pd.Series) -> pd.Series:
        own, result = shared.value, []
        for text in texts:
            words = words_of(text) if own.langs else []
            post = own.posteriors([words]) if words else np.zeros((0, 1))
            result.append([(w, own.langs[int(p.argmax())], float(p.max())) for w, p in zip(words, post)])
        return pd.Series(result)

    return docs.withColumn(out, labels(text_or_empty(text_col)))
