"""Toxicity by a classifier chain.

Linear models predict the categories one after another. Each sees which words a
text has and the probabilities of all earlier categories; those are out-of-fold
predictions in training, so later models learn how far they can be trusted. The
chain is fitted on a bounded sample of labelled documents and then scores every
document in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.llm.text import LETTERS_DIGITS, Words, range_hashes, split_words, text_chunks

FEATURE_BITS = 22
PREFIX_BYTES = (4, 5, 6, 7)  # beginnings of longer words count as words too: stems with other endings


@dataclass(frozen=True)
class ChainParams:
    """`sample` bounds the labelled documents that are fitted on, copies counted once."""

    categories: tuple[str, ...] = ("quality", "toxic")
    sample: int = 5_000
    folds: int = 5
    least_documents: int = 5  # a word has to occur in so many of the sample
    least_z: float = 4.0  # and tell classes apart by so many standard errors
    penalty: float = 1.0
    steps: int = 200


@dataclass
class Chain:
    """Fitted weights per category: words, then bias and earlier probabilities; thresholds."""

    categories: tuple[str, ...]
    words: np.ndarray  # sorted feature numbers
    weights: list[np.ndarray] = field(default_factory=list)
    earlier: list[np.ndarray] = field(default_factory=list)  # bias, then one per earlier category
    thresholds: list[float] = field(default_factory=list)

    def probabilities(self, doc: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
        """(n, categories) from distinct pairs of text and position in `words`."""
        out = np.zeros((n, len(self.categories)))
        for c, (weights, earlier) in enumerate(zip(self.weights, self.earlier, strict=True)):
            logit = np.bincount(doc, weights[word], n) + earlier[0] + out[:, :c] @ earlier[1:]
            out[:, c] = _sigmoid(logit)
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def text_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, hashed word) pairs, sorted."""
    words = split_words(texts, LETTERS_DIGITS)
    doc, feature = _word_features(words)
    pair = np.unique(doc * (1 << FEATURE_BITS) + feature)
    return pair >> FEATURE_BITS, pair & ((1 << FEATURE_BITS) - 1)


def _word_features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and beginnings of words, with the text of each."""
    docs, hashes = [words.doc], [words.hash]
    for length in PREFIX_BYTES:
        longer = words.end - words.start > length
        start = words.start[longer]
        docs.append(words.doc[longer])
        hashes.append(range_hashes(words.data, start, start + length) + np.uint64(length << 50))
    shift = np.uint64(64 - FEATURE_BITS)
    return np.concatenate(docs), (np.concatenate(hashes) >> shift).astype(np.int64)


def fit_chain(docs: DataFrame, labels: DataFrame, params: ChainParams = ChainParams()) -> Chain:
    """Fit on at most `params.sample` labelled documents, chosen by a hash of the id.

    Labels that are null in any category are left out, as are labels without a
    document; of several labels or texts of one id any one counts. With no labels,
    or only one kind, a category gets a constant probability (no labels: 0).
    """
    known = labels.select("doc_id", *[F.col(c).cast("double") for c in params.categories]).dropna()
    known = known.join(docs.select(F.col("doc_id").alias("doc_id")), "doc_id", "left_semi")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", *params.categories).limit(params.sample)
    body = F.col("text").cast("string")
    text = docs.select("doc_id", body.alias("text"), F.xxhash64(body).alias("copy"))
    # At most `sample` rows with few columns: small enough to send everywhere.
    joined = text.join(F.broadcast(chosen.dropDuplicates(["doc_id"])), "doc_id").dropDuplicates(["copy"])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            doc, word = text_features(texts)
            parts = np.split(word.astype(np.int32), np.searchsorted(doc, np.arange(1, len(texts))))
            blobs = pa.array([p.tobytes() for p in parts], pa.binary())
            columns = [batch.column("copy"), blobs, *(batch.column(c) for c in params.categories)]
            yield pa.RecordBatch.from_arrays(columns, ["copy", "words", *params.categories])

    kinds = ", ".join(f"`{c}` double" for c in params.categories)
    rows = joined.mapInArrow(features, f"copy long, words binary, {kinds}").collect()
    rows.sort(key=lambda r: r.copy)
    words = [np.frombuffer(r.words, np.int32) for r in rows]
    target = np.asarray([[float(r[c] > 0) for c in params.categories] for r in rows])
    return _fitted(words, target.reshape(len(rows), len(params.categories)), params)


def _fitted(words: list[np.ndarray], target: np.ndarray, params: ChainParams) -> Chain:
    n = len(words)
    if not n:
        none = Chain(params.categories, np.zeros(0, np.int64))
        for c in range(len(params.categories)):
            none.weights.append(np.zeros(0))
            none.earlier.append(np.concatenate([[-40.0], np.zeros(c)]))
            none.thresholds.append(0.5)
        return none
    doc = np.repeat(np.arange(n, dtype=np.int32), [len(w) for w in words])
    word = np.concatenate(words)
    kept = _telling_words(doc, word, target, params)
    place = np.searchsorted(kept, word)
    inside = place < len(kept)
    inside[inside] = kept[place[inside]] == word[inside]
    doc, place = doc[inside], place[inside]
    fold = np.arange(n) % params.folds
    chain = Chain(params.categories, kept)
    earlier = np.zeros((n, 0))
    for c in range(len(params.categories)):
        y = target[:, c]
        held_out = np.zeros(n)
        for f in range(min(params.folds, n)):
            train = fold != f
            w, b = _logistic(doc, place, len(kept), earlier, y, train if train.any() else ~train, params)
            logit = np.bincount(doc, w[place], n) + b[0] + earlier @ b[1:]
            held_out[~train] = _sigmoid(logit)[~train]
        w, b = _logistic(doc, place, len(kept), earlier, y, np.ones(n, bool), params)
        chain.weights.append(w)
        chain.earlier.append(b)
        chain.thresholds.append(_best_threshold(held_out, y))
        earlier = np.column_stack([earlier, held_out])
    return chain


def _telling_words(doc, word, target, params: ChainParams) -> np.ndarray:
    """Words that are frequent enough and whose share differs between the classes of some category.

    The root of the likelihood-ratio statistic stands for the deviate: it stays
    right where one class never has the word.
    """
    size = 1 << FEATURE_BITS
    total = np.bincount(word, minlength=size)
    kept = np.flatnonzero(total >= params.least_documents)
    total, n = total[kept], len(target)
    best = np.zeros(len(kept))
    for c in range(target.shape[1]):
        positives = target[:, c].sum()
        with_word = np.bincount(word, target[doc, c], size)[kept]
        g = np.zeros(len(kept))
        for seen, expected in (
            (with_word, total * positives / n),
            (total - with_word, total * (n - positives) / n),
            (positives - with_word, (n - total) * positives / n),
            (n - positives - total + with_word, (n - total) * (n - positives) / n),
        ):
            there = (seen > 0) & (expected > 0)
            g[there] += 2 * seen[there] * np.log(seen[there] / expected[there])
        best = np.maximum(best, g)
    return kept[np.sqrt(np.maximum(0, best)) >= params.least_z]


def _logistic(doc, place, n_words, earlier, y, train, params: ChainParams) -> tuple[np.ndarray, np.ndarray]:
    """Penalised logistic regression by gradient steps with adaptive rates (Adam)."""
    n = len(y)
    used = train[doc]
    doc, place = doc[used], place[used]
    extra = np.column_stack([np.ones(n), earlier])
    w = np.zeros(n_words + extra.shape[1])
    if len(np.unique(y[train])) < 2:
        w[n_words] = 40.0 if y[train].all() else -40.0
        return w[:n_words], w[n_words:]
    m, v = np.zeros_like(w), np.zeros_like(w)
    count = train.sum()
    for t in range(1, params.steps + 1):
        logit = np.bincount(doc, w[place], n) + extra @ w[n_words:]
        error = np.where(train, _sigmoid(logit) - y, 0.0) / count
        grad = np.concatenate([np.bincount(place, error[doc], n_words), extra.T @ error])
        grad[:n_words] += params.penalty * w[:n_words] / count
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w[:n_words], w[n_words:]


def _best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Half way between the held-out probabilities where F1 is best; 0.5 if one class is missing."""
    if len(np.unique(y)) < 2:
        return 0.5
    order = np.argsort(-p)
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][p[order][:-1] == p[order][1:]] = -1  # no cut between equals
    best = int(np.argmax(f1))
    low = p[order][best + 1] if best + 1 < len(y) else 0.0
    return float((p[order][best] + low) / 2)


def score_chain(docs: DataFrame, chain: Chain, prefix: str = "p_", verdict: str = "rejected") -> DataFrame:
    """All columns of `docs`, a probability per category, and whether the last one reaches its threshold.

    A null or empty text has no words and is never rejected. Rows stay as they are,
    repeated ones too; an empty table gives no rows.
    """
    names = [f"{prefix}{c}" for c in chain.categories]
    if clash := {c.lower() for c in docs.columns} & {n.lower() for n in [*names, verdict]}:
        raise ValueError(f"choose another prefix or verdict: {sorted(clash)} are taken")
    fields = [T.StructField(n, T.DoubleType()) for n in names] + [T.StructField(verdict, T.BooleanType())]
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # at most 2^22 words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        position = np.full(1 << FEATURE_BITS, -1, np.int32)
        position[chain.words] = np.arange(len(chain.words))
        for batch, texts in text_chunks(batches):
            words = split_words(texts, LETTERS_DIGITS)
            doc, feature = _word_features(words)
            at = position[feature]
            pair = np.unique(doc[at >= 0] * (1 << FEATURE_BITS) + at[at >= 0])
            doc, word = pair >> FEATURE_BITS, pair & ((1 << FEATURE_BITS) - 1)
            p = chain.probabilities(doc, word, len(texts))
            rejected = (p[:, -1] > chain.thresholds[-1]) & (words.count() > 0)
            arrays = [*(pa.array(p[:, c]) for c in range(len(names))), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *names, verdict])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


