"""Quality classifier: supervised subword embeddings.

Every word and character n-gram has a learned vector by hash bucket. A word is the
average of its vectors, a document that of its words, and a softmax over the two
labels follows. Trained by numpy stochastic gradient descent on a bounded sample of
labelled rows (``train_rows``). A word that equals the word before it also counts as
the token ``<again>``, so that an average can tell mere repetition.

Only the text enters a score. Defined cases: null and empty texts get the score of
an average of nothing, by the learned offset; without labels of both kinds the score
is the share of label 1 (0.5 without any); repeated rows are scored one by one; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from imagelake.llm.word_models import BUCKETS, Examples, many_ngrams, sample, with_word_scores

SIZES = (3, 4)
DIM = 8
TRAIN_ROWS = 3000
EPOCHS = 5
BATCH = 32
RATE = 0.3
AGAIN = b"\x01again"  # no text word holds U+0001 by itself


def tokens(text: bytes) -> list[bytes]:
    words = text.split()
    again = sum(map(bytes.__eq__, words, words[1:]))
    return words + [AGAIN] * again


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def fit(examples: Examples, y: np.ndarray, seed: int = 11) -> tuple[np.ndarray, float]:
    """Weight per feature bucket (its vector's share in the difference of the two
    logits) and offset."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    out, bias = rng.uniform(-1 / DIM, 1 / DIM, (DIM, 2)), np.zeros(2)
    seen_v, seen_o, seen_b = np.full(BUCKETS, 1e-6), 1e-6, 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for lo in range(0, len(order), BATCH):
            rows = order[lo:lo + BATCH]
            doc, feature, value = examples.batch(rows)
            x = np.stack([np.bincount(doc, vectors[feature, k] * value, len(rows)) for k in range(DIM)], 1)
            logits = x @ out + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            d_x = p @ out.T / len(rows)
            touched, place = np.unique(feature, return_inverse=True)
            g = np.stack([np.bincount(place, d_x[doc, k] * value, len(touched)) for k in range(DIM)], 1)
            seen_v[touched] += (g * g).mean(1)
            vectors[touched] -= RATE * g / np.sqrt(seen_v[touched])[:, None]
            g_o, g_b = x.T @ p / len(rows), p.mean(0)
            seen_o, seen_b = seen_o + (g_o * g_o).mean(), seen_b + (g_b * g_b).mean()
            out -= 0.1 * g_o / math.sqrt(seen_o)
            bias -= 0.1 * g_b / math.sqrt(seen_b)
    return vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0])


def weigh(weights: np.ndarray, words: list[bytes]) -> list[float]:
    """Average of the weights of each word's features."""
    features, sizes = many_ngrams(words, SIZES)
    starts = np.cumsum(sizes) - sizes
    means = np.empty(len(words))
    order = np.argsort(sizes, kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):  # words of as many features
        means[same] = weights[features[starts[same][:, None] + np.arange(sizes[same[0]])]].mean(1)
    return means.tolist()


def quality_scores(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score (chance of quality 1) per row of ``docs``."""
    got = sample(docs, labels, "quality", train_rows, fold(F.col("doc_id")) != 0)
    y = np.array([label for _, label in got], int)
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    if len(set(y.tolist())) < 2:
        return docs.select("doc_id", held_out, F.lit(float(y.mean()) if len(y) else 0.5).alias("score"))
    weights, bias = fit(Examples((tokens(text) for text, _ in got), SIZES), y)
    scored = with_word_scores(docs.select("doc_id", "text"), weights.astype(np.float32), weigh, tokens, "_word")
    mean = F.col("_word.total") / F.greatest(F.col("_word.n_words"), F.lit(1))
    return scored.select("doc_id", held_out, (1 / (1 + F.exp(-mean - bias))).alias("score"))
