"""Toxicity by cumulative-link ordinal regression on sparse text features.

Features are hashed words (lower case, outer punctuation off) and character n-grams; a
document's value for a feature is the number of its distinct words that have it. Only
features that the two labels do not share alike (``MIN_G2``, a likelihood-ratio statistic
over documents) enter the fit: texts hold far more rare words than there are labels, and a
weight for each would learn the training rows by heart. One weight vector serves all
severity grades; grade k or more has the chance sigmoid(w . x - t_k) with ordered
thresholds t_1 < t_2 < ... . The expected severity is the sum of those chances.

Labels say toxic or not. Grades come from a first fit on those two: toxic training
documents whose score is above their median are grade 2, the others grade 1.

The fit takes a bounded sample of labelled rows (``train_rows``) by numpy gradient
steps on the driver. Every row of ``docs`` is scored over its whole text.

Defined cases: null and empty texts have severity by the thresholds alone (a clean
text's); without labels of both kinds nothing is rejected and severity is 0; labels
that are null are not used; repeated rows are scored one by one; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from imagelake.llm.word_models import Examples, many_ngrams, sample, with_word_scores

SIZES = (4, 5, 6)
BUCKETS = 1 << 22
TRAIN_ROWS = 8000
#: Least likelihood ratio of a feature; 20 is passed by chance by one feature in 130,000.
MIN_G2 = 20.0
#: Features judged at once on the driver.
BLOCK = 1 << 17
STEPS = 300
RATE = 0.05
RIDGE = 0.05
#: Documents of this expected severity are rejected.
REJECT = 0.4
_OUTER = b".,;:!?\"'()[]{}<>*#$%&|-"


def tokens(text: bytes) -> list[bytes]:
    """Distinct words: one word repeated over and over says no more than once."""
    return list({w.strip(_OUTER): None for w in text.lower().split()})


def weigh(weights: dict[int, float], words: list[bytes]) -> Iterator[float]:
    """Sum of the weights of each word's features."""
    features, sizes = many_ngrams(words, SIZES, BUCKETS)
    found = [weights.get(f, 0.0) for f in features.tolist()]
    ends = np.cumsum(sizes)
    return (sum(found[lo:hi]) for lo, hi in zip((ends - sizes).tolist(), ends.tolist()))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def telling(found: np.ndarray, size: np.ndarray) -> np.ndarray:
    """G2 of each feature: ``found[label, feature]`` documents of ``size[label]`` have it."""
    found = found.astype(float)
    share = found.sum(0) / size.sum()
    out = np.zeros(found.shape[1])
    for have, n in zip(found, size):
        for seen, expected in ((have, n * share), (n - have, n * (1 - share))):
            out += 2 * seen * np.log(np.where(seen > 0, seen, 1) / np.where(seen > 0, expected, 1))
    return out


def features(examples: Examples, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chosen features, and (document, number of a chosen feature) for each distinct word that has one."""
    found = np.zeros((2, BUCKETS), np.int32)
    for i, label in enumerate(y):
        found[label, np.unique(examples.batch(np.array([i]))[1])] += 1
    seen = np.flatnonzero(found.any(0))
    size = np.bincount(y, minlength=2)
    blocks = [seen[lo:lo + BLOCK] for lo in range(0, len(seen), BLOCK)] or [seen]
    chosen = np.concatenate([b[telling(found[:, b], size) >= MIN_G2] for b in blocks])
    number = np.full(BUCKETS, -1, np.int32)
    number[chosen] = np.arange(len(chosen))
    doc, col = [], []
    for i in range(len(y)):
        at = number[examples.batch(np.array([i]))[1]]
        at = at[at >= 0]
        doc.append(np.full(len(at), i))
        col.append(at)
    return chosen, np.concatenate(doc), np.concatenate(col)


def fit(doc: np.ndarray, col: np.ndarray, grades: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights (starting from ``weights``) and increasing thresholds, by Adam steps with a ridge penalty."""
    top, n = int(grades.max()), len(weights)
    # thresholds as a first one and positive steps, so that they stay in order
    p = np.concatenate([weights, [1.0], np.zeros(top - 1)])
    m, v = np.zeros(len(p)), np.zeros(len(p))
    at = np.arange(len(grades))
    for step in range(1, STEPS + 1):
        x = np.bincount(doc, p[col], len(grades))
        gaps = np.concatenate([[1.0], np.exp(p[n + 1:])])
        cut = np.cumsum(np.concatenate([p[n:n + 1], gaps[1:]]))
        above = _sigmoid(x[:, None] - cut)  # chance of grade k or more
        full = np.concatenate([np.ones((len(grades), 1)), above, np.zeros((len(grades), 1))], 1)
        hi, lower = full[at, grades], full[at, grades + 1]
        chance = np.maximum(hi - lower, 1e-9)
        d_hi, d_lo = hi * (1 - hi) / chance, lower * (1 - lower) / chance  # of log chance, by the two cut distances
        d_cut = np.zeros(top)
        np.add.at(d_cut, grades[grades > 0] - 1, d_hi[grades > 0])
        np.add.at(d_cut, grades[grades < top], -d_lo[grades < top])
        g = np.concatenate([np.bincount(col, (d_lo - d_hi)[doc], n) + RIDGE * p[:n],
                            np.cumsum(d_cut[::-1])[::-1] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return p[:n], np.cumsum(np.concatenate([p[n:n + 1], np.exp(p[n + 1:])]))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[dict[int, float], np.ndarray] | None:
    """Weights by feature and thresholds, or None without labels of both kinds."""
    # a fixed part of the rows for each label, so that rare toxic documents are seen
    got = [x for v, part in ((0, train_rows * 4 // 5), (1, train_rows // 5))
           for x in sample(docs, labels, "toxic", part, F.col("toxic") == v)]
    y = np.array([label for _, label in got], int)
    if len(set(y.tolist())) < 2:
        return None
    chosen, doc, col = features(Examples((tokens(text) for text, _ in got), SIZES, BUCKETS), y)
    w, _ = fit(doc, col, y, np.zeros(len(chosen)))
    x = np.bincount(doc, w[col], len(y))
    grades = y + ((y == 1) & (x > np.median(x[y == 1])))
    w, cuts = fit(doc, col, grades, w)
    return dict(zip(chosen.tolist(), w.tolist())), cuts


def with_severity(docs: DataFrame, labels: DataFrame, name: str, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs``, all columns, and ``name``: the expected grade of the text, 0 to 2. Rows stay where they are."""
    model = train(docs, labels, train_rows)
    if model is None:
        return docs.withColumn(name, F.lit(0.0))
    weights, cuts = model
    scored = with_word_scores(docs, weights, weigh, tokens, name)
    total = F.col(name)["total"]
    chances = [1 / (1 + F.exp(F.lit(float(c)) - total)) for c in cuts]
    return scored.withColumn(name, sum(chances[1:], chances[0]))


def toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, severity (expected grade, 0 to 2), rejected per row of ``docs``."""
    scored = with_severity(docs.select("doc_id", "text"), labels, "severity", train_rows)
    return scored.select("doc_id", "severity", (F.col("severity") >= REJECT).alias("rejected"))


def without_toxic(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, that are not rejected."""
    return with_severity(docs, labels, "_severity", train_rows).where(F.col("_severity") < REJECT).select(*docs.columns)
