"""What the two text classifiers share: hashed word features and per-word scores.

Both models are linear in a document's words, so a trained model is one number per
word, computed from its features once per distinct word and Python worker while a bounded
cache holds it; the features of many new words are hashed at once. A document's value is the sum or the average over all its words, whatever
its length.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from imagelake.llm.common import text_chunks, worker_caches

BUCKETS = 1 << 18
#: Words per generation of a worker's cache (some 10 MB).
CACHE_WORDS = 50_000
#: Longest text that may enter a training sample.
TRAIN_TEXT_BYTES = 65_536
#: Bytes of words whose features are hashed at once.
STRETCH = 1 << 18


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & np.uint32(1), (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def ngrams(word: bytes, sizes: tuple[int, ...], buckets: int = BUCKETS) -> list[int]:
    """Hash buckets of the whole word and of its n-grams of characters (code points)."""
    w = b"<" + word + b">"
    if word.isascii():
        grams = [w[i:i + n] for n in sizes for i in range(len(w) - n + 1) if n < len(w)]
    else:
        letters = w.decode("utf-8", "replace")
        grams = [letters[i:i + n].encode() for n in sizes for i in range(len(letters) - n + 1) if n < len(letters)]
    return [zlib.crc32(g) % buckets for g in (w, *grams)]


def crc32s(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """zlib.crc32 of many short stretches of ``data`` (bytes)."""
    c = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    length = stops - starts
    for k in range(int(length.max(initial=0))):
        live = slice(None) if k < length.min() else np.flatnonzero(length > k)
        now = c[live]
        c[live] = _CRC[(now ^ data[starts[live] + k]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
    return ~c


def many_ngrams(words: list[bytes], sizes: tuple[int, ...], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """``ngrams`` of each word, end to end, and how many each word has."""
    blob = b"<" + b"><".join(words) + b">"
    try:
        blob.isascii() or blob.decode()
    except UnicodeDecodeError:
        each = [ngrams(w, sizes, buckets) for w in words]
        return np.asarray([f for x in each for f in x], np.int64), np.fromiter(map(len, each), np.int64, len(each))
    data = np.frombuffer(blob, np.uint8)
    letters = np.r_[np.flatnonzero((data & 0xC0) != 0x80), len(data)]  # where each code point begins
    last = np.searchsorted(letters, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 2))
    first = np.r_[0, last[:-1]]
    counts = [np.where(last - first > n, last - first - n + 1, 0) for n in sizes]
    total = 1 + sum(counts)
    place = np.cumsum(total) - total
    found = np.empty(int(total.sum()), np.uint32)
    found[place] = np.fromiter((zlib.crc32(b"<%b>" % w) for w in words), np.uint32, len(words))
    place = place + 1
    for n, count in zip(sizes, counts):
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(first, count) + nth
        found[np.repeat(place, count) + nth] = crc32s(data, letters[at], letters[at + n])
        place = place + count
    return (found % np.uint32(buckets)).astype(np.int64), total


def stretches(words: list[bytes]) -> Iterator[list[bytes]]:
    """The words in order, in lists of about STRETCH bytes."""
    part, n = [], 0
    for w in words:
        part.append(w)
        n += len(w)
        if n >= STRETCH:
            yield part
            part, n = [], 0
    if part:
        yield part


class Examples:
    """Training documents as distinct words with counts, and words as features."""

    def __init__(self, docs: Iterable[list[bytes]], sizes: tuple[int, ...], buckets: int = BUCKETS):
        index: dict[bytes, int] = {}
        self.rows = []
        for words in docs:
            c = Counter(words)
            ids = np.fromiter((index.setdefault(w, len(index)) for w in c), np.int32, len(c))
            share = np.fromiter(c.values(), np.float32, len(c)) / max(1, len(words))
            self.rows.append((ids, share))
        counts, features = array("i"), array("i")
        for w in index:
            f = ngrams(w, sizes, buckets)
            counts.append(len(f))
            features.extend(f)
        self.sizes = np.frombuffer(counts, np.int32).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.features = np.frombuffer(features, np.int32)

    def batch(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the batch, feature, value) of every feature of these documents;
        the values of a document sum to 1."""
        ids = np.concatenate([self.rows[r][0] for r in rows])
        share = np.concatenate([self.rows[r][1] for r in rows])
        doc = np.repeat(np.arange(len(rows)), [len(self.rows[r][0]) for r in rows])
        n = self.sizes[ids]
        at = np.repeat(self.starts[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(doc, n), self.features[at], np.repeat(share / np.maximum(n, 1), n)


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, where: Column | None = None,
           text_bytes: int = TRAIN_TEXT_BYTES) -> list[tuple[bytes, int]]:
    """Whole texts and labels of at most ``rows`` labelled documents of at most ``text_bytes``
    each, in hash order of their ids: no more comes to the driver, however often an id repeats."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if where is not None:
        known = known.where(where)
    ids = known.groupBy("doc_id").agg(F.max(label).alias("_label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    text = F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("text")
    picked = docs.select("doc_id", text).where(F.octet_length("text") <= text_bytes).join(F.broadcast(ids), "doc_id")
    got = picked.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows).collect()
    return [(bytes(r["text"]), int(r["_label"])) for r in sorted(got, key=lambda r: (r["doc_id"], bytes(r["text"])))]


def with_word_scores(docs: DataFrame, model: object, weigh: Callable[[object, list[bytes]], Iterable[float]],
                     split: Callable[[bytes], list[bytes]], name: str) -> DataFrame:
    """``docs`` and a struct column ``name``: n_words, and total, the sum over the words of a whole text of
    the word's entry in ``weigh(model, words)``. ``model`` is broadcast: it must be bounded by its training, not by the rows."""
    key = uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<n_words: long, total: double>")
    def score(texts: pa.Array) -> pa.Array:
        fitted, (cache,) = shared.value, worker_caches(key, CACHE_WORDS)
        counts, totals = [], []
        for chunk in text_chunks(t.as_py() for t in texts.cast(pa.binary())):
            parted = [split(text) for text in chunk]
            known = {x: cache.get(x) for x in dict.fromkeys(x for words in parted for x in words)}
            new = [x for x, s in known.items() if s is None]
            for some in stretches(new):
                for x, s in zip(some, weigh(fitted, some)):
                    known[x] = s
                    cache.put(x, s)
            for words in parted:
                counts.append(len(words))
                totals.append(float(sum(map(known.__getitem__, words))))
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(totals, pa.float64())], ["n_words", "total"])

    return docs.withColumn(name, score("text"))
