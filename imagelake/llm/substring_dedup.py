"""Exact substring dedup with fixed-block anchors.

A word goes when a window of ``WINDOW`` consecutive words that covers it also starts
in a document with a smaller doc_id.

1. Index and probes. Every document contributes its non-overlapping blocks of
   ``BLOCK`` words (the index) and all its rolling windows of that length (the
   probes). A window of 2 * BLOCK words contains an indexed block of any other
   document that holds it, at whatever offset, so no repeat is missed.
2. Hits. Index and probes meet by hash bucket. A hit is a probe whose hash is
   indexed and occurs in two documents or more.
3. Extension. Only windows of WINDOW words around hits are looked at again, with
   128-bit hashes of the whole window, and the smallest document of each decides.
   Neighbouring windows merge to maximal repeats.

Both meetings send packed arrays (some 10 bytes a window) rather than rows. Before
sending, a task settles what it can among its own documents: of windows that
repeat there, only those of the smallest document travel. So a passage shared by a
third of all documents reaches its bucket once per task batch, not once per
document. Buckets are numbered after the size of the corpus; a task holds one. What it
decides leaves a task as runs, packed once per destination, not per bucket: at most
tasks x destinations rows, however many rows share a passage.

Defined cases: null and empty texts have no words; null doc_id counts as the largest
id; rows that share a doc_id, or have none, never remove each other's words, and each
keeps its own runs (rows are known by a 64-bit hash of doc_id and text); an empty
table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imagelake.llm.common import materialize, release_shuffles, width
from imagelake.llm.word_hashes import rolling, word_hashes, word_places

WINDOW = 50
BLOCK = 25
#: Text whose windows a task settles at once, and windows per bucket, about.
BATCH_BYTES = 2_000_000
BUCKET_WORDS = 1_000_000
#: Runs a task gathers before it sends them on (some 10 MB).
HELD_RUNS = 500_000
NULL_ID = 2 ** 63 - 1
#: kind 0: windows to be decided; kind 1: runs of rows that are settled
ROUTED = "bucket int, kind int, payload binary"
RUNS = "row long, starts array<int>, ends array<int>"
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Chunk:
    """Documents of one batch laid end to end."""

    def __init__(self, ids: list[int], rows: list[int], texts: list[bytes], hashes: int):
        self.ids, self.rows = np.asarray(ids, np.int64), np.asarray(rows, np.int64)
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        starts, stops = word_places(data)
        text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        self.ends = np.searchsorted(starts, text_ends)
        self.sizes = np.diff(self.ends, prepend=0)
        self.begins = self.ends - self.sizes
        self.words = [word_hashes(data, starts, stops, which) for which in range(hashes)]

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Row of its document, and place in the batch, of each window of ``length`` words."""
        counts = np.maximum(self.sizes - length + 1, 0)
        row = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        first = np.cumsum(counts) - counts
        return row, np.arange(counts.sum()) - np.repeat(first - self.begins, counts)


def chunks(batches: Iterator[pa.RecordBatch], hashes: int, extra: list[str]) -> Iterator[tuple[Chunk, list[list]]]:
    """Batches of about BATCH_BYTES of text, with the further columns of their rows."""
    ids: list[int] = []
    rows: list[int] = []
    texts: list[bytes] = []
    more: list[list] = [[] for _ in extra]
    n = 0
    for batch in batches:
        column = batch.column("text").cast(pa.binary())
        doc_ids, keys = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
        cols = [batch.column(c) for c in extra]
        for i, doc_id in enumerate(doc_ids):
            texts.append(column[i].as_py() or b"")
            ids.append(doc_id)
            rows.append(keys[i])
            for m, c in zip(more, cols):
                m.append(c[i].values.to_numpy() if c[i].is_valid else None)
            n += len(texts[-1])
            if n >= BATCH_BYTES:
                yield Chunk(ids, rows, texts, hashes), more
                ids, rows, texts, more, n = [], [], [], [[] for _ in extra], 0
    if ids:
        yield Chunk(ids, rows, texts, hashes), more


def same_groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and the group number at each place of it."""
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys)
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.cumsum(new)


def per_group(ufunc: np.ufunc, values: np.ndarray, group: np.ndarray) -> np.ndarray:
    """``ufunc`` over each group of ``values`` (in group order), repeated for its members."""
    if not len(values):
        return values
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    return ufunc.reduceat(values, starts)[group]


def run_rows(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> dict[str, pa.Array]:
    """One row per entry of ``rows`` with its runs, in order and merged where they overlap."""
    order = np.lexsort((starts, rows))
    rows, starts, ends = rows[order], starts[order].astype(np.int64), ends[order].astype(np.int64)
    at = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.empty(0, int)
    nth = np.zeros(len(rows), np.int64)
    nth[at[1:]] = 1
    base = np.cumsum(nth) << 32  # a row's places lie beyond those of the rows before
    upto = np.maximum.accumulate(base + ends)
    new = np.r_[True, base[1:] + starts[1:] > upto[:-1]] if len(rows) else np.empty(0, bool)
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(rows)] - 1
    rows, starts, ends = rows[first], starts[first], (upto - base)[last] if len(rows) else ends
    at = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.empty(0, int)
    offsets = pa.array(np.r_[at, len(rows)].astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (starts, ends)]
    return {"row": pa.array(rows[at], pa.int64()), "starts": lists[0], "ends": lists[1]}


def merged_runs(ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive places of an id as runs [start, end); sorted by id. Places may repeat."""
    order = np.lexsort((places, ids))
    ids, places = ids[order], places[order]
    new = np.r_[True, (ids[1:] != ids[:-1]) | (places[1:] != places[:-1])] if len(ids) else np.empty(0, bool)
    ids, places = ids[new], places[new]
    first = np.r_[True, (ids[1:] != ids[:-1]) | (places[1:] != places[:-1] + 1)] if len(ids) else np.empty(0, bool)
    at = np.flatnonzero(first)
    last = np.r_[at[1:], len(ids)] - 1
    return ids[at], places[at], places[last.astype(int)] + 1 if len(at) else places[at]


def by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """An order that brings buckets together, the buckets that occur, and where each lies in it."""
    small = len(bucket) and bucket.max() < 65536  # short numbers sort faster
    order = np.argsort(bucket.astype(np.uint16) if small else bucket, kind="stable")
    bucket = bucket[order]
    at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, int)
    return order, bucket[at].astype(np.int32), list(zip(at.tolist(), np.r_[at[1:], len(bucket)].tolist()))


def packed_runs(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, spread: int) -> tuple[np.ndarray, list[bytes]]:
    """Runs, packed for the destinations (``spread`` of them) of their rows."""
    to = (rows.astype(np.uint64) * np.uint64(_ODD[0]) >> np.uint64(33)) % np.uint64(spread)
    order, sent, spans = by_bucket(to)
    cols = rows[order], starts[order].astype(np.int32), ends[order].astype(np.int32)
    return sent, [b"".join(c[lo:hi].tobytes() for c in cols) for lo, hi in spans]


def unpacked_runs(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, starts and ends of packed runs."""
    n = len(payload) // 16
    return np.frombuffer(payload, np.int64, n), np.frombuffer(payload, np.int32, n, 8 * n), np.frombuffer(payload, np.int32, n, 12 * n)


def routed(bucket: np.ndarray, spread: int, ids: np.ndarray, rows: np.ndarray, places: np.ndarray, keys: list[np.ndarray],
           settled: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    """Rows to send: a packed array per bucket, and what is settled here already."""
    order, sent, spans = by_bucket(bucket)
    ids, rows, places, keys = ids[order], rows[order], places[order], [k[order] for k in keys]
    payloads = []
    for lo, hi in spans:
        d, r, p = ids[lo:hi], rows[lo:hi], places[lo:hi].astype(np.uint32)
        at = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        parts = [np.asarray([hi - lo, len(at)], np.int32), d[at], r[at], np.diff(np.r_[at, hi - lo]).astype(np.uint32),
                 (p & np.uint32(0xFFFF)).astype(np.uint16), (p >> np.uint32(16)).astype(np.uint16)]
        parts += [k[lo:hi] for k in keys]
        payloads.append(b"".join(x.tobytes() for x in parts))
    done, runs = packed_runs(*merged_runs(*settled), spread)
    return pa.RecordBatch.from_arrays([
        pa.array(np.r_[sent, done], pa.int32()), pa.array(np.repeat([0, 1], [len(sent), len(done)]), pa.int32()),
        pa.array(payloads + runs, pa.binary())], ["bucket", "kind", "payload"])


def unpacked(payload: bytes, types: list[str]) -> tuple[np.ndarray, ...]:
    """ids, rows, places and keys of a packed array."""
    n, docs = np.frombuffer(payload, np.int32, 2)
    at = 8

    def take(dtype: str, count: int) -> np.ndarray:
        nonlocal at
        x = np.frombuffer(payload, dtype, count, at)
        at += x.nbytes
        return x

    ids, rows, times = take("i8", docs), take("i8", docs), take("u4", docs)
    low, high = take("u2", n), take("u2", n)
    places = low.astype(np.int64) | (high.astype(np.int64) << 16)
    return np.repeat(ids, times), np.repeat(rows, times), places, *[take(t, n) for t in types]


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def held_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes] | None, bytes | None]]:
    """(bucket, payloads, None) of the windows, and (destination, None, payload) of settled runs as they come."""
    now, held = None, []
    for batch in batches:
        for b, kind, payload in zip(*(batch.column(c) for c in ("bucket", "kind", "payload"))):
            if kind.as_py():
                yield b.as_py(), None, payload.as_py()
                continue
            if b.as_py() != now:
                if held:
                    yield now, held, None
                now, held = b.as_py(), []
            held.append(payload.as_py())
    if held:
        yield now, held, None


def settled_runs(batches: Iterator[pa.RecordBatch], types: list[str], decide: Callable[..., np.ndarray],
                 spread: int) -> Iterator[pa.RecordBatch]:
    """Runs of the windows that ``decide`` chooses in each bucket, and those that came settled: those
    of all buckets of a task together, one packed array per destination."""
    found: list[tuple[np.ndarray, ...]] = []
    n = 0

    def packed() -> pa.RecordBatch:
        sent, runs = packed_runs(*(np.concatenate(x) for x in zip(*found)), spread)
        return pa.RecordBatch.from_arrays([pa.array(sent, pa.int32()), pa.array([0] * len(runs), pa.int32()),
                                           pa.array(runs, pa.binary())], ["bucket", "kind", "payload"])

    for _, held, payload in held_buckets(batches):
        if held is None:
            runs = unpacked_runs(payload)
        else:
            ids, rows, places, *keys = (np.concatenate(x) for x in zip(*(unpacked(p, types) for p in held)))
            take = decide(ids, *keys)
            rows, starts, ends = merged_runs(rows[take], places[take])
            runs = rows, starts.astype(np.int32), ends.astype(np.int32)
        found.append(runs)
        n += len(runs[0])
        if n >= HELD_RUNS:
            yield packed()
            found, n = [], 0
    if n:
        yield packed()


def meet(routed_rows: DataFrame, types: list[str], decide: Callable[..., np.ndarray], parts: int, spread: int) -> DataFrame:
    """Bring buckets together; ``decide`` says which of a bucket's windows to return. The runs of
    all buckets then meet by row, packed again (RUNS, one row per row of the documents)."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return settled_runs(batches, types, decide, spread)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, _ in held_buckets(batches):
            yield pa.RecordBatch.from_pydict(run_rows(*(np.concatenate(x) for x in zip(*map(unpacked_runs, held)))))

    together = lambda df: df.repartition(parts, "bucket").sortWithinPartitions("bucket", "kind")
    return together(together(routed_rows).mapInArrow(settle, ROUTED)).mapInArrow(gather, RUNS)


def with_runs(docs: DataFrame, runs: DataFrame, how: str) -> DataFrame:
    """``docs`` and the runs of their rows. Runs are as many as rows, so they are never broadcast:
    a join that is so at some sizes only takes disk for the texts all of a sudden."""
    return docs.join(runs.hint("merge"), "row", how)


def anchor_hits(docs: DataFrame, buckets: int, spread: int, parts: int, block: int) -> DataFrame:
    """Step 1 and 2: per row the starts of blocks that are hits, as runs."""

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, _ in chunks(batches, 1, []):
            row, at = chunk.windows(block)
            h = rolling(chunk.words[0], block, _ODD[0])[at]
            ids, rows, places = chunk.ids[row], chunk.rows[row], at - chunk.begins[row]
            order, group = same_groups(h)
            least, most = (per_group(f, ids[order], group) for f in (np.minimum, np.maximum))
            indexed = per_group(np.bitwise_or, (places[order] % block == 0).astype(np.uint8), group)
            flags, shared, smallest = np.empty(len(h), np.uint64), np.empty(len(h), bool), np.empty(len(h), bool)
            flags[order] = indexed + 2 * (least != most)
            shared[order], smallest[order] = least != most, ids[order] == least
            key = (h & np.uint64(0x3FFFFFFFFFFF)) << np.uint64(2) | flags
            s = smallest
            yield routed(bucket_of(h[s], buckets), spread, ids[s], rows[s], places[s],
                         [(key[s] & np.uint64(0xFFFFFFFF)).astype(np.uint32), (key[s] >> np.uint64(32)).astype(np.uint16)],
                         (rows[shared], places[shared]))

    def decide(ids, low, high):
        key = low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))
        order, group = same_groups(key >> np.uint64(2))
        flags = per_group(np.bitwise_or, (key[order] & np.uint64(3)).astype(np.uint8), group)
        two = per_group(np.minimum, ids[order], group) != per_group(np.maximum, ids[order], group)
        return order[((flags & 1) > 0) & (two | ((flags & 2) > 0))]

    return meet(docs.mapInArrow(probes, ROUTED), ["u4", "u2"], decide, parts, spread)


def repeated_windows(docs_with_hits: DataFrame, buckets: int, spread: int, parts: int, window: int, block: int) -> DataFrame:
    """Step 3: per row the starts of windows that a smaller document has too, as runs."""

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, (starts, ends) in chunks(batches, 2, ["starts", "ends"]):
            # a window is a candidate if a hit block lies within it
            mark = np.zeros(len(chunk.words[0]) + 1, np.int32)
            for size, begin, s, e in zip(chunk.sizes, chunk.begins, starts, ends):
                if size >= window:
                    np.add.at(mark, begin + np.clip(s - (window - block), 0, size - window + 1), 1)
                    np.add.at(mark, begin + np.clip(e, 0, size - window + 1), -1)
            near = np.cumsum(mark)[:-1] > 0
            row, at = chunk.windows(window)
            chosen = near[at]
            row, at = row[chosen], at[chosen]
            h1, h2 = (rolling(h, window, odd)[at] for h, odd in zip(chunk.words, _ODD))
            ids, rows, places = chunk.ids[row], chunk.rows[row], at - chunk.begins[row]
            order, group = same_groups(h1, h2)
            first = np.empty(len(h1), bool)
            first[order] = ids[order] == per_group(np.minimum, ids[order], group)
            yield routed(bucket_of(h1[first], buckets), spread, ids[first], rows[first], places[first], [h1[first], h2[first]],
                         (rows[~first], places[~first]))

    def decide(ids, h1, h2):
        order, group = same_groups(h1, h2)
        return order[ids[order] != per_group(np.minimum, ids[order], group)]

    return meet(docs_with_hits.mapInArrow(candidates, ROUTED), ["u8", "u8"], decide, parts, spread)


def substring_dedup(spark: SparkSession, docs: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_removed, removed (runs of word places), kept_text (kept words,
    joined by one space) per row of ``docs``."""
    if 2 * block > window:
        raise ValueError("a window must hold two blocks")
    release_shuffles(spark)
    parts = width(spark)
    docs = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.select("doc_id", F.xxhash64("doc_id", "text", F.length("text")).alias("row"), "text")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    full = -(-chars // (6 * BUCKET_WORDS))
    buckets, spread = max(4 * parts, full), max(2 * parts, full)
    hits = materialize(spark, anchor_hits(docs, buckets, spread, parts, block), "anchor-hits")
    again = with_runs(docs, hits, "inner")
    repeats = materialize(spark, repeated_windows(again, buckets, spread, parts, window, block), "repeats")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, starts, ends = batch.column("text").cast(pa.binary()), batch.column("starts"), batch.column("ends")
            out: list[list] = [[], [], [], []]
            for i in range(batch.num_rows):
                words = texts[i].as_py().split()
                runs: list[list[int]] = []
                if starts[i].is_valid:
                    s, e = starts[i].values.to_numpy(), ends[i].values.to_numpy()
                    for k in np.argsort(s, kind="stable"):
                        a, b = int(s[k]), int(e[k]) + window - 1
                        if b > len(words):
                            continue
                        if runs and a <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], b)
                        else:
                            runs.append([a, b])
                kept, at = [], 0
                for a, b in runs:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                for c, v in zip(out, (len(words), len(words) - len(kept), runs, b" ".join(kept))):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                pa.array(out[2], pa.list_(pa.list_(pa.int32()))), pa.array(out[3], pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "removed", "kept_text"])

    return with_runs(docs, repeats, "left").mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, removed array<array<int>>, kept_text string").withColumn(
        "doc_id", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")))
