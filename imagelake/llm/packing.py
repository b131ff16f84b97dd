"""Best-fit packing of documents into training sequences, planned over lengths.

Documents are tokenised in Arrow batches and cut into pieces only where they exceed
the capacity. The planner sees the histogram of piece lengths (at most ``capacity``
rows), never a document: it packs best-fit decreasing, a whole count of equal pieces
into a whole count of equally filled sequences per step. A plan row says which ranks
within a length go to which sequences. Each piece then takes its slot by joining the
plan on length and rank. The plan's size depends on the capacity alone: every step
uses up a length or a group of equally filled sequences.

Ranks within a length are not counted in one task, however many pieces share the
length: they are row numbers within (length, hash bucket) plus the counts of the
buckets before.

Tokenising works on the runs between spaces (a piece of text that the tokenizer
never merges across) through a bounded cache, so each distinct run is encoded once
per Python worker while the cache holds it. The runs of many texts are told apart, looked up
and put together in Arrow columns; only new pieces of runs become Python objects. New runs are
encoded together; plain letters, which normalising and splitting leave as they are but for
case, go to the tokenizer's model at once.

Defined cases: null and empty texts have no ids but the end id, a piece of length 1;
repeated rows and null doc_ids are packed row by row; an empty table gives an empty
result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import os
import re
import string
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from imagelake.llm.common import Recent, materialize, pow2_at_least, text_chunks, worker_caches

CAPACITY = 2048
END_ID = 0
#: Half of the runs that a worker remembers (some 34 MB in all), beside half as many pieces of runs (some 17 MB).
CACHE_RUNS = 400_000
#: Bytes of text whose runs are looked up together, about. Each time costs as much as the caches are large.
CHUNK_BYTES = 16_000_000
#: Pieces that go through the tokenizer at once.
LEARN_PIECES = 20_000
#: Closing marks that are looked up apart from the letters before them.
MARKS = string.punctuation
#: Last of the Latin letters, whose lower case and normal form depend on no neighbour.
LAST_LETTER = "\u024f"
#: Pieces per bucket of the rank count, about.
BUCKET_ROWS = 2_000
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


def is_plain(piece: str) -> bool:
    """Only letters up to LAST_LETTER, none of which lower case takes apart."""
    return piece.isalpha() and (piece.isascii() or max(piece) <= LAST_LETTER and piece.lower().isalpha())


@lru_cache(maxsize=1)
def run_encoder(tokenizer_path: str) -> Callable[[list[bytes], Recent, Recent], list[bytes]]:
    """Function from whole texts (UTF-8), and caches of runs and of pieces (used by column), to the
    texts' ids as little-endian uint32 bytes. One per Python worker: the tokenizer is loaded once."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path)
    tokenize = tok.model.tokenize
    # the model sees characters that stand for bytes: printable ones for themselves
    solid = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stands = np.arange(256, dtype="<u4")
    stands[sorted({*range(256)} - {*solid})] = range(256, 256 + 256 - len(solid))

    def column(ids: Iterable[int], cuts: Iterable[int]) -> pa.Array:
        """The ids as bytes, cut apart."""
        at, flat = 4 * np.asarray(cuts, np.int64), np.asarray(ids, "<u4")
        return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(flat)])

    def by_model(pieces: list[str]) -> pa.Array:
        """Ids of each piece; all are plain."""
        found, cuts = [], [0]
        whole = np.frombuffer("\n".join(pieces).lower().encode(), np.uint8)
        for p in stands[whole].tobytes().decode("utf-32-le").split(chr(stands[ord("\n")])):
            found += [t.id for t in tokenize(p)]
            cuts.append(len(found))
        return column(found, cuts)

    def parts(run: bytes) -> list[str]:
        """Letters and closing marks of a run apart, which the tokenizer always parts. A letter
        that becomes a letter and a combining mark in its normal form joins with the marks,
        so such a run stays whole."""
        text = run.decode("utf-8", "replace")
        stem = text.rstrip(MARKS)
        plain = stem.lower() if stem.isascii() else unicodedata.normalize("NFC", stem).lower()
        if not plain.isalpha():
            return [text]
        stem = plain if stem.isascii() else stem
        return [stem, text[len(stem):]] if len(stem) < len(text) else [stem]

    def encoded(pieces: list[str]) -> pa.Array:
        """Ids of each piece. All go through the tokenizer as one text; a token belongs to
        the piece in which its first character stands."""
        e = tok.encode(" ".join(pieces), add_special_tokens=False)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1
        begins = np.cumsum(sizes) - sizes
        at = np.fromiter(chain.from_iterable(e.offsets), np.int64, 2 * len(e.ids))[::2]
        return column(e.ids, [*np.searchsorted(at, begins).tolist(), len(at)])

    # another tokenizer may treat letters otherwise: then all pieces go through the whole of it
    letters = [c for c in map(chr, range(ord(LAST_LETTER) + 1)) if is_plain(c)]
    probes = [*letters, *map("".join, zip(letters, letters[1:], letters[2:])), "the", "The", "thing", "THING"]
    plain_how = by_model if by_model(probes).equals(encoded(probes)) else encoded
    plain_letters, marks = f"[{''.join(letters)}]+", f"[{re.escape(MARKS)}]*"

    def piece_ids(pieces: pa.Array, cache: Recent) -> pa.Array:
        """Ids of each of different pieces."""
        ids = cache.get_column(pieces)
        if ids.null_count:
            new = ids.is_null()
            some = pieces.filter(new)
            plain = pc.match_substring_regex(some, f"^{plain_letters}$")
            found, places = [], []
            for how, mask in ((plain_how, plain), (encoded, pc.invert(plain))):
                places.append(np.flatnonzero(mask))
                of = some.filter(mask).to_pylist()
                found += [how(of[lo:lo + LEARN_PIECES]) for lo in range(0, len(of), LEARN_PIECES)]
            back = np.argsort(np.concatenate(places))
            ids = pc.replace_with_mask(ids, new, pa.concat_arrays(found).take(pa.array(back)))
        cache.put_column(pieces, ids)
        return ids

    def learn(runs: pa.Array, cache: Recent) -> pa.Array:
        """Ids of each of different runs."""
        found = pc.extract_regex(runs, f"^(?P<stem>{plain_letters})(?P<marks>{marks})$")
        plain = found.is_valid()
        split = [parts(r) for r in runs.filter(pc.invert(plain)).view(pa.large_binary()).to_pylist()]
        found = found.filter(plain)
        # the first pieces of all runs, those of plain runs before the others, and then the second ones
        both = pa.concat_arrays([
            pc.ascii_lower(found.field("stem")), pa.array([x[0] for x in split], pa.large_string()),
            found.field("marks"), pa.array([x[1] if len(x) > 1 else "" for x in split], pa.large_string())]).dictionary_encode()
        ids = piece_ids(both.dictionary, cache).take(both.indices)
        joined = pc.binary_join_element_wise(ids[:len(runs)], ids[len(runs):], pa.scalar(b"", pa.large_binary()))
        back = np.argsort(np.concatenate([np.flatnonzero(plain), np.flatnonzero(pc.invert(plain))]))
        return joined.take(pa.array(back))

    def encode(texts: list[bytes], runs_cache: Recent, pieces_cache: Recent) -> list[bytes]:
        # split at space and U+0009 to U+000D only, byte by byte
        parted = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string()))
        runs = parted.flatten().dictionary_encode()
        ids = runs_cache.get_column(runs.dictionary)
        if ids.null_count:
            new = ids.is_null()
            ids = pc.replace_with_mask(ids, new, learn(runs.dictionary.filter(new), pieces_cache))
        runs_cache.put_column(runs.dictionary, ids)
        ids = ids.take(runs.indices)
        _, ends, data = ids.buffers()
        cuts = np.frombuffer(ends, np.int64)[parted.offsets.to_numpy()].tolist()
        data = memoryview(data or b"")
        return [bytes(data[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]

    return encode


def grouped(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The batches in order, as many together as have ``size`` bytes."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.nbytes
        if n >= size:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                     with_ids: bool = False, cache_runs: int = CACHE_RUNS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids: little-endian uint32) per piece.
    ``cache_runs``: half of the runs that a Python worker remembers; ids do not depend on it."""
    schema = PIECES + (", ids binary" if with_ids else "")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib
        encode, end, step = run_encoder(tokenizer_path), np.asarray([end_id], "<u4").tobytes(), 4 * capacity
        caches = worker_caches(tokenizer_path, cache_runs, cache_runs // 2)
        for some in grouped(batches, CHUNK_BYTES):
            cols: list[list] = [[] for _ in range(5 + with_ids)]
            column = some.column("text").cast(pa.binary())
            texts = text_chunks((t.as_py() for t in column), column.nbytes // max(1, round(column.nbytes / CHUNK_BYTES)))
            for doc_id, ids in zip(some.column("doc_id").to_pylist(), (x + end for chunk in texts for x in encode(chunk, *caches))):
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    row = (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part)
                    for c, v in zip(cols, row):
                        c.append(v)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names[:len(cols)])

    return docs.select("doc_id", "text").mapInArrow(pieces, schema)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, lo, hi, sequence, offset, per).

    The pieces of ``length`` with rank lo <= r < hi go, ``per`` at a time, to the
    sequences from ``sequence`` on, the first of each at ``offset``.
    """
    rows = []
    room: dict[int, list[tuple[int, int]]] = {}  # tokens left -> [(first sequence, sequences)]
    made = 0
    for length in sorted((n for n, c in histogram.items() if c), reverse=True):
        lo, left = 0, histogram[length]
        fits = sorted(r for r in room if r >= length)
        while left:
            if fits:
                r = fits[0]
                first, count = room[r].pop()
                if not room[r]:
                    del room[r]
                    fits.pop(0)
            else:
                r, first = capacity, made
                count = -(-left // (capacity // length))
                made += count
            per = r // length
            full = min(count, left // per)
            some = left - full * per if full < count else 0
            rows.append((length, lo, lo + full * per + some, first, capacity - r, per))
            lo, left = lo + full * per + some, left - full * per - some
            for n, used, at in ((full, per, first), (1 if some else 0, some, first + full),
                                (count - full - (1 if some else 0), 0, first + full + (1 if some else 0))):
                if n and r - used * length > 0:
                    # what is left over after ``left`` ran out may still fit shorter pieces
                    room.setdefault(r - used * length, []).append((at, n))
    return rows


def with_ranks(spark: SparkSession, pieces: DataFrame) -> DataFrame:
    """Add ``rank``: place of a piece among the pieces of its length, from 0."""
    buckets = pow2_at_least(pieces.count() / BUCKET_ROWS)
    d = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(buckets)))
    by_length = Window.partitionBy("length").orderBy("_bucket")  # one row per bucket
    starts = d.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        "length", "_bucket", (F.sum("_n").over(by_length) - F.col("_n")).alias("_start"))
    own = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32"))
    return d.withColumn("_own", own).join(starts, ["length", "_bucket"]).select(
        *pieces.columns, (F.col("_start") + F.col("_own") - 1).alias("rank"))


def pack(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (a table, read more than once)."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("_length", T.IntegerType()), ("_lo", T.LongType()), ("_hi", T.LongType()), ("_sequence", T.LongType()),
        ("_offset", T.LongType()), ("_per", T.LongType()))])
    slots = spark.createDataFrame(plan(histogram, capacity), schema)
    ranked = with_ranks(spark, pieces)
    nth = F.col("rank") - F.col("_lo")
    taken = ranked.join(F.broadcast(slots), (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("_lo"))
                        & (F.col("rank") < F.col("_hi")))
    return taken.select(*pieces.columns, (F.col("_sequence") + F.floor(nth / F.col("_per"))).alias("sequence_id"),
                        (F.col("_offset") + F.pmod(nth, F.col("_per")) * F.col("length")).alias("offset"))


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                   with_ids: bool = False, cache_runs: int = CACHE_RUNS) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    found = tokenized_pieces(docs, tokenizer_path, capacity, with_ids=with_ids, cache_runs=cache_runs)
    return pack(spark, materialize(spark, found, "pieces"), capacity)
