"""Embedding near-dedup: product quantisation over coarse inverted lists, exact rerank.

Vectors of one label are linked at a cosine of ``COSINE`` or more. Equal vectors of a
label form a class (``vec_id`` order gives its number); only classes are compared.

1. Codebooks, fitted by k-means on a bounded sample of ``SAMPLE`` classes in hash order:
   coarse centres (about one per ``LIST_ROWS`` classes, at most ``MAX_LISTS``) and, per
   subspace, ``CODES`` code words of the residuals.
2. Index. Every class goes to the inverted list of its label and nearest centre, with
   one byte per subspace for its residual and the length of what the code leaves out.
3. Probes. A class visits every list whose border with its own is nearer than
   ``margin``; there is no fixed number of probes. Two linked ends are at most ``REACH``
   apart, so the border between their lists is within REACH / 2 of one of them: with
   ``margin=EXACT`` no link can be missed. The default saves two thirds of those visits
   and misses only pairs of which more than 2 * MARGIN of the difference points
   straight across the border (in 64 numbers, four standard deviations).
4. Distances. In a list, the distances of a visitor to the coded members are sums of
   table entries, one table per subspace. A member whose coded distance exceeds REACH
   by more than its code left out cannot be linked (triangle inequality); all others
   are compared by exact cosine in double precision.

Lists of more than ``BLOCK_ROWS`` members or visitors are cut into blocks that meet pairwise
in tasks of their own, so a label or list with a third of all rows is spread and a
task holds one block. A meeting returns no pairs, only the number of links per class
and enough links to connect what is connected: rows grow with the classes, not with
the pairs of a dense group. A pair that meets in two lists counts in the first.

Defined cases: vectors that are null, empty, zero or hold null or non-finite numbers,
and rows without a label, link with nothing; vectors of different lengths are
compared with zeros behind the shorter one; a null vec_id counts as the largest id;
rows that share a vec_id are rows of their own, and each counts as a link of the other;
an empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from imagelake.llm.common import materialize, split_join, width
from imagelake.llm.components import components
from imagelake.llm.vectors import matrix, whole_vectors

COSINE = 0.93
#: Distance of two unit vectors at that cosine.
REACH = float(np.sqrt(2 - 2 * COSINE))
SAMPLE = 16_384
LIST_ROWS = 1_024
MAX_LISTS = 4_096
SUBSPACES, CODES = 8, 256
MARGIN = 0.1
EXACT = REACH / 2
BLOCK_ROWS = 2_048
#: Visitors compared at once.
STEP = 512
ROUNDS = 8
NULL_ID = 2 ** 63 - 1
PLACED = ("class_id long, size long, label long, home int, visits array<int>, codes binary, left double, vec binary")
MEETING = ["label", "cell", "block", "part"]


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre, and squared distances to all, per row of ``x``."""
    d = (x * x).sum(1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(1)
    return d.argmin(1), np.maximum(d, 0)


def kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """At most ``k`` centres of ``x`` by Lloyd's rounds; a centre without rows stays."""
    rng = np.random.default_rng(seed)
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        near = nearest(x, centres)[0]
        order = np.argsort(near, kind="stable")
        used, first = np.unique(near[order], return_index=True)
        sums = np.add.reduceat(x[order], first)
        centres[used] = sums / np.diff(np.r_[first, len(x)])[:, None]
    return centres


@dataclass(frozen=True)
class Codebook:
    """Coarse centres (lists x width) and code words (subspaces x codes x numbers)."""
    centres: np.ndarray
    words: np.ndarray

    @staticmethod
    def fit(sample: np.ndarray, lists: int) -> Codebook:
        centres = kmeans(sample, lists, 1)
        rest = sample - centres[nearest(sample, centres)[0]]
        parts = np.split(rest, SUBSPACES, axis=1)
        return Codebook(centres, np.stack([kmeans(p, CODES, 2 + m) for m, p in enumerate(parts)]))

    @cached_property
    def apart(self) -> np.ndarray:
        """Distances between the centres."""
        return np.sqrt(nearest(self.centres, self.centres)[1])

    def place(self, x: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Home list, visited lists (as a mask), codes, and length of what the codes leave out."""
        home, d = nearest(x, self.centres)
        own = d[np.arange(len(x)), home]
        visits = d - own[:, None] <= 2 * margin * self.apart[home] + 1e-9
        visits[np.arange(len(x)), home] = True
        rest = x - self.centres[home]
        parts = np.split(rest, SUBSPACES, axis=1)
        codes = np.stack([nearest(p, w)[0] for p, w in zip(parts, self.words)], 1).astype(np.uint8)
        coded = np.concatenate([w[c] for w, c in zip(self.words, codes.T)], 1)
        return home, visits, codes, np.linalg.norm(rest - coded, axis=1)

    def distances(self, x: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Distance of each visitor to each coded member of a list, by table lookup."""
        total = np.zeros((len(x), len(codes)))
        for part, words, code in zip(np.split(x - self.centres[cell], SUBSPACES, axis=1), self.words, codes.T):
            total += nearest(part, words)[1][:, code]
        return np.sqrt(total)


def unit(packed: list[bytes], columns: int) -> np.ndarray:
    x = matrix(packed, columns)
    x /= np.abs(x).max(1)[:, None]  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1)[:, None]


def keyed(vectors: DataFrame, with_vector: bool) -> DataFrame:
    """vec_id (null as the largest), label, digest of label and vector, and the vector
    packed; digest null for rows that link with nothing."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for batch in batches:
            digests, packed = [], []
            for label, v in zip(batch.column("label").to_pylist(), whole_vectors(batch.column("embedding"))):
                if label is None or v is None or not v.any():
                    v = None
                else:
                    v = np.trim_zeros(v + 0.0, "b").astype("<f8").tobytes()  # -0.0 as 0.0
                packed.append(v)
                digests.append(None if v is None else xxhash.xxh3_128_digest(label.to_bytes(8, "little", signed=True) + v))
            cols = [batch.column("vec_id"), batch.column("label"), pa.array(digests, pa.binary()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["vec_id", "label", "digest", "vec"]).select(names)

    names = ["vec_id", "label", "digest"] + ["vec"] * with_vector
    rows = vectors.select(F.coalesce("vec_id", F.lit(NULL_ID)).alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(pack, "vec_id long, label long, digest binary" + ", vec binary" * with_vector)


def classes(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """class_id (numbered in the order of vec_id), digest, least (vec_id), size, label, vec."""
    rows = keyed(vectors, with_vector=True).where("digest IS NOT NULL")
    groups = rows.groupBy("digest").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("size"),
                                        F.first("label").alias("label"), F.first("vec").alias("vec"))
    # numbers are written, so that they stay
    groups = groups.repartitionByRange(width(spark), "least", "digest").sortWithinPartitions("least", "digest")
    return materialize(spark, groups.withColumn("class_id", F.monotonically_increasing_id()), "vector-classes")


def fitted(groups: DataFrame, lists: int | None = None) -> tuple[Codebook, int] | None:
    """Codebook of a bounded sample of the classes and the vectors' length in numbers
    (a multiple of SUBSPACES), or None without classes."""
    of = groups.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("vec")).alias("bytes")).first()
    if not of["n"]:
        return None
    columns = -(-(of["bytes"] // 8) // SUBSPACES) * SUBSPACES
    sample = groups.orderBy(F.xxhash64("digest"), "digest").limit(SAMPLE).select("vec").collect()
    lists = lists or min(MAX_LISTS, -(-of["n"] // LIST_ROWS))
    return Codebook.fit(unit([bytes(r["vec"]) for r in sample], columns), lists), columns


def placed(groups: DataFrame, codebook: Codebook, columns: int, margin: float) -> DataFrame:
    """PLACED per class: its list, the lists it visits, its codes."""
    shared = groups.sparkSession.sparkContext.broadcast(codebook)  # bounded by MAX_LISTS and CODES

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = shared.value
        for batch in batches:
            for part in (batch.slice(i, STEP) for i in range(0, batch.num_rows, STEP)):
                home, visits, codes, left = book.place(unit(part.column("vec").to_pylist(), columns), margin)
                cells, ends = np.nonzero(visits)[1], np.cumsum(visits.sum(1))
                yield pa.RecordBatch.from_arrays([
                    *(part.column(c) for c in ("class_id", "size", "label")), pa.array(home, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(cells, pa.int32())),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(left, pa.float64()), part.column("vec")],
                    ["class_id", "size", "label", "home", "visits", "codes", "left", "vec"])

    return groups.select("class_id", "size", "label", "vec").mapInArrow(place, PLACED)


def meetings(spark: SparkSession, index: DataFrame) -> DataFrame:
    """Members (role 0) and visitors (role 1) of every pair of blocks of a list."""
    visitors = index.withColumn("cell", F.explode("visits"))
    sizes = index.groupBy("label", F.col("home").alias("cell")).agg(F.count(F.lit(1)).alias("members")).join(
        visitors.select("label", "cell").groupBy("label", "cell").agg(F.count(F.lit(1)).alias("visitors")), ["label", "cell"])
    blocks = lambda c: F.ceil(F.col(c) / BLOCK_ROWS).cast("int")
    sizes = materialize(spark, sizes.select("label", "cell", blocks("members").alias("blocks"), blocks("visitors").alias("parts")),
                        "list-sizes")
    mine = lambda n: F.pmod(F.xxhash64("class_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = [*MEETING, "role", "class_id", "size", "home", "visits", "codes", "left", "vec"]
    members = index.withColumn("cell", F.col("home")).join(sizes, ["label", "cell"]).withColumn(
        "role", F.lit(0)).withColumn("block", mine("blocks")).withColumn("part", every("parts"))
    # a list without members of the label needs no visit
    visitors = visitors.join(sizes, ["label", "cell"]).withColumn("role", F.lit(1)).withColumn(
        "part", mine("parts")).withColumn("block", every("blocks"))
    none = lambda t: F.lit(None).cast(t)
    visitors = visitors.withColumn("visits", none("array<int>")).withColumn("codes", none("binary")).withColumn("left", none("double"))
    return members.select(columns).unionByName(visitors.select(columns))


class Members:
    """One block of a list: vectors, codes, links found so far and their connection."""

    def __init__(self, book: Codebook, columns: int, batch: pa.Table):
        self.cell = batch.column("cell")[0].as_py()
        self.ids = batch.column("class_id").to_numpy()
        self.sizes = batch.column("size").to_numpy()
        self.x = unit(batch.column("vec").to_pylist(), columns)
        self.codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(len(self.ids), -1)
        self.left = batch.column("left").to_numpy()
        self.visits = np.zeros((len(self.ids), len(book.centres)), bool)
        for row, cells in zip(self.visits, batch.column("visits")):
            row[cells.values.to_numpy()] = True
        self.links = np.zeros(len(self.ids), np.int64)
        self.root = self.ids.copy()

    def meet(self, book: Codebook, ids: np.ndarray, sizes: np.ndarray, home: np.ndarray, x: np.ndarray):
        """(class, links, other) rows of these visitors."""
        near = book.distances(x, self.cell, self.codes) <= REACH + self.left + 1e-6
        rows, cols = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
        linked = (x[rows] @ self.x[cols].T >= COSINE) & near[np.ix_(rows, cols)]
        a, b = np.nonzero(linked)
        a, b = rows[a], cols[b]
        # a pair of one list counts once; one of two lists in the first that both see
        ours = home[a] == self.cell
        once = np.where(ours, ids[a] < self.ids[b], ~self.visits[b, home[a]] | (self.cell < home[a]))
        a, b = a[once], b[once]
        self.links += np.bincount(b, sizes[a], len(self.ids)).astype(np.int64)
        links = np.bincount(a, self.sizes[b], len(ids)).astype(np.int64)
        # least class within reach, over the links of this meeting
        top, root = ids.copy(), self.root.copy()
        while len(a):
            least = np.minimum(top[a], root[b])
            if (least == top[a]).all() and (least == root[b]).all():
                break
            np.minimum.at(top, a, least)
            np.minimum.at(root, b, least)
        moved = np.unique(np.stack([self.root, root], 1)[root != self.root], axis=0)
        self.root = root
        some = links > 0
        return (np.r_[ids[some], moved[:, 0]], np.r_[links[some], np.zeros(len(moved), np.int64)], np.r_[top[some], moved[:, 1]])

    def done(self):
        some = self.links > 0
        return self.ids[some], self.links[some], self.root[some]


def found_links(met: DataFrame, codebook: Codebook, columns: int) -> DataFrame:
    """node, links, other: parts of a class's number of links, and connections."""
    shared = met.sparkSession.sparkContext.broadcast(codebook)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = shared.value
        now, gathered, members = None, [], None

        def out(rows) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], ["node", "links", "other"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in (*MEETING, "role")], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(keys)]):
                part, (*key, role) = batch.slice(lo, hi - lo), keys[lo].tolist()
                if key != now:
                    if members is not None:
                        yield out(members.done())
                    now, gathered, members = key, [], None
                if role == 0:
                    gathered.append(part)
                elif gathered or members is not None:
                    if members is None:
                        members, gathered = Members(book, columns, pa.Table.from_batches(gathered)), []
                    for some in (part.slice(i, STEP) for i in range(0, part.num_rows, STEP)):
                        yield out(members.meet(book, *(some.column(c).to_numpy() for c in ("class_id", "size", "home")),
                                               unit(some.column("vec").to_pylist(), columns)))
        if members is not None:
            yield out(members.done())

    order = [*MEETING, "role"]
    rows = met.repartition(*MEETING).sortWithinPartitions(*order)
    return rows.mapInArrow(compare, "node long, links long, other long")


def embedding_dedup(spark: SparkSession, vectors: DataFrame, margin: float = MARGIN, lists: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of ``vectors`` (vec_id, label, embedding)."""
    groups = classes(spark, vectors)
    whole = T.StructType([T.StructField(n, t) for n, t in (
        ("digest", T.BinaryType()), ("size", T.LongType()), ("n_links", T.LongType()), ("component_id", T.LongType()))])
    book = fitted(groups, lists)
    if book is None:
        verdicts = spark.createDataFrame([], whole)
    else:
        codebook, columns = book
        index = materialize(spark, placed(groups, codebook, columns, margin), "vector-index")
        links = materialize(spark, found_links(meetings(spark, index), codebook, columns), "vector-links")
        counts = links.groupBy(F.col("node").alias("class_id")).agg(F.sum("links").alias("links"))
        parts = components(spark, links.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")))
        first = parts.groupBy("component").agg(F.count(F.lit(1)).alias("nodes")).join(groups.select(
            F.col("class_id").alias("component"), F.col("least").alias("component_id")), "component")
        first = materialize(spark, first, "vector-components")
        parts = split_join(parts, first, "component", "nodes", parts.count()).select(
            F.col("node").alias("class_id"), "component_id")
        verdicts = groups.select("class_id", "digest", "size", "least").join(counts, "class_id", "left").join(
            parts, "class_id", "left").select("digest", "size", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                                              F.coalesce("component_id", "least").alias("component_id"))
        verdicts = materialize(spark, verdicts, "vector-verdicts")
    rows = materialize(spark, keyed(vectors, with_vector=False), "vector-rows")
    judged = split_join(rows.where("digest IS NOT NULL"), verdicts, "digest", "size", rows.count())
    alone = rows.where("digest IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    back = lambda c: F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)
    return judged.select("vec_id", "n_links", "component_id").unionByName(alone).select(
        back("vec_id"), "n_links", back("component_id"), (F.col("vec_id") == F.col("component_id")).alias("kept"))
