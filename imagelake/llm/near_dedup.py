"""Near-duplicate documents: SetSketch registers, bands, joint likelihood, exact check.

A document is the set of its distinct shingles of ``shingle`` words (A-Z lower-cased;
fewer words are one shingle; no words, the empty set). Documents of equal sets form
a class, numbered in the order of its smallest row (doc_id, then key of the text);
only classes are compared.

* SetSketch. Register j of a set is K = floor(1 - log_b(x / SPREAD)), truncated to 16
  bits, with x the least of one exponential variate per shingle. Registers of a
  union are the larger of the parts' registers, so sketches merge; sets of Jaccard
  similarity J share a register with a chance of about J.
* Bands. BANDS bands of ROWS registers each; two classes that share a band are
  candidates. At J = 0.8 a pair shares none with a chance below 1e-9.
* Likelihood. Of a candidate pair, the registers that are larger, smaller and equal
  have probabilities that follow from J and the set sizes. Pairs whose most likely
  J is below ``MIN_ESTIMATE`` (five standard deviations under 0.8) go.
* Check. The others are compared on their full sets.

Buckets of a band are never expanded into rows of pairs. First each member meets the
smallest of its bucket; of those pairs components follow, and a bucket whose members are
all in one component is settled. In the others, members outside the bucket's most
common component meet all members in place: blocks of them, with their registers and
full sets, come together in a task, which tells apart or links the pairs of different
components and returns only links that connect. A pair is judged in the first band
that it shares, so nothing is judged twice and no list of judged pairs is kept. The rows
that move grow with the members, and a hot bucket is cut into pairs of blocks.

Defined cases: null, empty and blank texts have no shingle and link with nothing;
null doc_id counts as the largest id; rows that share a doc_id, or
have none, are told apart by their texts, and rows equal in both share a verdict;
an empty table gives an empty result; other columns, whatever their names, are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from imagelake.llm.common import materialize, release_shuffles, split_join, text_key, width
from imagelake.llm.components import components
from imagelake.llm.word_hashes import rolling, word_hashes, word_places

SHINGLE = 5
#: Link at 100 * intersection >= PERCENT * union.
PERCENT = 80
BANDS, ROWS = 40, 4
REGISTERS = BANDS * ROWS
BASE = 1.02
SPREAD = 64.0
MIN_ESTIMATE = 0.64
#: Members of a bucket per block, members that meet a block at once, and pairs judged at once.
BLOCK_ROWS, MEMBERS, PAIRS = 1_024, 256, 20_000
#: Shingles sketched at once: they stay in a core's cache.
BLOCK = 60_000
SKETCH = "doc_id long, row long, n_shingles long, digest binary, registers binary"
_RNG = np.random.default_rng(20240229)
_MULTIPLY = _RNG.integers(0, 2 ** 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2 ** 63, REGISTERS, dtype=np.uint64) * np.uint64(2)
_ODD = 0xD6E8FEB86659FD93
NULL_ID = 2 ** 63 - 1
#: A-Z to a-z, every other byte as it is (no byte of a longer UTF-8 sequence is in A-Z).
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_sets(texts: list[bytes | None], shingle: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    data = np.frombuffer(b"\n".join(t or b"" for t in texts).translate(_LOWER), np.uint8)
    starts, stops = word_places(data)
    h = word_hashes(data, starts, stops)
    windows = rolling(h, shingle, _ODD)
    ends = np.cumsum([len(t or b"") + 1 for t in texts])
    at = 0
    for n in np.diff(np.searchsorted(starts, ends), prepend=0).tolist():
        if n >= shingle:
            yield np.unique(windows[at:at + n - shingle + 1])
        else:
            yield rolling(h[at:at + n] ^ np.uint64(n), n, _ODD) if n else np.empty(0, np.uint64)
        at += n


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers (uint16) of each set; none may be empty."""
    out = np.empty((len(sets), REGISTERS), np.uint64)
    lo = 0
    while lo < len(sets):
        hi, n = lo, 0
        while hi < len(sets) and (hi == lo or n + len(sets[hi]) <= BLOCK):
            n += len(sets[hi])
            hi += 1
        x = np.concatenate(sets[lo:hi])
        starts = np.cumsum([0, *(len(s) for s in sets[lo:hi - 1])])
        y = np.empty_like(x)
        for j in range(REGISTERS):
            np.multiply(x, _MULTIPLY[j], out=y)
            np.add(y, _ADD[j], out=y)
            out[lo:hi, j] = np.maximum.reduceat(y, starts)
        lo = hi
    # the largest uniform variate u is the least exponential one, -ln u
    least = -np.log((out.astype(np.float64) + 0.5) / 2.0 ** 64)
    k = np.floor(1 - np.log(np.maximum(least, 1e-300) / SPREAD) / np.log(BASE))
    return np.clip(k, 0, 65535).astype(np.uint16)


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, row, n_shingles, digest of the set, registers (null for the empty set)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                sets = list(shingle_sets(part.column("text").cast(pa.binary()).to_pylist(), shingle))
                full = [s for s in sets if len(s)]
                rows = iter(registers(full) if full else ())
                regs = [next(rows).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("row"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array(regs, pa.binary())], ["doc_id", "row", "n_shingles", "digest", "registers"])

    return docs.select("doc_id", "row", "text").mapInArrow(sketch, SKETCH)


def bands(classes: DataFrame) -> DataFrame:
    """key, band, doc_id, n: one row per band of each class."""

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            r = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(-1, BANDS, ROWS)
            h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), r.shape[:2]).copy()
            for k in range(ROWS):
                h = (h ^ r[:, :, k]) * np.uint64(_ODD)
                h ^= h >> np.uint64(32)
            yield pa.RecordBatch.from_arrays([
                pa.array(h.ravel().view(np.int64)), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(h))),
                pa.array(np.repeat(batch.column("doc_id").to_numpy(), BANDS)),
                pa.array(np.repeat(batch.column("n_shingles").to_numpy(), BANDS))], ["key", "band", "doc_id", "n"])

    return classes.select("doc_id", "n_shingles", "registers").mapInArrow(band, "key long, band int, doc_id long, n long")


def estimates(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The Jaccard similarity under which two sketches (rows of ``ra`` and ``rb``, of sets
    of ``na`` and ``nb`` shingles) are most likely."""
    grid = np.linspace(0, 1, 101)
    equal_chance = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)
    na, nb = na.astype(float)[:, None], nb.astype(float)[:, None]
    more, less = ((ra > rb).sum(1)[:, None], (ra < rb).sum(1)[:, None])
    u, v = na / (na + nb), nb / (na + nb)
    possible = np.minimum(na, nb) / np.maximum(na, nb) + 1e-9  # J can't exceed it
    up, down = equal_chance(np.maximum(u - v * grid, 1e-12)), equal_chance(np.maximum(v - u * grid, 1e-12))
    chance = more * np.log(up) + less * np.log(down) + (REGISTERS - more - less) * np.log(np.maximum(1 - up - down, 1e-12))
    return grid[np.where(grid <= possible, chance, -np.inf).argmax(1)]


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two full sets (sorted hashes) reach the similarity."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def likeliest(pairs: DataFrame) -> DataFrame:
    """Add ``estimate`` to the pairs (a, b) with their sketches (ra, rb) and set sizes (na, nb)."""

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = []
            for part in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
                ra, rb = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                          for c in ("ra", "rb"))
                best.append(estimates(ra, rb, part.column("na").to_numpy(), part.column("nb").to_numpy()))
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in ("a", "b")), pa.array(np.concatenate(best) if best else [], pa.float64())],
                ["a", "b", "estimate"])

    return pairs.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(estimate, "a long, b long, estimate double")


def confirmed(pairs: DataFrame) -> DataFrame:
    """Components (a, b) of the pairs (components la, lb) whose full sets (sa, sb: sorted
    hashes) reach the similarity."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [similar(*(np.frombuffer(z.as_py(), np.uint64) for z in (x, y)))
                    for x, y in zip(batch.column("sa"), batch.column("sb"))]
            yield batch.select(["la", "lb"]).rename_columns(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("la", "lb", "sa", "sb").mapInArrow(check, "a long, b long")


def full_sets(docs: DataFrame, shingle: int) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                sets = shingle_sets(part.column("text").cast(pa.binary()).to_pylist(), shingle)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 ["doc_id", "hashes"])

    return docs.select("doc_id", "text").mapInArrow(make, "doc_id long, hashes binary")


class Block:
    """Members of a bucket, and the components that were found to be one when others met them."""

    def __init__(self, batch: pa.Table | pa.RecordBatch):
        self.root: dict[int, int] = {}
        self.band = batch.column("band")[0].as_py()
        self.ids, self.label, self.n = (batch.column(c).to_numpy() for c in ("doc_id", "label", "n"))
        self.registers = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        self.sets = [np.frombuffer(x, np.uint64) for x in batch.column("hashes").to_pylist()]

    def find(self, label: int) -> int:
        while (up := self.root.get(label, label)) != label:
            label = up
        return label

    def meet(self, other: Block, main: int, least: int) -> list[tuple[int, int]]:
        """Links (components a, b) that connect what was apart, between this block and other members."""
        n, m = self.n[:, None], other.n[None, :]
        open_ = (self.label[:, None] != other.label) & (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m))
        # of two members outside, the pair counts once; the least of a bucket has met all
        open_ &= (other.label == main) | (self.ids[:, None] < other.ids)
        open_ &= (self.ids[:, None] != least) & (other.ids != least)
        links = []
        a, b = np.nonzero(open_)
        for lo in range(0, len(a), PAIRS):
            x, y = a[lo:lo + PAIRS], b[lo:lo + PAIRS]
            ra, rb = self.registers[x], other.registers[y]
            same = (ra == rb).reshape(-1, BANDS, ROWS).all(2)
            first = same.argmax(1) == self.band  # all of them share this band
            x, y = x[first], y[first]
            guess = estimates(ra[first], rb[first], self.n[x], other.n[y])
            for k in np.argsort(-guess, kind="stable"):
                if guess[k] < MIN_ESTIMATE:
                    break
                p, q = self.find(int(self.label[x[k]])), self.find(int(other.label[y[k]]))
                if p != q and similar(self.sets[x[k]], other.sets[y[k]]):
                    links.append((p, q))
                    self.root[max(p, q)] = min(p, q)
        return links


def links_in_place(meetings: DataFrame) -> DataFrame:
    """a, b: links between components, of every pair of a bucket's blocks that meets."""
    key = ["key", "block", "part"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, gathered, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in (*key, "role")], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(keys)]):
                part, (*at, role) = batch.slice(lo, hi - lo), keys[lo].tolist()
                if at != now:
                    now, gathered, block = at, [], None
                if role == 0:
                    gathered.append(part)
                elif gathered or block is not None:
                    if block is None:
                        block, gathered = Block(pa.Table.from_batches(gathered)), []
                    links = [x for i in range(0, part.num_rows, MEMBERS) for x in block.meet(
                        Block(part.slice(i, MEMBERS)), part.column("main")[0].as_py(), part.column("least")[0].as_py())]
                    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

    rows = meetings.repartition(*key).sortWithinPartitions(*key, "role")
    return rows.mapInArrow(judge, "a long, b long")


class Linker:
    """Compares candidate pairs and keeps the components of what is confirmed."""

    def __init__(self, spark: SparkSession, texts: DataFrame, classes: DataFrame, members: DataFrame, shingle: int):
        self.spark, self.classes = spark, classes
        # full sets of the classes that share a bucket with another, one text each
        wanted = members.select("doc_id").distinct()
        texts = texts.join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        self.sets = materialize(spark, full_sets(texts, shingle), "full-sets")
        self.labels = spark.createDataFrame([], "node long, component long")

    def labelled(self, df: DataFrame, col: str, out: str) -> DataFrame:
        n = self.labels.select(F.col("node").alias(col), F.col("component").alias(out))
        return df.join(n, col, "left").withColumn(out, F.coalesce(out, col))

    def link(self, links: DataFrame) -> None:
        """Merge the components a and b of each row."""
        spark = self.spark
        merged = materialize(spark, components(spark, links), "merged")
        known = self.labels.unionByName(merged.select("node", F.col("node").alias("component"))).groupBy("node").agg(
            F.min("component").alias("was"))
        renamed = known.join(merged.select(F.col("node").alias("was"), F.col("component").alias("now")), "was", "left")
        self.labels = materialize(spark, renamed.select("node", F.coalesce("now", "was").alias("component")), "labels")

    def stars(self, pairs: DataFrame) -> None:
        """Link the pairs (a < b, distinct) that are similar. Each document's most likely partner
        is checked first, then the others that this has not linked."""
        side = lambda x: self.classes.select(F.col("doc_id").alias(x), F.col("n_shingles").alias("n" + x),
                                             F.col("registers").alias("r" + x))
        by_estimate = Window.partitionBy("b").orderBy(F.desc("estimate"), "a")
        judged = likeliest(pairs.join(side("a"), "a").join(side("b"), "b")).where(F.col("estimate") >= MIN_ESTIMATE)
        likely = materialize(self.spark, judged.select("a", "b", F.row_number().over(by_estimate).alias("nth")), "likely")
        for part in ("nth = 1", "nth > 1"):
            if not likely.where(part).isEmpty():
                self.check(likely.where(part))

    def check(self, pairs: DataFrame) -> None:
        """Link those of the pairs (a, b) of two components whose full sets are similar."""
        apart = self.labelled(self.labelled(pairs, "a", "la"), "b", "lb").where("la <> lb")
        sets = lambda x: self.sets.select(F.col("doc_id").alias(x), F.col("hashes").alias("s" + x))
        links = materialize(self.spark, confirmed(apart.join(sets("a"), "a").join(sets("b"), "b")), "links")
        if not links.isEmpty():
            self.link(links)

    def meetings(self, members: DataFrame) -> DataFrame:
        """Pairs of blocks of every bucket of several components: members outside the most common
        one (role 0) and all members (role 1), with registers and full sets."""
        # two members have met as a star
        now = materialize(self.spark, self.labelled(members.where("size > 2"), "doc_id", "label"), "labelled")
        count = now.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
        main = count.groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.sum("c").alias("all"),
                                        F.max("c").alias("most")).where(F.col("all") > F.col("most"))
        blocks = lambda c: F.ceil(c / BLOCK_ROWS).cast("int")
        main = materialize(self.spark, main.select("key", "main", "all", blocks(F.col("all") - F.col("most")).alias("blocks"),
                                                   blocks(F.col("all")).alias("parts")), "open-buckets")
        open_ = split_join(now, main, "key", "all", now.count())
        mine = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        columns = ["key", "block", "part", "role", "band", "least", "main", "doc_id", "n", "label"]
        outside = open_.where("label <> main").withColumn("role", F.lit(0)).withColumn("block", mine("blocks")).withColumn(
            "part", every("parts"))
        everyone = open_.withColumn("role", F.lit(1)).withColumn("part", mine("parts")).withColumn("block", every("blocks"))
        rows = outside.select(columns).unionByName(everyone.select(columns))
        return rows.join(self.classes.select("doc_id", "registers"), "doc_id").join(self.sets, "doc_id")


def link_classes(spark: SparkSession, texts: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """(node, component) of the classes that are linked with another. ``texts`` and
    ``classes`` have the number of a class as doc_id."""
    rows = bands(classes)
    groups = rows.groupBy("key").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size")).where("size > 1")
    groups = materialize(spark, groups, "buckets")
    members = materialize(spark, rows.join(groups, "key"), "members")
    linker = Linker(spark, texts, classes, members, shingle)
    fits = 100 * F.least("n", "n_least") >= PERCENT * F.greatest("n", "n_least")
    sizes = classes.select(F.col("doc_id").alias("least"), F.col("n_shingles").alias("n_least"))
    stars = members.where("doc_id <> least").select("least", "doc_id", "n").distinct().join(sizes, "least").where(fits)
    linker.stars(stars.select(F.col("least").alias("a"), F.col("doc_id").alias("b")))
    links = materialize(spark, links_in_place(linker.meetings(members)), "links-in-place")
    if not links.isEmpty():
        linker.link(links)
    return linker.labels


def verdicts(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, row (key of the text), n_shingles, component_id (smallest doc_id reachable),
    kept per row."""
    release_shuffles(spark)
    docs = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), text_key(F.col("text")).alias("row"), "text")
    drawn = materialize(spark, sketches(docs, shingle), "sketches")
    full = drawn.where("digest IS NOT NULL")
    groups = materialize(spark, full.groupBy("digest").agg(
        F.min(F.struct("doc_id", "row")).alias("least"), F.count(F.lit(1)).alias("size")).select(
        "digest", "size", "least.doc_id", "least.row"), "class-rows")
    # numbers in the order of the rows, written, so that they stay
    groups = materialize(spark, groups.repartitionByRange(width(spark), "doc_id", "row").sortWithinPartitions(
        "doc_id", "row").withColumn("class_id", F.monotonically_increasing_id()), "classes")
    number = F.col("class_id").alias("doc_id")
    classes = materialize(spark, full.join(groups.drop("size"), ["digest", "doc_id", "row"]).dropDuplicates(
        ["class_id"]).select(number, "n_shingles", "registers"), "class-sketches")
    texts = docs.join(groups.select("doc_id", "row", "class_id"), ["doc_id", "row"]).select(number, "text")
    labels = link_classes(spark, texts, classes, shingle)
    first = labels.groupBy("component").agg(F.count(F.lit(1)).alias("nodes")).join(groups.select(
        F.col("class_id").alias("component"), F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row")), "component")
    first = materialize(spark, first, "component-rows")
    linked = split_join(labels.select(F.col("node").alias("class_id"), "component"), first, "component", "nodes", labels.count())
    whole = groups.join(linked.select("class_id", "keep_id", "keep_row"), "class_id", "left").select(
        "digest", "size", F.coalesce("keep_id", "doc_id").alias("component_id"), F.coalesce("keep_row", "row").alias("keep_row"))
    whole = materialize(spark, whole, "class-components")
    mine = ["doc_id", "row", "n_shingles"]
    out = split_join(full.select(*mine, "digest"), whole, "digest", "size", full.count()).select(
        *mine, "component_id", "keep_row").unionByName(drawn.where("digest IS NULL").select(
            *mine, F.col("doc_id").alias("component_id"), F.col("row").alias("keep_row")))
    back = lambda c: F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)
    return out.select(back("doc_id"), "row", "n_shingles", back("component_id"), (
        (F.col("doc_id") == F.col("component_id")) & (F.col("row") == F.col("keep_row"))).alias("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable), kept per row."""
    return verdicts(spark, docs, shingle).drop("row")
