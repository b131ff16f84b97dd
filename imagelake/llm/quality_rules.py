"""Quality rules with thresholds that follow the data (JVM functions only).

Each document gets counts over its whole text. A few counts have fixed bounds (the
base rules). For the others every (language, source) gets its own bounds: the
rates of its documents go into a mergeable quantile sketch, the sketch gives the
fences, and the documents are joined with the fences of their group and filtered.

A fence lies ``FENCE`` spreads beyond its quartile. The spread of a side is the
distance of the quartiles or, if longer, that from the quartile to the outer decile
of that side, so a long tail of a group widens its own bounds. Nothing else sets the
width but the resolution of the sketch: a spread is one cell at least.

The sketch is a log-linear histogram: a rate is counted in the cell of its leading
``SKETCH_BITS`` binary digits, so a quantile is off by one part in 32 at most. Two
sketches merge by adding their counts, which is what the partial aggregation does
before the shuffle: a hot source sends a few hundred cells per task, not its rows.
The result does not depend on the order of merging. A group of fewer than
``min_group`` documents takes the merged sketch of its language, and a small
language that of all documents.

Defined cases: null and empty texts have no words and fail the base rules; null
language or source is a group like any other; repeated rows are judged one by one;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from imagelake.llm.common import SPACES, materialize, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SKETCH_BITS = 6
MIN_GROUP = 100
#: Spreads beyond a quartile that are still accepted.
FENCE = 4
#: Rates with fences. A document's first repeated line is no rate yet: in a text of few
#: lines it alone would be a large one.
RATES = ("symbol_rate", "upper_rate", "word_length", "dup_line_rate")
#: Quantiles that the fences need, in per cent.
QUANTILES = (10, 25, 75, 90)


def _covered(starts: Column) -> Column:
    """Words that windows of WINDOW words at these sorted starts cover."""
    steps = F.transform(starts, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - x, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0), lambda a, b: a + b).cast("long")


def count_features(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each whole text."""
    t = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("_t"))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")
    d = t.select(
        "doc_id", "lang", "source",
        words(F.col("_t")).alias("_words"), lines.alias("_lines"),
        F.length(F.translate("_t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("_t", "[^A-Z]+", "")).cast("long").alias("n_upper"))
    d = d.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols", "n_upper",
        F.size("_words").cast("long").alias("n_words"), F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"))
    # one 64-bit hash per window; texts without a repeated window need no more
    last = F.size("_h") - WINDOW
    d = d.select("*", F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
        *[F.get("_h", i + k) for k in range(WINDOW)]))).alias("_win")).drop("_h")
    d = d.select("*", F.when(
        F.size(F.array_distinct("_win")) < F.size("_win"),
        F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_s")).drop("_win")
    same = lambda x, k: (x["h"] == F.get("_s", k - 1)["h"]) | (x["h"] == F.get("_s", k + 1)["h"])
    d = d.select("*", F.sort_array(F.transform(F.filter("_s", lambda x, k: F.coalesce(same(x, k), F.lit(False))),
                                               lambda x: x["i"])).alias("_starts")).drop("_s")
    return d.select("*", F.when(F.col("_starts").isNull(), F.lit(0).cast("long")).otherwise(
        _covered(F.col("_starts"))).alias("n_repeat_words")).drop("_starts")


def with_rates(counts: DataFrame) -> DataFrame:
    """Add the base verdict and the integer rates that the sketches hold."""
    chars, n = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    div = lambda a, b: F.floor(a / b).cast("long")
    return counts.select(
        "*",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        div(F.col("n_symbols") * 1000, chars).alias("symbol_rate"),
        div(F.col("n_upper") * 1000, chars).alias("upper_rate"),
        div(F.col("word_chars") * 100, n).alias("word_length"),
        div(F.greatest(F.col("n_dup_lines") - 1, F.lit(0)) * 1000, F.greatest("n_lines", F.lit(1))).alias("dup_line_rate"))


def _dropped_bits(rate: Column) -> Column:
    return F.greatest(F.length(F.bin(rate)) - SKETCH_BITS, F.lit(0))


def sketch_cell(rate: Column) -> Column:
    """The leading SKETCH_BITS binary digits of ``rate``, the rest set to 0."""
    shift = _dropped_bits(rate)
    return F.call_function("shiftleft", F.call_function("shiftright", rate, shift), shift)


def cell_width(cell: Column) -> Column:
    """How many rates share the cell."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), _dropped_bits(cell))


def sketches(rated: DataFrame) -> DataFrame:
    """Mergeable sketches: lang, source, rate, cell, n (documents in the cell)."""
    cells = F.array(*[F.struct(F.lit(r).alias("rate"), sketch_cell(F.col(r)).alias("cell")) for r in RATES])
    return (rated.select("lang", "source", F.explode(cells).alias("c"))
            .groupBy("lang", "source", "c.rate", "c.cell").agg(F.count(F.lit(1)).alias("n")))


def fences(cells: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """lang, source and the two fences of each rate, from the sketches."""
    langs = cells.groupBy("lang", "rate", "cell").agg(F.sum("n").alias("n"))
    everything = langs.groupBy("rate", "cell").agg(F.sum("n").alias("n"))

    def quantiles(c: DataFrame, keys: list[str], name: str) -> DataFrame:
        w = Window.partitionBy(*keys, "rate")  # a few hundred cells of a sketch
        run = c.select(*keys, "rate", "cell", F.sum("n").over(w).alias("total"), F.sum("n").over(
            w.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)).alias("cum"))
        return run.groupBy(*keys, "rate").agg(F.struct(
            F.max("total").alias("n"),
            *[F.min(F.when(100 * F.col("cum") >= q * F.col("total"), F.col("cell"))).alias(f"q{q}") for q in QUANTILES]
        ).alias(name))

    own, lang, top = (quantiles(c, k, n) for c, k, n in (
        (cells, ["lang", "source"], "own"), (langs, ["lang"], "by_lang"), (everything, [], "top")))
    lang = lang.select(F.col("lang").alias("_lang"), F.col("rate").alias("_rate"), "by_lang")
    q = own.join(lang, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("rate") == F.col("_rate"))).drop("_lang", "_rate")
    q = q.join(F.broadcast(top), "rate")  # one row per rate
    pick = F.when(F.col("own.n") >= min_group, F.col("own")).when(
        F.col("by_lang.n") >= min_group, F.col("by_lang")).otherwise(F.col("top"))
    q = q.select("lang", "source", "rate", pick.alias("p")).select("lang", "source", "rate", "p.*")
    below = F.greatest(F.col("q75") - F.col("q25"), F.col("q25") - F.col("q10"), cell_width(F.col("q25")))
    above = F.greatest(F.col("q75") - F.col("q25"), F.col("q90") - F.col("q75"), cell_width(F.col("q75")))
    q = q.select("lang", "source", "rate", (F.col("q25") - FENCE * below).alias("lo"), (F.col("q75") + FENCE * above).alias("hi"))
    return q.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("rate") == r, F.col(b))).alias(f"{b}_{r}") for r in RATES for b in ("lo", "hi")])


def quality_rules(spark: SparkSession, docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Counts, base verdict, adaptive verdict (``adaptive_failed``) and ``kept`` per row."""
    rated = materialize(spark, with_rates(count_features(docs)), "quality-rates")
    # written, so that both sides of the join come from a shuffle that can be split
    bounds = materialize(spark, fences(materialize(spark, sketches(rated), "quality-sketches"), min_group),
                         "quality-fences").withColumnsRenamed({"lang": "_lang", "source": "_source"})
    d = rated.join(bounds, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")))
    outside = F.lit(False)
    for r in RATES:
        outside = outside | (F.col(r) < F.col(f"lo_{r}")) | (F.col(r) > F.col(f"hi_{r}"))
    return d.select(*rated.columns, outside.alias("adaptive_failed"),
                    (~F.col("base_failed") & ~outside).alias("kept"))
