"""Corpus pipeline over ``documents``: toxicity, line dedup, near-dedup, mixing, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over one operator of
``imagelake.llm``; its result is written as Parquet and read again as the next
stage's documents. All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imagelake.llm import line_dedup, mixing, near_dedup, packing, registered, toxicity
from imagelake.llm.common import materialize, table, text_key
from imagelake.session import tune

#: The stages train a model, hash 64-bit shingles and tokenise: no SQL twin.
ORACLE_SQL = None
#: Runs that a worker of the last stage remembers; the heap that earlier stages filled leaves less room than in a job of its own.
CACHE_RUNS = 80_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity model rejects, row by row."""
    tune(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines found across sites."""
    tune(spark)
    return line_dedup.remove_boilerplate(spark, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (the smallest doc_id)."""
    tune(spark)
    out = near_dedup.verdicts(spark, docs).where(~F.col("kept"))
    out = materialize(spark, out.select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row")).distinct(), "near-duplicates")
    same = docs["doc_id"].eqNullSafe(out["_doc"]) & (text_key(docs["text"]) == out["_row"])
    return docs.join(out, same, "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to the target weights takes them."""
    tune(spark)
    return mixing.mix_documents(spark, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their training sequence and place in it."""
    tune(spark)
    return packing.pack_documents(spark, docs, registered.tokenizer_path(), cache_runs=CACHE_RUNS)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
