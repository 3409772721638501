"""A training corpus from raw documents: four filters, then token ids.

Toxic documents, later copies, near copies and documents that hold benchmark
items go; what is left is tokenised. The plan is one table per stage, each
written where all executors read it.

Every filter returns the rows it keeps with all their columns as they were, whatever these are
called. Null texts count as empty: they are never toxic, copies of each other, in no near copy and hold
no item. Rows without an id cannot be told apart and are kept, but by toxicity, which judges every
row by its text. Whole texts go to Python workers in small batches, a setting of the session. Rows that are repeated with their id count as one document: all of them stay or all
go, and the exact copies of a text under other ids go. An empty table gives an empty one in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.llm import bpe, decontaminate, exact_dedup, near_dedup, toxicity
from renown.llm.frames import Stage, bound_batches, ship, table
from renown.llm.queries import vocabulary_path

#: Words whose ids a worker keeps: less than by default, as workers of all stages share an executor.
REMEMBERED = 150_000


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first_copies(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every document that is left."""
    bound_batches(spark)
    coded = bpe.encode(docs, vocabulary_path(), remembered=REMEMBERED)
    return coded.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", first_copies),
    ("near_dedup", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("bpe", token_ids),
]

#: Learned scores and sketches have no SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ship(spark)
    docs, store = table(spark, sf_dir, "documents"), Stage(spark)
    for _, stage in STAGES[:-1]:
        docs = store.keep(stage(spark, docs, sf_dir))
        store.clear(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
