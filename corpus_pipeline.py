"""The corpus pipeline: documents to packed training sequences.

Each stage is a function of (spark, docs, sf_dir) whose result is written as
Parquet and read again as the next stage's documents. All stages but the last
return the columns of ``documents``. As a stage's result has been written when
the next one is called, the next one first deletes the tables that it staged
(not if its input reads them still or is older: then they are left).

1. toxicity: documents that the classifier rejects go.
2. exact_dedup: of equal texts (A-Z lower-cased) the one with the smallest id stays.
3. near_dedup: one document of each class of near copies stays.
4. substring_dedup: words under repeated 20-word windows go; a document keeps
   its row even if no word is left, so no clean document is lost.
5. packing: the texts' ids in sequences of 1024 tokens.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import exact_dedup, near_dedup, packing, staged, substring_dedup, toxicity
from rivulet.session import apply_runtime_conf, materialize
from rivulet.sources.tables import read_table

# The classifier and the tokenizer cannot be written in SQL; tests compare the
# stages with brute force.
ORACLE_SQL = None

_left = threading.local()  # what each stage that this thread called has staged


def _after(before: str | None):
    """A stage that follows the stage function ``before``."""
    def deco(fn: Callable) -> Callable:
        @wraps(fn)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            paths = _left.__dict__.pop(before, [])
            if paths:
                staged.drop(spark, staged.written_after(docs, paths))
            with staged.noted() as paths:
                out = fn(spark, docs, sf_dir)
            _left.__dict__[fn.__name__] = paths
            return out
        return run_stage
    return deco


@_after(None)
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.3."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


@_after("drop_toxic")
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs, keep="smallest")


@_after("drop_copies")
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dedup.drop_near_duplicates(docs)


@_after("drop_near_copies")
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that also stand earlier."""
    return substring_dedup.drop_repeats(docs)


@_after("drop_repeated_passages")
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences: doc_id, start, length, doc_tokens, sequence_id,
    offset and the ids (array<int>)."""
    pieces = packing.pack(docs)
    return pieces.withColumn("ids", packing.ids_array(F.col("ids")))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's result."""
    apply_runtime_conf(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
