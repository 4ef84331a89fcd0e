"""A corpus from raw documents to token ids, as five stages.

Each stage takes the documents its predecessor kept and returns what it keeps of them, with the
columns of ``documents``; the last returns token ids. ``run`` writes every stage to the shared
folder and reads it again, so a lost executor costs one stage's tasks at most.

* ``quality``: documents that the classifier takes for label 0 go.
* ``near_duplicates``: of each group of linked documents (80 % of their shingles in common) the one
  with the smallest doc_id stays.
* ``repeated_passages``: words of passages that recur are taken out, and ``n_chars`` follows; texts
  without such words stay as they are, and no document goes.
* ``decontamination``: documents with any window of a benchmark item go.
* ``tokens``: doc_id, number of ids, and the ids as little-endian unsigned 32-bit integers.

A null text is an empty one to the classifier, stays null until the last stage, and has no ids.
Documents without a doc_id pass as they are described in each operator. An empty table gives
empty results.

All stages run in the same executors and workers, which keep much of what they once took. So each
one bounds the batches that Spark sends to Python, for the rest of the session, unless the session
has a setting of its own.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayline.llm import bytepairs, contamination, nbsvm, oddsketch, passages
from stayline.llm.queries import RANKS
from stayline.llm.words import bound_batches
from stayline.session import configure, durable, stored_bytes

SIMILAR_PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _bounded(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


def _packed(docs: DataFrame) -> DataFrame:
    """Whole rows in one column, beside what operators need: no name of ``docs`` can clash."""
    return docs.select("doc_id", "text", F.struct("*").alias("row"))


@_bounded
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = nbsvm.quality_scores(_packed(docs), labels, ["doc_id", "row"], "row.text")
    return scored.where(F.col("predicted") == 1).select("row.*")


@_bounded
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = oddsketch.near_duplicates(_packed(docs), ["row"], SIMILAR_PERCENT)
    return found.where("kept").select("row.*")


@_bounded
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = passages.remove_repeats(_packed(docs), ["row"])
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        length = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(changed, length).otherwise(F.col("row.n_chars"))
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


@_bounded
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination.decontaminate(docs, items)


@_bounded
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return bytepairs.encode(docs, RANKS, ["doc_id"]).select("doc_id", n_tokens, "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: Models, sketches and byte pairs have no SQL; each stage is tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    configure(spark, input_bytes=stored_bytes(docs))
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
