"""Each operator applied to its whole table, as a named query."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stayline.llm import (
    bytepairs,
    centroids,
    contamination,
    divergence,
    gru,
    licences,
    nbsvm,
    oddsketch,
    passages,
    replies,
    suffixes,
    tokenfile,
    variants,
)
from stayline.session import configure, stored_bytes

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

LIBRARY_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; shuffles are sized by the largest one that a query reads."""
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name in ("documents", "conversations"):
        configure(spark, input_bytes=stored_bytes(found))
    return found


@query
def op1_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.quality_rules(table(spark, sf_dir, "documents"))


@query
def op2_nb_support_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return nbsvm.quality_scores(documents, labels, ["doc_id"])


@query
def op3_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oddsketch.near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"], percent=85)


@query
def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"),
    )


@query
def op5_gated_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return gru.toxicity_scores(documents, labels, ["doc_id"])


@query
def op6_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, sf_dir, "documents"), LIBRARY_TOKENIZER)


PROBE = "<|im_end|><|im_start|>assistant ok"


@query
def op7_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = [(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)]
    probe = spark.createDataFrame(rows, said.schema)
    return replies.round_trip(said.union(probe))


SQL["op7_reply_trees"] = replies.oracle()


@query
def op8_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytepairs.token_digests(table(spark, sf_dir, "documents"), RANKS)


@query
def op9_licence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_scan(table(spark, sf_dir, "documents"))


SQL["op9_licence_rules"] = licences.oracle()


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"]
    )
    return contamination.summary(found)


@query
def op11_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_seen(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept_bytes", 256).alias("kept_sha256"),
    )


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


@query
def op13_centroid_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"), ["vec_id"])


SQL["op13_centroid_threshold"] = centroids.oracle()
