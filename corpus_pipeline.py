"""The cleaning of a corpus, stage by stage. Each stage reads what the one before it has written."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import jaccard_join, line_dedup, packing, pu_classifier, suffix_dedup
from tidelog.llm.common import durable_table


def _counted(docs: DataFrame) -> DataFrame:
    """`n_chars` of the text as it is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the classifier scores below one half go. It learns from the labels of two thirds of the ids."""
    rows = durable_table(pu_classifier.with_features(docs), "pu-features")
    weights = pu_classifier.learn(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return pu_classifier.accepted(docs, weights)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier go; of 32 characters or more, also those that do but for one edit. Texts that lose all
    lines stay, empty."""
    return _counted(line_dedup.remove_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose sets of five-word shingles are linked by a similarity of 0.8, the one of the smallest id stays."""
    return jaccard_join.keep_one(docs, rule=jaccard_join.Similar(words=5, percent=80))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that start in a text of smaller id go, in whole characters."""
    return _counted(suffix_dedup.remove_repeats(docs, length=50))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two length up to 2048, one document each. Returns pieces, not documents."""
    return packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, longest=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", passages),
    ("packing", pack),
]

#: SQL has neither the classifier nor the tokenizer; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = durable_table(docs, f"stage{k}")
    return docs
