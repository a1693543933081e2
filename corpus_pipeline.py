"""A training corpus from `documents`: reject toxic texts, keep one of each group of near copies, take secrets out, mix domains, tokenise.

Each stage takes the documents that its predecessor kept and returns the columns of documents; the last returns tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetloom.llm.common import drop_table, materialise, read_table
from fleetloom.llm.jaccard_join import drop_near_copies
from fleetloom.llm.mixing import mix
from fleetloom.llm.secret_scan import redact_secrets
from fleetloom.llm.toxicity import drop_toxic
from fleetloom.llm.trie_bpe import trie_bpe


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingle similarity, that of the smallest id."""
    return drop_near_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind."""
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; those of a domain below its target weight several times."""
    return mix(docs, read_table(spark, sf_dir, "labels"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of each document, as counts and hashes."""
    import public_tokenizers

    return trie_bpe(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("secrets", secrets),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: A taught classifier and a fitted mix are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next reads it; what no stage reads any more is deleted."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), f"corpus-{name}")
        drop_table(before)
    return STAGES[-1][1](spark, docs, sf_dir)
