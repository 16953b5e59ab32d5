"""A training corpus from raw documents: the stages, in order, and a run over the table of documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm import bpe, mixing, quality, simhash, toxicity
from tapeworks.llm.columns import prepared, stage, table
from tapeworks.llm.queries import WORD_BPE, quality_model, toxicity_model

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

GOOD_FROM = 0.3
TOXIC_FROM = 0.5


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    scored = quality.score(docs, quality_model(spark, sf_dir), name="__score")
    return scored.filter(F.col("__score") >= GOOD_FROM).select(*docs.columns)


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighted lexicon does not call toxic."""
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir), name="__score")
    return scored.filter(F.col("__score") < TOXIC_FROM).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.deduplicated(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs, mixing.mix(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's ids, as digests of them and of what they decode to."""
    return bpe.round_trip(docs.select("doc_id", "text"), WORD_BPE)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good),
    ("toxicity", harmless),
    ("near-duplicates", distinct),
    ("mix", mixed),
    ("tokens", tokens),
]

# Trained models, signatures and seeded choices are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents; each result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(prepared(spark), docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
