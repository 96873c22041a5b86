"""Documents from raw text to packed sequences, in stages that each stand on the stored result of the last."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.near_dedup import drop_near_duplicates
from recordloom.llm.packing import pack_documents
from recordloom.llm.queries import TOKENIZER, mix_documents
from recordloom.llm.substring_dedup import remove_repeats
from recordloom.llm.toxicity import drop_toxic, fit_toxicity
from recordloom.llm.work import work_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that an ordinal model, fitted on the labels, does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return drop_toxic(docs, fit_toxicity(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, similarity 0.8."""
    return drop_near_duplicates(docs, width=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages of 40 words or more; ``n_chars`` is counted anew."""
    cut = remove_repeats(docs, unit="passage", min_words=40, removed_col="_removed")
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of all words, mixed to target weights, no document twice."""
    return mix_documents(docs, budget_share=0.9, max_epochs=1).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in windows of 2048."""
    return pack_documents(docs, TOKENIZER, window=2048)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# Models, components and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = work_table(stage(spark, docs, sf_dir))
    return docs
