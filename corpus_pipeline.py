"""The training-data pipeline over ``documents``: each stage is one operator of ``punctata.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from punctata.llm import bpe, mixing, quality, simhash, suffixes
from punctata.llm.common import stored
from punctata.llm.queries import vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of at most 20,000 documents.

    Null texts are judged as empty ones, very long ones whole; equal texts fare alike, repeated rows and null
    doc_ids included; other columns are carried along; an empty table gives none.
    """
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model, threshold=0.3)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the least doc_id: five-word shingles, similarity 0.8 or more.

    Null, empty and wordless texts are copies of one another. Rows with a null doc_id stay, and of rows that
    repeat the least doc_id all. Very long texts are compared whole; other columns are carried along; an empty
    table gives none.
    """
    return simhash.keep_first(docs, width=5, bits=2, similarity=0.8)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in more than one place are cut from the texts; every row stays, and n_chars is renewed.

    Repeated rows lose what they share; null and empty texts and null doc_ids stay; very long texts are cut as
    others; other columns are carried along; an empty table gives none.
    """
    return suffixes.remove_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them: up to three times, or not at all.

    Null texts have size 0 and null sources are one source; rows of one doc_id and text, a null doc_id
    included, share what the mix takes of them; very long texts are taken whole or not at all; other columns
    are carried along; an empty table gives none.
    """
    return mixing.repeat_rows(docs, (5, 2, 1), epochs=3)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, one row for each row of the mix.

    Null texts are empty, null doc_ids stay, very long texts are encoded whole, other columns go; an empty
    table gives no rows.
    """
    return bpe.encode_decode(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("repeats", repeats_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: The classifier's trees, SimHash and BPE have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as Parquet and read as the next one's docs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
