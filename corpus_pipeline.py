"""The corpus pipeline: each stage's result is written as Parquet and is the next one's documents.

Stages see all rows that their predecessor kept, and keep all columns of ``documents``, but for the last one, which
gives the pieces of the packed sequences. Nulls, empty texts, repeated rows and empty tables are handled as the
operators' docstrings say.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron.llm import language
from isochron.llm.common import shared_folder
from isochron.llm.decontamination import without_contaminated
from isochron.llm.jaccard import Scheme, one_of_each
from isochron.llm.packing import pack
from isochron.llm.suffix_dedup import PASSAGES, with_unique_texts
from isochron.session import ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
LEAST_SCORE = 0.25
"""Of being in any language, by a network that also knows what is in none; texts that are half junk pass."""


def with_code(stage: Stage) -> Stage:
    """The stage, with this repository's code on every worker before it runs."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@with_code
def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without a letter, or like no language, go."""
    return language.keep_identified(docs, language.fit(docs, junk=True), LEAST_SCORE)


@with_code
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by 0.8 or more of their five-word shingles."""
    return one_of_each(docs, Scheme(least=80, words=5))


@with_code
def unique_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words or more (or 400 bytes) that stand elsewhere, too; ``n_chars`` follows."""
    return with_unique_texts(docs, sampling=PASSAGES, least_words=50).withColumn("n_chars", F.length("text").cast("long"))


@with_code
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), least_words=1)


@with_code
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document that is left, in sequences of 2048."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identified),
    ("ngram_jaccard_join", without_near_copies),
    ("suffix_array_dedup", unique_texts),
    ("benchmark_decontamination", decontaminated),
    ("best_fit_packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
