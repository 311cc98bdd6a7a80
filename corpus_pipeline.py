"""From raw documents to packed training sequences, one operator a stage.

Each stage is written as Parquet to the shared folder and read again as the next one's input, so a
lost executor repeats part of one stage only, and every stage is judged on what came before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundweave.llm import exact, language, packing, quality, simhash
from fundweave.llm.common import fold, table, words
from fundweave.sources.workspace import cut


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose n-grams look like the trusted ones."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told clearly; a third of the ids is never learnt from."""
    return language.known_documents(docs, docs.filter(fold(F.col("doc_id"), 3) != 1))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.distinct_documents(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints 2 bits or fewer apart."""
    return simhash.one_per_class(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' words packed into sequences of the permitted lengths."""
    return packing.packed(docs, F.size(words(F.col("text"))))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: 64-bit hashes, compression and best fit have no SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
