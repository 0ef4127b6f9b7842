"""The corpus pipeline: quality rules, exact dedup, near dedup, substring dedup, packing.

Every stage takes (spark, docs, sf_dir) and all rows that the one before
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstar.llm.exact import exact_dedup
from jobstar.llm.minhash import near_duplicates
from jobstar.llm.packing import pack_documents
from jobstar.llm.quality import quality_rules
from jobstar.llm.suffix_array import cleaned
from jobstar.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules (operator 3)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules(docs, labels).where("kept").select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (operator 1)."""
    return exact_dedup(docs).where("kept").select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 (operator 7)."""
    dropped = near_duplicates(docs, k=5, percent=80).where("NOT kept").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of repeated 200-byte strings (operator 10); a text may become empty."""
    out = cleaned(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 ids (operator 5)."""
    import public_tokenizers
    return pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("exact", exact), ("near", near), ("substrings", substrings), ("packing", packing)]

#: the quality stage hashes n-grams with a function that DuckDB has not
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each over the stored result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
