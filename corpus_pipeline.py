"""From raw documents to packed token sequences, in five stages.

Each stage reads what the one before it wrote. The first four return documents with
their columns; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmatch.llm import decontaminate, line_dedup, near_dup, packing, quality
from tagmatch.llm.queries import table, tokenizer_path
from tagmatch.sources.shared import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Words of a shingle in the near-dup stage; the query op4_near_dup has four.
NEAR_DUP_WORDS = 5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.quality_rules(docs).filter("kept").select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated lines; those that were nothing but
    copies go."""
    left = line_dedup.line_dedup(docs).filter("n_removed < n_lines OR n_lines = 0")
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by shingles of five words."""
    return near_dup.near_duplicates(docs, words=NEAR_DUP_WORDS).filter("kept").select(*docs.columns)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.filter("NOT contaminated").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full token sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dup", near_dup_stage),
    ("decontaminate", decontaminate_stage),
    ("packing", packing_stage),
]

#: SQL cannot tokenize, nor sum a corpus's histograms into distances.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
