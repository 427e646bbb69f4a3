"""Corpus pipeline: five stages over ``documents``, each a dealt operator.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame``; a runner
writes its result as Parquet and hands the reread table to the next stage.
All but the last return the columns of ``docs``, whatever these are.

* ``quality_rules``: documents that the base rules or the adaptive fences
  reject go.
* ``near_duplicates``: of each group of documents linked by five-word n-grams
  at a similarity of 0.75 the row with the smallest ``doc_id`` stays (one row,
  also where rows are repeated); rows that only share an id, or have none, are
  not linked by that, and documents without a word link with nothing.
* ``repeated_strings``: bytes covered by strings of ``REPEAT_BYTES`` that occur
  more than once are cut out of the texts; ``n_chars`` follows.
* ``decontaminate``: documents whose text covers at least half of a benchmark
  item go.
* ``pack``: what is left is tokenised and packed into sequences of at most
  2048 tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalink.llm.decontaminate import drop_contaminated
from catalink.llm.ngram_join import keep_one_per_component
from catalink.llm.packing import pack_documents
from catalink.llm.quality import filter_documents
from catalink.llm.staging import stage_area
from catalink.llm.suffix_dedup import dedup_documents

# What fifty words hold at least, bar rare texts of very short words: a passage of over
# fifty words that occurs again contains a repeated string of this length.
REPEAT_BYTES = 250

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the rules reject go."""
    return filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each component stays."""
    return keep_one_per_component(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: repeated strings are cut out of the texts."""
    return dedup_documents(docs, REPEAT_BYTES)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that hold a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: the pieces of the remaining documents and their places in the sequences."""
    return pack_documents(docs).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

# Quantile sketches, the tokenizer and the packing are beyond SQL; tests/llm hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and reread before the next."""
    area = stage_area(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = area.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
