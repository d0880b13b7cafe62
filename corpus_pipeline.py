"""The corpus pipeline: five stages from raw documents to a training mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet
and read again as the next stage's documents. Every stage works on all that the one
before it kept:

1. ``toxicity``: documents that the positive-unlabelled classifier rejects go.
2. ``line_dedup``: repeated and near-equal lines go, but for the first; documents left
   without any line go.
3. ``near_dedup``: one document of each near-duplicate component (similarity 0.8) stays.
4. ``decontaminate``: documents that hold a benchmark item go.
5. ``mix``: every source is taken up to its target, documents whole, repeats as rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, linededup, mixing, neardup, toxicity
from tidemark.llm.common import materialise, table


#: Near copies share this many hundredths of their shingles or more; op1 alone is bound to 85.
NEAR = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.not_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.deduplicated(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs, NEAR)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
]

#: SQL cannot express the classifier, the edit join and the near-duplicate components.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``: the rows of the mix."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
