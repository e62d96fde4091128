"""A corpus pipeline: each stage reads what its predecessor wrote.

``STAGES`` lists (name, function) with functions of (spark, docs, sf_dir).
All stages but the last return the columns of ``documents``; the last adds
``copies``, how often the mix takes a document.  Each stage calls one operator
of ``churnlane.llm`` over all rows and whole texts it is given.  The stages hold
no state: their frames may be composed without writing, and runs at the same
time don't touch each other's files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlane.llm.common import discard, read, recorded, stage
from churnlane.llm.decontaminate import drop_contaminated
from churnlane.llm.exact_dedup import drop_exact_copies
from churnlane.llm.language import drop_unidentified
from churnlane.llm.mixing import mixed_rows
from churnlane.llm.simhash import drop_near_copies


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told."""
    return drop_unidentified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the largest doc_id of each group of equal texts."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest doc_id of each SimHash component."""
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the benchmark contaminates."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents to the target weights of the production mix."""
    return mixed_rows(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

#: Language ID and SimHash (xxHash64) have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of what the stages keep of ``documents``.

    Each stage's output is written before the next one reads it; then what that
    stage had staged, and its input, are removed.
    """
    docs, before = read(spark, sf_dir, "documents"), []
    for name, stage_of in STAGES[:-1]:
        with recorded() as used:
            kept = stage_of(spark, docs, sf_dir)
        with recorded() as written:
            docs = stage(kept, f"pipeline-{name}")
        discard(spark, [*before, *used])
        before = written
    return STAGES[-1][1](spark, docs, sf_dir)
