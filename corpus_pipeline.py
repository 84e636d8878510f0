"""A training corpus from ``documents``: quality rules, near-duplicates, personal data, source mix, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the
columns of documents.  ``run`` writes each stage's result to the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import materialise, read_table
from riskloom.llm.mixing import mixed_documents
from riskloom.llm.near_dup import without_near_duplicates
from riskloom.llm.packing import packed_digest
from riskloom.llm.pii import fit_spans, redact
from riskloom.llm.quality import kept_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that lose too much, or fail the base checks, go."""
    return kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return without_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind."""
    return redact(docs, fit_spans(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources meet their budgets; rows repeat by epochs."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens.

    Fewer words are remembered than in a run of its own: executors still hold what the stages before have left.
    """
    return packed_digest(docs, cached_words=150_000)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("personal_data", personal_data), ("source_mix", source_mix), ("packing", packing)]

#: No SQL: stages 2 and 5 tokenize, hash and run a dynamic programme; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
