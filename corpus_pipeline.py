"""A corpus pipeline of five stages over the documents table: quality rules, line dedup, near-duplicate documents, secrets, packing.

Each stage gets all rows its predecessor kept. What each decides: documents with too few words, too much repetition or outlying
statistics go; repeated and nearly repeated lines go after their first place, and documents nothing is left of; of each class
of near-duplicate documents the one with the least doc_id stays; secrets are masked; all that is left is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.llm import line_dedup, ngram_join, queries, robust_quality, secret_scan
from weftline.llm.common import drop_written, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return robust_quality.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.representatives(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.masked(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.pack_documents(docs)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("ngram_jaccard", near_duplicates), ("secret_scan", secrets), ("packing", packing)]

#: The packed ids come from a tokenizer, which SQL does not have; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read by the next; a stage's table is deleted once the next one's is there.

    Defined results: rows with a null doc_id or text go through all stages (a null text has no words, so quality rules reject it);
    equal rows are near copies of each other, of which the ones with the least doc_id stay; an empty table gives no pieces; columns
    that documents doesn't have usually are kept up to the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        made: list[str] = []
        docs = written(stage(spark, docs, sf_dir), name, made)
        drop_written(spark, before)
        before = made
    return STAGES[-1][1](spark, docs, sf_dir)
