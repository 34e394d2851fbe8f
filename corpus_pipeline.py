"""Corpus pipeline: quality rules, line dedup, near-dedup, substring dedup and
packing of ``documents``, each stage over all that its predecessor kept.

Every stage takes (spark, docs, sf_dir); all but the last return the columns
of ``documents`` with ``text`` cut and ``n_chars`` counted again. Between the
stages the rows are stored as Parquet in the shared folder, so a lost executor
costs one stage's work at most.

Null and empty texts fail the quality rules and go with the first stage. Rows
that share a doc_id are rows of one document: line dedup cuts each, near-dedup
keeps or drops them together, substring dedup cuts each by its own words. Rows
without doc_id are never repeats of others. An empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolap.llm.common import quoted, spool, table
from aerolap.llm.line_dedup import remove_lines
from aerolap.llm.near_dedup import keep_one
from aerolap.llm.packing import pack
from aerolap.llm.quality import judge, train
from aerolap.llm.queries import TOKENIZER
from aerolap.llm.substring_dedup import remove_repeats


def _as_documents(docs: DataFrame, cut: DataFrame) -> DataFrame:
    """The columns of ``docs`` from ``cut``, with the texts counted again."""
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast("bigint"))
    return cut.select(*quoted(docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; rules are fitted on the labelled documents here."""
    return judge(docs, train(docs, table(spark, sf_dir, "labels")), only_kept=True)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, except in the largest document that holds them."""
    return _as_documents(docs, remove_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays (five-word shingles,
    similarity 0.8)."""
    return keep_one(docs, width=5, similarity=(80, 100))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 50-word passages that an earlier document holds go."""
    return _as_documents(docs, remove_repeats(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequence and offset."""
    return pack(docs, TOKENIZER, capacity=1024, end=2)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("minhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", packing),
]

# packing and the forests are not SQL: tested against brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spool(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
