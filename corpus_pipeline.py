"""A training corpus from ``documents``, stage by stage.

Every stage but the last returns the columns of ``documents`` (and any more
that came in) for the rows it keeps; ``packed`` says where the tokens of the
remaining documents go. What a stage does with nulls, empty texts, ties,
repeated rows, empty tables and clashing columns is its operator's rule: texts
without words are rejected by the first stage, rows without an id are judged
by their text and never grouped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tunelake.llm import packing, quality, simhash, toxicity
from tunelake.llm.common import store, table
from tunelake.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not anomalous."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group of near copies."""
    return simhash.one_per_group(docs, shingle=4, max_bits=4)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 1024 tokens."""
    return packing.pack_documents(docs, tokenizer_path(), size=1024, end_id=0)


STAGES = [("quality", quality_rules), ("toxicity", not_toxic), ("near_dedup", near_unique), ("packing", packed)]

# Model fits, fingerprints and tokens have no SQL form; a test repeats the run by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet
    in the shared folder and read again by the next."""
    rows = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        rows = stage(spark, rows, sf_dir)
        if k < len(STAGES) - 1:
            rows = store(rows, name)
    return rows
