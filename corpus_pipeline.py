"""The training-data pipeline: each stage works on all that the one before it kept.

A stage is a function of (spark, docs, sf_dir) that returns a DataFrame; it is written as Parquet
and read again for the next stage. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import bpe, decontamination, near_dedup, quality_rules, substring_dedup
from larder.llm.common import read, stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the current policy keeps."""
    return quality_rules.kept_rows(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every near-duplicate class the document that names it."""
    return near_dedup.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; words in repeated windows leave the text, and ``n_chars`` follows."""
    found = substring_dedup.deduplicated(docs)
    new = {"text": F.col("kept_text"),
           "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long"))
           .otherwise(F.col("row.n_chars"))} if "n_chars" in docs.columns else {
        "text": F.col("kept_text")}
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain no benchmark item."""
    return decontamination.clean_rows(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of the text, and the text read back from them."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encoded(docs, path, read_back=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "text")


STAGES = [
    ("quality_rules", good_documents),
    ("near_dedup", one_of_each),
    ("substring_dedup", without_repeats),
    ("decontamination", uncontaminated),
    ("bpe", tokens),
]

#: SQL cannot express the stages from near_dedup on; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
