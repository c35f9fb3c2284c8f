"""A corpus pipeline of five stages over ``documents``: from raw texts to packed windows.

All stages take nulls in any column, empty and very long texts, repeated rows, rows that share an id, empty tables and
columns of any name. Rows without an id are never dropped; rows that share an id go or stay together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibweave.llm.decontaminate import drop_contaminated
from bibweave.llm.lines import drop_boilerplate
from bibweave.llm.minhash import near_duplicates
from bibweave.llm.packing import pack_documents
from bibweave.llm.quality import score_quality
from bibweave.llm.queries import ACCEPT, tokenizer_path
from bibweave.llm.rows import without
from bibweave.plans.scratch import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below the acceptance go; a null text is scored as an empty one, a score at the acceptance stays."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return without(docs, score_quality(docs, labels).where(F.col("score") < ACCEPT).select("doc_id"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; every document stays, with its new length (null for a null text). Documents without a source are one source."""
    # the caller's columns are held apart, so none is taken for one of the operator
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "source", "text")
    left = drop_boilerplate(held)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return left.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates (five-word shingles, 0.8) the smallest id stays, with all its rows; texts without words are alike to none."""
    return without(docs, near_duplicates(docs, words=5, threshold=0.8).where("not kept").select("doc_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold passages of a benchmark item go; null and empty texts hold none."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 tokens; a null or empty text is its end id alone."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicate", near_duplicate),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The stages train a model, hash and tokenise, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; what one keeps is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
