"""The training-data pipeline: quality, toxicity, near-duplicates, decontamination, tokens.

Each stage takes what the one before it kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import bpe, decontaminate, neardup, quality, toxicity
from factloom.llm.common import fold, free_name, shared_folder, table
from factloom.llm.queries import token_digests, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.5."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~fold(3, 1))
    new, marked = free_name(docs, "score"), free_name(docs, "predicted")
    return quality.score(docs, model, 0.5, new, marked).filter(F.col(marked) == 1).select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.3."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~fold(4, 2))
    new, marked = free_name(docs, "score"), free_name(docs, "predicted")
    return toxicity.score(docs, model, 0.3, new, marked).filter(F.col(marked) == 0).select(*docs.columns)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near-duplicates."""
    return neardup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts of what is left."""
    path = tokenizer_path("word_bpe_49k.json")
    return token_digests(bpe.encode(docs.select("doc_id", "text"), path, decoded=True).drop("text"))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("neardup", neardup_stage),
    ("decontamination", decontamination_stage),
    ("bpe", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between them is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    base = shared_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
    return docs


#: The models of the stages can't be put in SQL.
ORACLE_SQL = None
