"""Training-data pipeline over ``documents``.

Quality classifier, near duplicates, benchmark decontamination, mixing to
target weights and token-id output.  Every stage works on all rows that the one
before kept; its result is written as Parquet to the shared folder and read
again as the next stage's documents.  All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import decontam, exchange, mixing, quality, setjoin, store, token_repair
from wattlake.llm.queries import tokenizer_file


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    scores, scan, folder = quality.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return exchange.with_rows(scan, folder, scores.where("keep").select("ref"))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of smallest doc_id."""
    return setjoin.keep_one(docs, k=5, num=75, den=100)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    found, scan, folder = decontam.find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), span=13, share=20)
    return exchange.with_rows(scan, folder, found.where(~F.col("contaminated")).select("ref"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target takes it."""
    return mixing.mixed(docs, weights=(5, 2, 1), most=3.0)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of the mix, digested from the files."""
    return token_repair.tokenize_corpus(docs, tokenizer_file(), end=2)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("token-ID / binary output", token_stage),
]

#: SQL cannot train the classifier or run the tokenizer; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    folder = store.new_store(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = store.saved(stage(spark, docs, sf_dir), folder, f"stage{i}")
    return docs
