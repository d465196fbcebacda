"""The registered queries opN_<name>: each applies its operator to the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import ann, decontam, kn_lm, langid, mixing, packing, phrases, quality, runs, setjoin, substrings, token_repair, wrappers

QueryFn = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_repair.tokenize_corpus(_table(spark, sf_dir, "documents"), tokenizer_file(), end=2)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _, _ = decontam.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"),
                                            span=13, share=20)
    return out.drop("ref")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _, _ = mixing.mix(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), most=3.0)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kn_lm.score_documents(_table(spark, sf_dir, "documents"), modulo=7, held=2)


def op5_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract_pages(_table(spark, sf_dir, "pages"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"), window=20)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = setjoin.near_duplicates(_table(spark, sf_dir, "documents"), k=5, num=75, den=100)
    return out.select("doc_id", "n_shingles", "component_id")


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), k=20, every=20)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"), modulo=4, held=2)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores, _, _ = quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scores.drop("ref")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_file(), end=1)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.collapse(_table(spark, sf_dir, "documents"), runs.planted))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"), least=10, share=50, top=2000)


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (
    op1_token_repair, op2_decontamination, op3_kneser_ney, op4_mixing, op5_wrapper_extraction,
    op6_substring_dedup, op7_jaccard_join, op8_nearest_neighbours, op9_language_id, op10_quality_classifier, op11_packing,
    op12_periodic_runs, op13_collocations,
)}

#: DuckDB SQL of the queries that SQL can state.
ORACLE_SQL: dict[str, str] = {"op4_mixing": mixing.ORACLE}
