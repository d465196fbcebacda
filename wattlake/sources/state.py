"""Fitted state (encoder tables, scaler moments) as Parquet; models via
Spark ML's own ``save``/``load``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_state(tables: dict[str, DataFrame], path: str) -> str:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
    return path


def load_state(spark: SparkSession, path: str, names) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path.rstrip('/')}/{n}") for n in names}
