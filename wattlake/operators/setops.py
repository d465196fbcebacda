"""Sorting, limits, unions and splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_rows(df: DataFrame, cols: Sequence[str], ascending: bool | Sequence[bool] = True) -> DataFrame:
    return df.orderBy(*cols, ascending=ascending)


def top_n(df: DataFrame, n: int, order: Sequence, ) -> DataFrame:
    """First n rows of an explicit order (a distributed top-k: each task
    keeps n rows, the final merge sees n x tasks)."""
    return df.orderBy(*order).limit(n)


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def split_by(df: DataFrame, col: str, values: Sequence) -> dict:
    """One lazy filtered view per value, key column dropped.  Nothing is
    materialised: each view re-reads with a pushed-down filter."""
    return {v: df.where(F.col(col) == v).drop(col) for v in values}


def split_shapes(df: DataFrame, col: str) -> DataFrame:
    """Shape of every split part: (value, rows, cols) from one aggregate."""
    return df.groupBy(col).agg(F.count("*").alias("rows")).withColumn("cols", F.lit(len(df.columns) - 1))


def compare_counts(a: DataFrame, b: DataFrame, by: str, a_name: str = "n_input",
                   b_name: str = "n_output") -> DataFrame:
    """Row counts per part of two tables, side by side, with an equality flag."""
    ca = a.groupBy(by).agg(F.count("*").alias(a_name))
    cb = b.groupBy(by).agg(F.count("*").alias(b_name))
    return (ca.join(cb, by, "full")
            .na.fill(0, subset=[a_name, b_name])
            .withColumn("equal", F.col(a_name) == F.col(b_name)))
