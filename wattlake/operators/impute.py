"""Imputation by group statistics.

Group medians come from a table of counts, (group, value, rows): a running count over
the distinct values of a group finds the middle rows.  The fact rows never sit in one
window partition, and no aggregate buffers a group's values; ties are one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.session import ensure_checkpoint_dir


def with_median(counts: DataFrame, col: str, by: Sequence[str], out: str, weight: str = "__n") -> DataFrame:
    """A table of counts with the group median of ``col`` (mean of the two middle values) in ``out``; NULLs count
    nothing, a group without values has no median."""
    n = F.when(F.col(col).isNotNull(), F.col(weight)).otherwise(0)
    group = Window.partitionBy(*by)
    # equal values are peers of the ordering, so they are counted together
    at = counts.withColumns({"__upto": F.sum(n).over(group.orderBy(F.col(col).asc_nulls_last())), "__total": F.sum(n).over(group)})
    middle = [F.min(F.when(F.col("__upto") > r, F.col(col))).over(group)
              for r in (F.floor((F.col("__total") - 1) / 2), F.ceil((F.col("__total") - 1) / 2))]
    return at.withColumn(out, (middle[0].cast("double") + middle[1]) / 2).drop("__upto", "__total")


def group_median(df: DataFrame, col: str, by: str | Sequence[str], method: str = "exact") -> DataFrame:
    """(group, ``__med_{col}``).  ``approx``: the sketch of ``percentile_approx``."""
    by = [by] if isinstance(by, str) else list(by)
    if method == "approx":
        return df.groupBy(*by).agg(F.percentile_approx(F.col(col), F.lit(0.5), 1_000_000).cast("double").alias(f"__med_{col}"))
    counts = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("__n"))
    return with_median(counts, col, by, f"__med_{col}").groupBy(*by).agg(F.first(f"__med_{col}").alias(f"__med_{col}"))


def impute_group_median(df: DataFrame, col: str, by: str | Sequence[str], method: str = "exact") -> DataFrame:
    """Fill NULLs of ``col`` with the median of its group (groups with no
    value stay NULL)."""
    by = [by] if isinstance(by, str) else list(by)
    med = group_median(df, col, by, method)
    return (df.join(med, by, "left")
            .withColumn(col, F.coalesce(F.col(col), F.col(f"__med_{col}")))
            .drop(f"__med_{col}").select(*df.columns))


def impute_year_built(df: DataFrame, col: str = "year_built", site_col: str = "site_id",
                      use_col: str = "primary_use") -> DataFrame:
    """Site median, then primary-use median, then site median again (each
    step sees the earlier fills), then truncate to int.

    All three steps run on one table of counts by (site, use, year), which is written once; the rows are read for the
    counts and once more for the result."""
    ensure_checkpoint_dir(df.sparkSession)
    key = [site_col, use_col, col]
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).withColumn("__year", F.col(col).cast("double"))
    for by in (site_col, use_col, site_col):
        filled = with_median(counts, "__year", [by], "__med")
        # a group that is NULL takes no median, as a join on it would not match
        counts = filled.withColumn("__year", F.coalesce("__year", F.when(F.col(by).isNotNull(), F.col("__med")))).drop("__med")
    years = counts.select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(key)], F.col("__year").cast("int").alias("__to")).checkpoint(eager=True)
    cond = None
    for i, k in enumerate(key):
        c = F.col(k).eqNullSafe(F.col(f"__{i}"))
        cond = c if cond is None else cond & c
    return df.join(years, cond, "left").select(*[F.col("__to").alias(col) if c == col else F.col(c) for c in df.columns])


def missing_flag(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """1 where ``col`` is NULL (take it before imputing)."""
    return df.withColumn(out or f"missing_{col}", F.col(col).isNull().cast("int"))
