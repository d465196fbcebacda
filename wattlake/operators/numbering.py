"""Numbers within groups without a window over the group's rows.

A window that numbers a group sorts the whole group in one task.  Here the rows are
range-partitioned by (group, order) instead, so a group of any size spreads over many
tasks; each row is numbered inside its partition, and a table of partitions x groups
gives what stands before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.session import scratch_dir

_ROW_BITS = 33  # of monotonically_increasing_id: partition above, row in the partition below


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str = "pos",
             partitions: int | None = None) -> DataFrame:
    """``df`` with ``out``: 0, 1, 2 ... in every group, by ``order`` (nulls first; equal rows in any order).

    The partitioned rows are written once to the shared folder, so counts and rows come from the same partitions."""
    spark = df.sparkSession
    by, order = list(by), list(order)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_dir(spark, "numbered")
    keys = [*by, *order]
    (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id())
     .write.parquet(path))
    rows = spark.read.parquet(path).withColumn("__pid", F.shiftright("__id", _ROW_BITS).cast("int"))
    counts = rows.groupBy("__pid", *by).agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    # one row per partition and group
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(F.col("__pid").alias("__p"), *[F.col(b).alias(f"__g_{b}") for b in by],
                         (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__base"))
    cond = F.col("__pid") == F.col("__p")
    for b in by:
        cond = cond & F.col(b).eqNullSafe(F.col(f"__g_{b}"))
    return rows.join(base, cond).select(*df.columns, (F.col("__id") + F.col("__base")).alias(out))
