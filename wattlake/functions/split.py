"""Deterministic split buckets.

``randomSplit`` depends on partitioning and row order; a hash of the row key
gives the same bucket on every run, every engine and after any executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_bucket(key: Column, buckets: int = 100) -> Column:
    """0..buckets-1 from the first 32 bits of md5(key as string)."""
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(buckets))
