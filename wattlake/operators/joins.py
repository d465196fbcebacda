"""Equi-joins of the meter fact table with its dimensions.

Building metadata and weather are dimensions whose size does not grow with
the meter table (one row per building; one row per site-hour).  No join
here forces a broadcast of a user table: Spark broadcasts a side only when
its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (the
size check), and AQE re-plans a shuffle join into a broadcast join at run
time when the materialised side turns out small.  Beyond the threshold the
join stays a shuffle (sort-merge) join, skew-split by AQE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.operators.numbering import numbered


def join_building(meter: DataFrame, building: DataFrame, on: str | Sequence[str] = "building_id",
                  how: str = "left") -> DataFrame:
    """meter LEFT JOIN building; meters without a building keep NULL metadata.
    Columns present on both sides (other than the keys) are taken from the
    building side only once."""
    keys = [on] if isinstance(on, str) else list(on)
    dup = [c for c in meter.columns if c in building.columns and c not in keys]
    return meter.drop(*dup).join(building, keys, how)


# largest dimension (rows) shipped to every executor
BROADCAST_MAX_ROWS = 2_000_000


def join_weather(mb: DataFrame, weather: DataFrame,
                 on: Sequence[str] = ("site_id", "timestamp"), how: str = "left",
                 weather_rows: int | None = None) -> DataFrame:
    """meter ⟕ weather on (site, hour).  ``weather_rows`` is a proven upper
    bound of the weather rows (a reindexed weather table has exactly sites x
    hours); under ``BROADCAST_MAX_ROWS`` the weather side is broadcast, so the
    meter fact table is never shuffled for this join.  Without a bound, or
    above it, Spark's own size estimate and AQE decide."""
    keys = list(on)
    dup = [c for c in weather.columns if c in mb.columns and c not in keys]
    w = weather.drop(*dup)
    if weather_rows is not None and weather_rows <= BROADCAST_MAX_ROWS:
        w = F.broadcast(w)
    return mb.join(w, keys, how)


def merge_data(meter: DataFrame, weather: DataFrame, building: DataFrame,
               on_mb: str | Sequence[str] = "building_id",
               on_mbw: Sequence[str] = ("site_id", "timestamp"), weather_rows: int | None = None) -> DataFrame:
    """meter ⟕ building ⟕ weather."""
    return join_weather(join_building(meter, building, on_mb), weather, on_mbw, weather_rows=weather_rows)


def attach_keys(pred: DataFrame, keys: DataFrame, on: str = "row_id") -> DataFrame:
    """keys LEFT JOIN predictions by row id (every key row kept)."""
    return keys.join(pred, on, "left")


def join_models(outputs: dict[str, DataFrame], on: str = "row_id",
                value_col: str = "meter_reading") -> DataFrame:
    """Side-by-side predictions of several models: one column per model."""
    names = list(outputs)
    out = outputs[names[0]].select(on, F.col(value_col).alias(names[0]))
    for n in names[1:]:
        out = out.join(outputs[n].select(on, F.col(value_col).alias(n)), on, "left")
    return out


def align_by_position(lists: DataFrame, group_col: str, value_col: str, order_col: str | None = None,
                      groups: Sequence | None = None, fill: str = "") -> DataFrame:
    """Ragged lists (one per group) as side-by-side columns aligned by position.

    ``lists`` is long form (group, value).  Positions come from a range
    partition (``numbering``), so one long list spreads over many tasks; the
    per-group columns are then full-outer joined on the position.  Missing
    cells become ``fill``."""
    order_col = order_col or value_col
    if groups is None:
        groups = [r[0] for r in lists.select(group_col).distinct().orderBy(group_col).collect()]
    pos = numbered(lists, [group_col], [order_col]).withColumn("pos", F.col("pos").cast("int"))
    out = None
    for g in groups:
        part = (pos.where(F.col(group_col) == F.lit(g))
                .select("pos", F.col(value_col).cast("string").alias(f"{group_col}_{g}")))
        out = part if out is None else out.join(part, "pos", "full")
    return out.na.fill(fill)
