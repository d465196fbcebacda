"""Hourly grids, local time, reindexing and gap filling per site.

Every window here is ``partitionBy(key).orderBy(time)``.  After a reindex the
key's rows are unique per hour, so one partition-key group holds at most the
number of hours in the interval (17,544 for two years) no matter how large
the other tables grow; the windows never see an unbounded group.  All
windows of one call share one exchange and one sort.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.datetime import shift_hours
from wattlake.functions.lookup import site_offset
from wattlake.operators import spline
from wattlake.operators.spline import fill_series as spline_fill_series  # noqa: F401
from wattlake.session import ship_package


def _ts_lit(t) -> Column:
    if isinstance(t, Column):
        return t
    if isinstance(t, str):
        t = dt.datetime.fromisoformat(t)
    if isinstance(t, dt.date) and not isinstance(t, dt.datetime):
        t = dt.datetime(t.year, t.month, t.day)
    # a string literal casts to timestamp_ntz without any time zone (a Python
    # datetime literal would pass through the process and session zones)
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def hour_sequence(start, end) -> Column:
    """Array of every hour from start to end inclusive (timestamp_ntz)."""
    return F.sequence(_ts_lit(start), _ts_lit(end), F.expr("INTERVAL 1 HOUR"))


def to_local_time(df: DataFrame, offsets: Sequence[int] | None = None, site_col: str = "site_id",
                  time_col: str = "timestamp") -> DataFrame:
    """Shift timestamps by the fixed UTC offset of their site (no DST).
    A site without an offset gets a NULL timestamp."""
    off = site_offset(F.col(site_col), offsets)
    return df.withColumn(time_col, shift_hours(F.col(time_col), off))


def site_hour_grid(df: DataFrame, start, end, site_col: str = "site_id",
                   time_col: str = "timestamp") -> DataFrame:
    """Every distinct site of ``df`` times every hour of [start, end].

    Generated per site with ``explode(sequence(...))`` (a generator, not a
    join); its size is sites x hours."""
    return (df.select(site_col).distinct()
            .select(site_col, F.explode(hour_sequence(start, end)).alias(time_col)))


def grid_rows(df: DataFrame, start, end, site_col: str = "site_id") -> int:
    """Exact row count of ``site_hour_grid``/``reindex_time`` output: distinct
    sites (one small aggregate) times the hours of [start, end]."""
    def _dt(t):
        if isinstance(t, str):
            t = dt.datetime.fromisoformat(t)
        return t
    hours = int((_dt(end) - _dt(start)).total_seconds() // 3600) + 1
    return df.select(site_col).distinct().count() * max(hours, 0)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if any key appears more than once (one aggregate job)."""
    dup = (df.groupBy(*keys).count().where(F.col("count") > 1)
           .select(F.count("*").alias("n")).first()["n"])
    if dup:
        raise ValueError(f"{dup} duplicate keys on {list(keys)}; cannot reindex")


def unique_or_fail(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``df``, failing the job if any key repeats.  The check is
    part of the same plan (a grouped count with ``assert_true``), so it
    costs a shuffle on the keys but no separate job."""
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"),
                              *[F.first(c).alias(c) for c in others])
    msg = f"duplicate keys on {keys}; cannot reindex"
    return g.where(F.assert_true(F.col("__n") == 1, msg).isNull()).select(*df.columns)


def reindex_time(df: DataFrame, start, end, site_col: str = "site_id", time_col: str = "timestamp",
                 check_unique: bool | str = "plan") -> DataFrame:
    """Left-join the data onto the complete site x hour grid: missing hours
    become NULL rows and rows outside [start, end] are dropped.  Duplicate
    (site, hour) keys are an error: ``check_unique='plan'`` fails inside the
    query, ``True`` runs a separate check job first, ``False`` skips it."""
    if check_unique is True:
        assert_unique(df, [site_col, time_col])
    elif check_unique == "plan":
        df = unique_or_fail(df, [site_col, time_col])
    grid = site_hour_grid(df, start, end, site_col, time_col)
    return grid.join(df, [site_col, time_col], "left")


# --------------------------------------------------------------------------
# window fills

def _w(by: Sequence[str], order: str):
    return Window.partitionBy(*by).orderBy(order)


def _running(by: Sequence[str], order: str, descending: bool = False):
    """Running frame (unbounded preceding .. current row).  A backward look
    is the same running frame over the reversed order: Spark evaluates a
    running frame incrementally (linear per partition), whereas a frame
    ending at "unbounded following" is re-aggregated for every row."""
    o = F.col(order).desc() if descending else F.col(order).asc()
    return Window.partitionBy(*by).orderBy(o).rowsBetween(Window.unboundedPreceding, 0)


def forward_fill(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("site_id",),
                 order: str = "timestamp") -> DataFrame:
    w = _running(by, order)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def backward_fill(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("site_id",),
                  order: str = "timestamp") -> DataFrame:
    w = _running(by, order, descending=True)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def ffill_bfill(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("site_id",),
                order: str = "timestamp") -> DataFrame:
    """Forward fill, then backward fill what is still missing at the start.
    One projection: Spark plans the ascending and descending running
    frames as two window operators over one exchange."""
    cols = set(cols)
    fw, bw = _running(by, order), _running(by, order, True)
    return df.select(*[F.coalesce(F.last(c, ignorenulls=True).over(fw), F.last(c, ignorenulls=True).over(bw)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def interpolate_linear(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("site_id",),
                       order: str = "timestamp") -> DataFrame:
    """Linear interpolation by row position within each group; leading and
    trailing gaps take the nearest known value; all-null groups stay null.

    Window passes over one partitioning: row position, then previous known
    (value, position) on the ascending running frame and next known on the
    descending running frame; then plain arithmetic."""
    cols = list(cols)
    pos = "__pos"
    d = df.withColumn(pos, F.row_number().over(_w(by, order)))
    fwd = _running(by, order)
    bwd = _running(by, order, descending=True)
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col(pos).alias("p"))) for c in cols}
    d = d.select("*", *[F.last(known[c], ignorenulls=True).over(fwd).alias(f"__prev_{c}") for c in cols],
                 *[F.last(known[c], ignorenulls=True).over(bwd).alias(f"__next_{c}") for c in cols])
    out = []
    for c in df.columns:
        if c not in cols:
            out.append(F.col(c))
            continue
        v, prev, nxt = F.col(c), F.col(f"__prev_{c}"), F.col(f"__next_{c}")
        pv, pp, nv, np_ = prev["v"], prev["p"], nxt["v"], nxt["p"]
        interp = pv + (nv - pv) * (F.col(pos) - pp) / (np_ - pp)
        out.append(F.when(v.isNotNull(), v).when(pp.isNotNull() & np_.isNotNull(), interp)
                   .otherwise(F.coalesce(pv, nv)).alias(c))
    return d.select(*out)


# --------------------------------------------------------------------------
# cubic spline (the one operator Spark expressions cannot state: a global
# solve per series)

def interpolate_cubic(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("site_id",),
                      order: str = "timestamp", chunk_hours: int | None = None) -> DataFrame:
    """Cubic-spline fill inside each group's known range (edges stay null;
    callers ffill/bfill them).  One ``applyInPandas`` over ``by``, or, with
    ``chunk_hours``, the same spline solved in chunks (see ``spline``)."""
    ship_package(df.sparkSession)
    if chunk_hours:
        return spline.interpolate_chunked(df, cols, by, order, chunk_hours)
    return spline.interpolate_whole(df, list(cols), list(by), order)


def fill_missing(df: DataFrame, ffill_cols: Sequence[str] = (), linear_cols: Sequence[str] = (),
                 cubic_cols: Sequence[str] = (), by: Sequence[str] = ("site_id",),
                 order: str = "timestamp", others: str | None = None,
                 cubic_method: str = "cubic", chunk_hours: int | None = None) -> DataFrame:
    """Per-group fill: listed columns forward/backward fill, linear or cubic
    interpolation, each followed by ffill + bfill.  ``others='ffill'`` also
    ffill/bfills every remaining column (packaged-pipeline variant).  A
    series with no value at all stays null.  ``cubic_method='linear'`` swaps
    the spline for linear interpolation (JVM-only plan).  ``chunk_hours``
    runs every step in time chunks (``fill_chunked``, ``spline``), for keys
    whose series are too long for one task."""
    by = list(by)
    out = df
    lin = list(linear_cols)
    if cubic_cols:
        if cubic_method == "cubic":
            out = interpolate_cubic(out, cubic_cols, by, order, chunk_hours)
        else:
            lin = list(cubic_cols) + lin
    if chunk_hours:
        if lin:
            out = fill_chunked(out, lin, by, order, chunk_hours, "linear")
        rest = list(ffill_cols) + ([c for c in cubic_cols] if cubic_method == "cubic" else [])
        if others == "ffill":
            skip = set(by) | {order} | set(lin) | set(rest)
            rest += [c for c in df.columns if c not in skip]
        return fill_chunked(out, rest, by, order, chunk_hours, "ffill") if rest else out
    if lin:
        # linear interpolation already gives edges their nearest known
        # value, so its columns need no ffill/bfill pass afterwards
        out = interpolate_linear(out, lin, by, order)
    fill_cols = list(ffill_cols) + (list(cubic_cols) if cubic_method == "cubic" else [])
    if others == "ffill":
        skip = set(by) | {order} | set(fill_cols) | set(lin)
        fill_cols += [c for c in df.columns if c not in skip]
    if fill_cols:
        out = ffill_bfill(out, fill_cols, by, order)
    return out


def copy_site_column(df: DataFrame, col: str = "sea_level_pressure", from_site: int = 1,
                     to_site: int = 5, site_col: str = "site_id",
                     time_col: str = "timestamp") -> DataFrame:
    """Overwrite one site's column with another site's value at the same
    timestamp.  A window partitioned by timestamp carries the source
    site's value to every row of that hour (a group holds one row per site,
    so it is bounded), in one pass and without re-running the upstream plan
    as a self join would."""
    w = Window.partitionBy(time_col)
    src = F.max(F.when(F.col(site_col) == from_site, F.col(col))).over(w)
    return df.withColumn(col, F.when(F.col(site_col) == to_site, src).otherwise(F.col(col)))


# --------------------------------------------------------------------------
# skew-safe variant: split every key's series into time chunks

def fill_chunked(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("site_id",),
                 order: str = "timestamp", chunk_hours: int = 24 * 7, method: str = "linear") -> DataFrame:
    """ffill+bfill (``method='ffill'``) or linear interpolation by row
    position followed by ffill+bfill (``'linear'``), with each key's series
    cut into chunks of ``chunk_hours``.

    The row windows run per (key, chunk), so a key holding a third of all
    rows is spread over many tasks.  What crosses chunk borders -- the row
    offset and the last / next known value and position -- comes from a
    small per-(key, chunk) summary (keys x chunks rows) with windows over
    chunks, joined back on (key, chunk), the partitioning the row windows
    already have.  Results equal the single-window operators."""
    by, cols = list(by), list(cols)
    kc = by + ["__c"]
    hours = F.datediff(F.to_date(F.col(order)), F.lit("1970-01-01").cast("date")) * 24 + F.hour(F.col(order))
    d = df.withColumn("__c", F.floor(hours / F.lit(chunk_hours)))
    w_asc = Window.partitionBy(*kc).orderBy(order)
    d = d.withColumn("__lp", F.row_number().over(w_asc))
    fwd = Window.partitionBy(*kc).orderBy(F.col(order).asc()).rowsBetween(Window.unboundedPreceding, 0)
    bwd = Window.partitionBy(*kc).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col("__lp").alias("p")))
             for c in cols}
    d = d.withColumns({f"__f_{c}": F.last(known[c], ignorenulls=True).over(fwd) for c in cols})
    d = d.withColumns({f"__b_{c}": F.last(known[c], ignorenulls=True).over(bwd) for c in cols})
    # per-chunk summary: row count, last and first known (value, local pos)
    summ = d.groupBy(*kc).agg(
        F.count("*").alias("__n"),
        *[F.max_by(known[c], F.when(F.col(c).isNotNull(), F.col("__lp"))).alias(f"__sl_{c}") for c in cols],
        *[F.min_by(known[c], F.when(F.col(c).isNotNull(), F.col("__lp"))).alias(f"__sf_{c}") for c in cols])
    before = Window.partitionBy(*by).orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*by).orderBy(F.col("__c").desc()).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0)))

    def glob(s: Column) -> Column:  # local position -> position within the key
        return F.when(s.isNotNull(), F.struct(s["v"].alias("v"), (s["p"] + F.col("__off")).alias("p")))

    summ = summ.withColumns({f"__gl_{c}": glob(F.col(f"__sl_{c}")) for c in cols}
                            | {f"__gf_{c}": glob(F.col(f"__sf_{c}")) for c in cols})
    summ = summ.withColumns({f"__cp_{c}": F.last(f"__gl_{c}", ignorenulls=True).over(before) for c in cols}
                            | {f"__cn_{c}": F.last(f"__gf_{c}", ignorenulls=True).over(after) for c in cols})
    summ = summ.select(*kc, "__off", *[f"__cp_{c}" for c in cols], *[f"__cn_{c}" for c in cols])
    j = d.join(summ, kc, "left")
    pos = F.col("__lp") + F.col("__off")
    out = {}
    for c in cols:
        f, b = F.col(f"__f_{c}"), F.col(f"__b_{c}")
        prev = F.coalesce(F.when(f.isNotNull(), F.struct(f["v"].alias("v"), (f["p"] + F.col("__off")).alias("p"))),
                          F.col(f"__cp_{c}"))
        nxt = F.coalesce(F.when(b.isNotNull(), F.struct(b["v"].alias("v"), (b["p"] + F.col("__off")).alias("p"))),
                         F.col(f"__cn_{c}"))
        pv, pp, nv, np_ = prev["v"], prev["p"], nxt["v"], nxt["p"]
        if method == "linear":
            interp = pv + (nv - pv) * (pos - pp) / (np_ - pp)
            out[c] = (F.when(F.col(c).isNotNull(), F.col(c))
                      .when(pp.isNotNull() & np_.isNotNull(), interp)
                      .otherwise(F.coalesce(pv, nv)))
        elif method == "ffill":
            out[c] = F.coalesce(F.col(c), pv, nv)
        else:
            raise ValueError(method)
    tmp = ["__c", "__lp", "__off"] + [f"__{k}_{c}" for c in cols for k in ("f", "b", "cp", "cn")]
    return j.withColumns(out).drop(*tmp).select(*df.columns)
