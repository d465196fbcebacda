"""Not-a-knot cubic splines over row positions, whole or split into time chunks.

The knots of a series are its known values.  Their slopes solve a tridiagonal
system; the two end conditions (third derivative continuous at the second and the
last but one knot) are used to eliminate the first and the last slope, which
leaves a diagonally dominant system for the inner knots.  It is solved by
parallel cyclic reduction: about log2(n) array operations, no loop over rows.

``interpolate_chunked`` solves the same system by substructuring, for series that
are too long for one task:

1. every chunk of a series eliminates its own knots and states its first and last
   slope as linear functions of the neighbouring chunks' border slopes;
2. one small solve per series (two unknowns a chunk) gives the border slopes;
3. every chunk solves its knots with the known borders and fills its gaps.

What crosses chunk borders is a summary of series x chunks rows.  Results equal the
whole solve up to rounding.

Values before the first and after the last known value stay missing.  Series with
fewer than four known values are interpolated linearly (the conditions need four).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEAST_KNOTS = 4


# ------------------------------------------------------------------ one system

def solve_tridiagonal(lower: np.ndarray, diag: np.ndarray, upper: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Parallel cyclic reduction of a diagonally dominant system; ``rhs`` may have several columns."""
    n, step = len(diag), 1
    a, b, c = lower.astype(float).copy(), diag.astype(float).copy(), upper.astype(float).copy()
    d = rhs.astype(float).reshape(n, -1).copy()
    if n:
        a[0] = c[-1] = 0.0
    while step < n:
        down, up = np.zeros(n), np.zeros(n)
        down[step:] = -a[step:] / b[:-step]
        up[:-step] = -c[:-step] / b[step:]
        na, nb, nc, nd = np.zeros(n), b.copy(), np.zeros(n), d.copy()
        na[step:] = down[step:] * a[:-step]
        nb[step:] += down[step:] * c[:-step]
        nd[step:] += down[step:, None] * d[:-step]
        nc[:-step] = up[:-step] * c[step:]
        nb[:-step] += up[:-step] * a[step:]
        nd[:-step] += up[:-step, None] * d[step:]
        a, b, c, d, step = na, nb, nc, nd, step * 2
    return (d / b[:, None]).reshape(rhs.shape)


class Rows:
    """The rows of the system for inner knots, from each knot and its two neighbours.

    ``second`` / ``last_but_one`` mark the knots next to the ends; ``first_slope`` and ``last_slope`` give the end slopes as
    (constant, factor) of the slope of those knots."""

    def __init__(self, xp, yp, x, y, xn, yn, second: np.ndarray, last_but_one: np.ndarray):
        h0, h1 = x - xp, xn - x
        s0, s1, d = (y - yp) / h0, (yn - y) / h1, xn - xp
        self.lower, self.diag, self.upper = h1.astype(float), 2.0 * d, h0.astype(float)
        self.rhs = 3.0 * (h1 * s0 + h0 * s1)
        self.first_slope = self.last_slope = (0.0, 0.0)
        if second.any():
            r = ((h0 + 2.0 * d) * h1 * s0 + h0 ** 2 * s1) / d
            self.rhs = np.where(second, self.rhs - r, self.rhs)
            self.diag = np.where(second, self.diag - d, self.diag)
            self.lower = np.where(second, 0.0, self.lower)
            i = int(np.flatnonzero(second)[0])
            self.first_slope = (float(r[i] / h1[i]), float(-d[i] / h1[i]))
        if last_but_one.any():
            r = (h1 ** 2 * s0 + (2.0 * d + h1) * h0 * s1) / d
            self.rhs = np.where(last_but_one, self.rhs - r, self.rhs)
            self.diag = np.where(last_but_one, self.diag - d, self.diag)
            self.upper = np.where(last_but_one, 0.0, self.upper)
            i = int(np.flatnonzero(last_but_one)[0])
            self.last_slope = (float(r[i] / h0[i]), float(-d[i] / h0[i]))


def knot_slopes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slopes of the not-a-knot spline at all knots (four or more)."""
    n = len(x)
    i = np.arange(1, n - 1)
    rows = Rows(x[:-2], y[:-2], x[1:-1], y[1:-1], x[2:], y[2:], i == 1, i == n - 2)
    inner = solve_tridiagonal(rows.lower, rows.diag, rows.upper, rows.rhs)
    ends = [a + b * s for (a, b), s in ((rows.first_slope, inner[0]), (rows.last_slope, inner[-1]))]
    return np.concatenate([ends[:1], inner, ends[1:]])


def evaluate(x: np.ndarray, y: np.ndarray, s: np.ndarray, xq: np.ndarray) -> np.ndarray:
    """Cubic pieces with values ``y`` and slopes ``s`` at ``x``, at ``xq`` inside the range."""
    i = np.clip(np.searchsorted(x, xq, side="right") - 1, 0, len(x) - 2)
    h, t = x[i + 1] - x[i], xq - x[i]
    slope = (y[i + 1] - y[i]) / h
    c2 = (3.0 * slope - 2.0 * s[i] - s[i + 1]) / h
    c3 = (s[i] + s[i + 1] - 2.0 * slope) / h ** 2
    return y[i] + t * (s[i] + t * (c2 + t * c3))


def fill_series(values: np.ndarray) -> np.ndarray:
    """Fill NaNs strictly inside the known range by a cubic spline over row positions."""
    y = values.astype("float64", copy=True)
    known = np.flatnonzero(~np.isnan(y))
    if len(known) < 2:
        return y
    gaps = np.flatnonzero(np.isnan(y))
    gaps = gaps[(gaps > known[0]) & (gaps < known[-1])]
    if not len(gaps):
        return y
    x, v = known.astype(float), y[known]
    if len(known) < LEAST_KNOTS:
        y[gaps] = np.interp(gaps, x, v)
    else:
        y[gaps] = evaluate(x, v, knot_slopes(x, v), gaps.astype(float))
    return y


def interpolate_whole(df: DataFrame, cols: Sequence[str], by: Sequence[str], order: str) -> DataFrame:
    """One ``applyInPandas`` over ``by``; a group is one series (bounded by the reindex interval)."""

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="mergesort").reset_index(drop=True)
        for c in cols:
            pdf[c] = fill_series(pdf[c].to_numpy(dtype="float64", na_value=np.nan))
        return pdf

    return df.groupBy(*by).applyInPandas(fill, schema=df.schema)


# ------------------------------------------------------------------ split series

class _Chunk:
    """Knots of one column in one chunk, with the neighbouring knots of the series."""

    def __init__(self, pdf: pd.DataFrame, info: pd.Series, i: int, col: str):
        v = pdf[col].to_numpy(dtype="float64", na_value=np.nan)
        self.pos = pdf["__lp"].to_numpy(dtype="float64") + float(info["__off"])
        at = np.flatnonzero(~np.isnan(v))
        self.values, self.x, self.y = v, self.pos[at], v[at]
        self.total, self.index = int(info[f"__kt{i}"]), int(info[f"__kb{i}"]) + np.arange(len(at))
        num = lambda name: float(info[name]) if pd.notna(info[name]) else np.nan
        self.prev, self.next = (num(f"__pp{i}"), num(f"__pv{i}")), (num(f"__np{i}"), num(f"__nv{i}"))
        self.inner = (self.index >= 1) & (self.index <= self.total - 2) & (self.total >= LEAST_KNOTS)

    def rows(self) -> Rows:
        xs, ys = (np.concatenate([[p], a, [n]]) for p, a, n in zip(self.prev, (self.x, self.y), self.next))
        k = np.flatnonzero(self.inner)
        i = self.index[k]
        return Rows(xs[k], ys[k], xs[k + 1], ys[k + 1], xs[k + 2], ys[k + 2], i == 1, i == self.total - 2)


_COEF = ["__u1", "__v1", "__w1", "__um", "__vm", "__wm", "__a0", "__b0", "__an", "__bn"]


def _eliminated(by: Sequence[str], cols: Sequence[str]):
    """Step 1: a chunk's border slopes as functions of its neighbours'."""

    def run(pdf: pd.DataFrame, info: pd.DataFrame) -> pd.DataFrame:
        out, head = [], info.iloc[0]
        pdf = pdf.sort_values("__lp", kind="mergesort")
        for i, col in enumerate(cols):
            c = _Chunk(pdf, head, i, col)
            m = int(c.inner.sum())
            row = dict.fromkeys(_COEF, 0.0) | {"__col": i, "__m": m, "__k": len(c.x)}
            if m:
                r = c.rows()
                borders = np.zeros((m, 3))
                borders[:, 0] = r.rhs
                borders[0, 1], borders[-1, 2] = -r.lower[0], -r.upper[-1]
                s = solve_tridiagonal(r.lower, r.diag, r.upper, borders)
                row |= dict(zip(_COEF[:6], [*s[0], *s[-1]]))
                row |= dict(zip(_COEF[6:], [*r.first_slope, *r.last_slope]))
            out.append([head[f"__i_{b}"] for b in [*by, "__c"]] + [head[f"__kb{i}"], head[f"__kt{i}"]]
                       + [row[n] for n in ["__col", "__m", "__k", *_COEF]])
        return pd.DataFrame(out, columns=[*by, "__c", "__kb", "__kt", "__col", "__m", "__k", *_COEF])

    return run


def _borders(by: Sequence[str]):
    """Step 2: the slopes at the knots before and after every chunk of a series, and at its two ends."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["__col", "__c"], kind="mergesort").reset_index(drop=True)
        out = pdf[[*by, "__c", "__col"]].copy()
        for name in ("__sp", "__sn", "__s0", "__sl"):
            out[name] = 0.0
        for _, part in pdf.groupby("__col", sort=False):
            if int(part["__kt"].iloc[0]) < LEAST_KNOTS:
                continue
            full = part[part["__m"] > 0]
            u1, v1, w1, um, vm, wm = (full[n].to_numpy() for n in _COEF[:6])
            k = len(full)
            # forward: first and last slope of a chunk as functions of the next chunk's first slope
            f = np.zeros((k, 2))
            last = np.zeros((k, 2))
            a = b = 0.0
            for i in range(k):
                d = 1.0 - v1[i] * b
                f[i] = (u1[i] + v1[i] * a) / d, w1[i] / d
                last[i] = um[i] + vm[i] * (a + b * f[i, 0]), vm[i] * b * f[i, 1] + wm[i]
                a, b = last[i]
            first_s, last_s, after = np.zeros(k), np.zeros(k), 0.0
            for i in range(k - 1, -1, -1):
                first_s[i], last_s[i] = f[i, 0] + f[i, 1] * after, last[i, 0] + last[i, 1] * after
                after = first_s[i]
            s0 = float((full["__a0"] + full["__b0"] * first_s)[full["__kb"] <= 1].iloc[0]) if k else 0.0
            sl = float(full["__an"].iloc[-1] + full["__bn"].iloc[-1] * last_s[-1]) if k else 0.0
            # knots before and after every chunk, of this series
            before, total, own = part["__kb"].to_numpy(), int(part["__kt"].iloc[0]), part["__k"].to_numpy()
            place = np.cumsum((part["__m"] > 0).to_numpy())          # chunks with inner knots up to here
            there = (part["__m"] > 0).to_numpy()
            ahead = place - there                                    # ... before here
            padded_last, padded_first = np.concatenate([[0.0], last_s]), np.concatenate([first_s, [0.0]])
            prev, nxt = before - 1, before + own
            out.loc[part.index, "__sp"] = np.where(prev <= 0, s0, np.where(prev >= total - 1, sl, padded_last[ahead]))
            out.loc[part.index, "__sn"] = np.where(nxt >= total - 1, sl, np.where(nxt <= 0, s0, padded_first[np.minimum(place, k)]))
            out.loc[part.index, "__s0"], out.loc[part.index, "__sl"] = s0, sl
        return out

    return run


def _finished(by: Sequence[str], cols: Sequence[str], names: Sequence[str]):
    """Step 3: slopes of the chunk's knots from the known borders, and the gaps."""

    def run(pdf: pd.DataFrame, info: pd.DataFrame) -> pd.DataFrame:
        head = info.iloc[0]
        pdf = pdf.sort_values("__lp", kind="mergesort").reset_index(drop=True)
        for i, col in enumerate(cols):
            c = _Chunk(pdf, head, i, col)
            xs, ys = (np.concatenate([[p], a, [n]]) for p, a, n in zip(c.prev, (c.x, c.y), c.next))
            has = ~np.isnan(xs)
            gaps = np.flatnonzero(np.isnan(c.values))
            if has.any():
                lo, hi = xs[has].min(), xs[has].max()
                gaps = gaps[(c.pos[gaps] > lo) & (c.pos[gaps] < hi)]
            if not has.sum() >= 2 or not len(gaps):
                continue
            if c.total < LEAST_KNOTS:
                c.values[gaps] = np.interp(c.pos[gaps], xs[has], ys[has])
            else:
                slope = np.zeros(len(c.x))
                slope[c.index == 0], slope[c.index == c.total - 1] = head[f"__s0{i}"], head[f"__sl{i}"]
                if c.inner.any():
                    r = c.rows()
                    rhs = r.rhs.copy()
                    rhs[0] -= r.lower[0] * head[f"__sp{i}"]
                    rhs[-1] -= r.upper[-1] * head[f"__sn{i}"]
                    slope[c.inner] = solve_tridiagonal(r.lower, r.diag, r.upper, rhs)
                s = np.concatenate([[head[f"__sp{i}"]], slope, [head[f"__sn{i}"]]])
                c.values[gaps] = evaluate(xs[has], ys[has], s[has], c.pos[gaps])
            pdf[col] = c.values
        return pdf[list(names)]

    return run


def interpolate_chunked(df: DataFrame, cols: Sequence[str], by: Sequence[str], order: str, chunk_hours: int) -> DataFrame:
    """Cubic interpolation with every series cut into chunks of ``chunk_hours`` (see the module text)."""
    by, cols = list(by), list(cols)
    kc = [*by, "__c"]
    hours = F.datediff(F.to_date(F.col(order)), F.lit("1970-01-01").cast("date")) * 24 + F.hour(F.col(order))
    d = df.withColumn("__c", F.floor(hours / F.lit(chunk_hours)))
    d = d.withColumn("__lp", F.row_number().over(Window.partitionBy(*kc).orderBy(order)))
    d = d.withColumns({c: F.col(c).cast("double") for c in cols})
    known = {c: F.when(F.col(c).isNotNull() & ~F.isnan(c), F.struct(F.col("__lp").alias("p"), F.col(c).alias("v"))) for c in cols}
    summ = d.groupBy(*kc).agg(F.count(F.lit(1)).alias("__n"), *[x for i, c in enumerate(cols) for x in (
        F.count(known[c]).alias(f"__k{i}"), F.min(known[c]).alias(f"__f{i}"), F.max(known[c]).alias(f"__l{i}"))])
    # series x chunks rows
    before = Window.partitionBy(*by).orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*by).orderBy(F.col("__c").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    zero = F.lit(0).cast("long")
    summ = summ.withColumn("__off", F.coalesce(F.sum("__n").over(before), zero))
    summ = summ.withColumns({f"__g{e}{i}": F.when(F.col(f"__{e}{i}").isNotNull(), F.struct(
        (F.col(f"__{e}{i}.p") + F.col("__off")).alias("p"), F.col(f"__{e}{i}.v").alias("v")))
        for i in range(len(cols)) for e in "fl"})
    pick = [*kc, "__off"]
    for i in range(len(cols)):
        prev, nxt = F.last(f"__gl{i}", ignorenulls=True).over(before), F.last(f"__gf{i}", ignorenulls=True).over(after)
        pick += [F.coalesce(F.sum(f"__k{i}").over(before), zero).alias(f"__kb{i}"), F.sum(f"__k{i}").over(whole).alias(f"__kt{i}"),
                 prev["p"].alias(f"__pp{i}"), prev["v"].alias(f"__pv{i}"), nxt["p"].alias(f"__np{i}"), nxt["v"].alias(f"__nv{i}")]
    info = summ.select(*pick).withColumnsRenamed({k: f"__i_{k}" for k in kc})
    own = [f"__i_{k}" for k in kc]
    types = {f.name: f.dataType.simpleString() for f in d.schema.fields}
    keys = ", ".join(f"`{k}` {types[k]}" for k in kc)
    coef = d.select(*kc, "__lp", *cols).groupBy(*kc).cogroup(info.groupBy(*own)).applyInPandas(
        _eliminated(by, cols), f"{keys}, __kb long, __kt long, __col int, __m int, __k int, " + ", ".join(f"{n} double" for n in _COEF))
    slopes = coef.groupBy(*by).applyInPandas(_borders(by), f"{keys}, __col int, __sp double, __sn double, __s0 double, __sl double")
    wide = slopes.groupBy(*kc).agg(*[F.max(F.when(F.col("__col") == i, F.col(n))).alias(f"{n}{i}")
                                     for i in range(len(cols)) for n in ("__sp", "__sn", "__s0", "__sl")])
    cond = None
    for k in kc:
        c = F.col(f"__i_{k}").eqNullSafe(F.col(k))
        cond = c if cond is None else cond & c
    full = info.join(wide, cond).drop(*kc)
    out = ", ".join(f"`{n}` {types[n]}" for n in df.columns)
    return d.groupBy(*kc).cogroup(full.groupBy(*own)).applyInPandas(_finished(by, cols, df.columns), out)
