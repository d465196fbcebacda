"""Lasso paths per meter from sufficient statistics: one read of the rows for every fold, alpha and feature set.

``moment_table`` is one aggregate over the complete rows, by (group, fold,
categories): counts, sums and sums of products of the numeric columns and the
target.  Its size is the number of distinct category combinations times the folds.
Everything else works on it:

* leaving a fold out is a sum over the others (``held`` = that fold; -1: none);
* rare labels, category means and scales are fitted on those sums, inside the fold;
* a category's encoded value is constant in a table row, so all products with it
  follow from the row's sums, and 14 columns give one 14 x 14 system per (group, held);
* coordinate descent solves the system for all alphas and feature sets, and the
  squared error on the held fold is a quadratic form of the held fold's own sums.

The objective is that of ``ml.lasso``: 1 / (2 n) ||y - b - X w||^2 + alpha ||w||_1 on scaled
columns; a column without variance gets no weight.  Rows with a null in the group,
a numeric column or the target are left out; null categories count as rare labels,
and rows of a held fold whose label the others do not have are not scored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.constants import RARE_MIN_CATEGORIES, RARE_TOL
from wattlake.operators import stages
from wattlake.session import ensure_checkpoint_dir, ship_package

ALPHAS = tuple(10.0 ** k for k in range(-6, 2))
NO_FOLD = -1


# ------------------------------------------------------------------ sums

def moment_table(df: DataFrame, by: Sequence[str], cats: Sequence[str], nums: Sequence[str], label: str,
                 fold: str | None = "fold") -> DataFrame:
    """The sums of the module text, one row per (group, fold, categories)."""
    rows = df.dropna(subset=[*by, *nums, label])
    x, y = [F.col(c).cast("double") for c in nums], F.col(label).cast("double")
    aggs = [F.count(F.lit(1)).alias("__n"), F.count(F.lit(1)).alias("__yn"), F.sum(y).alias("__ys"), F.sum(y * y).alias("__yy")]
    for i, a in enumerate(x):
        aggs += [F.sum(a).alias(f"__s{i}"), F.min(a).alias(f"__lo{i}"), F.max(a).alias(f"__hi{i}"), F.sum(a * y).alias(f"__sy{i}")]
        aggs += [F.sum(a * x[k]).alias(f"__q{i}_{k}") for k in range(i, len(x))]
    keys = [*by, (F.col(fold) if fold else F.lit(NO_FOLD)).cast("int").alias("__fold")]
    return rows.groupBy(*keys, *[F.col(c).cast("string").alias(c) for c in cats]).agg(*aggs)


def _names(cats: Sequence[str], nums: Sequence[str]) -> list[str]:
    return [*cats, *nums]


def _products(cats: Sequence[str], nums: Sequence[str]) -> list[Column]:
    """Row sums over the columns (1, features, y): n, y, yy, then x, xy of each feature, then the upper triangle."""
    c, n = len(cats), F.col("__n")
    one = [n * F.col(k) for k in cats] + [F.col(f"__s{i}") for i in range(len(nums))]
    with_y = [F.col(k) * F.col("__ys") for k in cats] + [F.col(f"__sy{i}") for i in range(len(nums))]
    out = [n.cast("double"), F.col("__ys"), F.col("__yy"), *one, *with_y]
    names = _names(cats, nums)
    for a in range(len(names)):
        for b in range(a, len(names)):
            if b < c:
                out.append(n * F.col(names[a]) * F.col(names[b]))
            elif a < c:
                out.append(F.col(names[a]) * F.col(f"__s{b - c}"))
            else:
                out.append(F.col(f"__q{a - c}_{b - c}"))
    return out


def fold_sums(table: DataFrame, by: Sequence[str], cats: Sequence[str], nums: Sequence[str], folds: int,
              tol: float = RARE_TOL, min_categories: int = RARE_MIN_CATEGORIES) -> DataFrame:
    """One row per (group, held): ``train`` and ``valid`` (null without a fold), the summed products of encoded features;
    ``flat``, which features do not vary in training."""
    held = F.array(*[F.lit(k) for k in (NO_FOLD, *range(folds))])
    left = table.withColumn("held", F.explode(F.filter(held, lambda k: (k == NO_FOLD) | (k != F.col("__fold")))))
    key = [*by, "held"]
    given = dict(catCols=list(cats), by=key, tol=tol, minCategories=min_categories)
    rare = stages.RareLabelEstimator(**given)._from(left)
    labelled = rare.transform(left)
    mean = stages.MeanTargetEstimator(**given)._from(labelled)
    names = _names(cats, nums)

    def summed(encoded: DataFrame, out: str) -> DataFrame:
        there = encoded.dropna(subset=list(cats)) if cats else encoded
        aggs = [F.sum(p).alias(f"p{i}") for i, p in enumerate(_products(cats, nums))]
        low = [F.min(c) for c in cats] + [F.min(f"__lo{i}") for i in range(len(nums))]
        high = [F.max(c) for c in cats] + [F.max(f"__hi{i}") for i in range(len(nums))]
        got = there.groupBy(*key).agg(*aggs, F.array(*[a == b for a, b in zip(low, high)]).alias("flat"))
        return got.select(*key, F.array(*[f"p{i}" for i in range(len(aggs))]).alias(out), "flat")

    train = summed(mean.transform(labelled), "train")
    own = table.where(F.col("__fold") >= 0).withColumn("held", F.col("__fold"))
    valid = summed(mean.transform(rare.transform(own)), "valid").drop("flat")
    assert len(names)
    return train.join(valid, key, "left")


# ------------------------------------------------------------------ systems

class System:
    """Scaled and centred sums of one (group, held)."""

    def __init__(self, sums: np.ndarray, p: int, flat: np.ndarray | None = None, means=None, scales=None, y_mean=None):
        n, y, yy = sums[:3]
        one, xy = sums[3:3 + p], sums[3 + p:3 + 2 * p]
        full = np.zeros((p, p))
        full[np.triu_indices(p)] = sums[3 + 2 * p:]
        full = full + np.triu(full, 1).T
        self.n = n
        self.means = one / n if means is None else means
        self.y_mean = y / n if y_mean is None else y_mean
        # products around the given means: those of the training rows
        m, ym = self.means, self.y_mean
        cov = full / n - np.outer(one / n, m) - np.outer(m, one / n) + np.outer(m, m)
        cy = xy / n - one / n * ym - m * (y / n) + m * ym
        if scales is None:
            var = np.where(flat, 0.0, np.maximum(np.diag(cov), 0.0))
            scales = np.where(var > 0, np.sqrt(var), 1.0)
            cov[flat], cov[:, flat], cy[flat] = 0.0, 0.0, 0.0
        self.scales = scales
        self.gram, self.xy = cov / np.outer(scales, scales), cy / scales
        self.yy = yy / n - 2 * ym * y / n + ym * ym

    def squared_error(self, weights: np.ndarray) -> float:
        return float(self.yy - 2 * weights @ self.xy + weights @ self.gram @ weights)


def descend(gram: np.ndarray, xy: np.ndarray, alpha: float, start: np.ndarray, sweeps: int = 20_000,
            tolerance: float = 1e-13) -> np.ndarray:
    """Minimum of w'Gw / 2 - xy'w + alpha |w|_1 by coordinate descent; once the signs hold, by the linear system of the
    columns in use, if that meets the optimality conditions."""
    w, diag = start.copy(), np.diag(gram)
    use = np.flatnonzero(diag > 0)
    slack = xy - gram @ w
    for sweep in range(sweeps):
        moved = 0.0
        for j in use:
            rho = slack[j] + diag[j] * w[j]
            new = np.sign(rho) * max(abs(rho) - alpha, 0.0) / diag[j]
            if new != w[j]:
                moved = max(moved, abs(new - w[j]))
                slack -= gram[:, j] * (new - w[j])
                w[j] = new
        if moved < tolerance:
            break
        if sweep % 10 == 9:
            on = np.flatnonzero(w)
            if len(on):
                exact = np.zeros_like(w)
                exact[on] = np.linalg.lstsq(gram[np.ix_(on, on)], xy[on] - alpha * np.sign(w[on]), rcond=None)[0]
                rest = np.setdiff1d(use, on)
                left = xy - gram @ exact
                if ((np.sign(exact[on]) == np.sign(w[on])).all() and (np.abs(left[rest]) <= alpha + 1e-12).all()
                        and np.abs(left[on] - alpha * np.sign(w[on])).max() < 1e-11):
                    return exact
    return w


def paths(sums: DataFrame, by: Sequence[str], features: Sequence[str], alphas: Sequence[float] = ALPHAS,
          subsets: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Solutions for every (group, held, feature set, alpha): intercept, weights (of scaled features, 0 outside the set),
    means, scales, and the mean squared error on the held fold."""
    p, names = len(features), list(features)
    sets = {k: np.array([f in set(v) for f in names]) for k, v in (subsets or {"all": names}).items()}
    order = sorted(alphas, reverse=True)
    by = list(by)
    types = {f.name: f.dataType.simpleString() for f in sums.schema.fields}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, r in pdf.iterrows():
            system = System(np.array(r["train"], float), p, np.array(r["flat"], bool))
            valid = None
            if r["valid"] is not None:
                valid = System(np.array(r["valid"], float), p, None, system.means, system.scales, system.y_mean)
            for name, mask in sets.items():
                gram, xy = np.where(np.outer(mask, mask), system.gram, 0.0), np.where(mask, system.xy, 0.0)
                w = np.zeros(p)
                for alpha in order:  # from the sparsest: each solution starts the next
                    w = descend(gram, xy, alpha, w)
                    out.append([*[r[b] for b in by], int(r["held"]), name, alpha, system.y_mean, w.tolist(),
                                system.means.tolist(), system.scales.tolist(), valid.squared_error(w) if valid else None,
                                int(valid.n) if valid else None])
        return pd.DataFrame(out, columns=[*by, "held", "feature_set", "alpha", "intercept", "weights", "means", "scales", "msle", "n"])

    ship_package(sums.sparkSession)
    schema = ", ".join(f"`{b}` {types[b]}" for b in by) + (", " if by else "") + (
        "held int, feature_set string, alpha double, intercept double, weights array<double>, means array<double>, "
        "scales array<double>, msle double, n long")
    # a group is one row of sums
    return sums.groupBy(*by, "held").applyInPandas(run, schema)


# ------------------------------------------------------------------ operators

def lasso_paths(df: DataFrame, cats: Sequence[str], nums: Sequence[str], label: str, by: Sequence[str] = ("meter",),
                fold: str | None = "fold", folds: int = 8, alphas: Sequence[float] = ALPHAS,
                subsets: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``paths`` of the raw feature rows ``df``: one scan, whatever the number of folds, alphas and feature sets.  The
    result is held in the shared checkpoint folder (a few numbers per system)."""
    ensure_checkpoint_dir(df.sparkSession)
    table = moment_table(df, by, cats, nums, label, fold).checkpoint(eager=True)
    sums = fold_sums(table, by, cats, nums, folds if fold else 0)
    return paths(sums, by, _names(cats, nums), alphas, subsets).checkpoint(eager=True)


def principal_components(df: DataFrame, cats: Sequence[str], nums: Sequence[str], label: str, k: int = 2,
                         by: Sequence[str] = ("meter",)) -> DataFrame:
    """The first ``k`` principal components of the encoded and scaled features of each group, from the sums of one scan:
    (group, component, explained_variance, feature, loading).  A component's largest loading is positive."""
    ensure_checkpoint_dir(df.sparkSession)
    by, names = list(by), _names(cats, nums)
    table = moment_table(df, by, cats, nums, label, None).checkpoint(eager=True)
    sums = fold_sums(table, by, cats, nums, 0).drop("valid")
    types = {f.name: f.dataType.simpleString() for f in sums.schema.fields}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, r in pdf.iterrows():
            gram = System(np.array(r["train"], float), len(names), np.array(r["flat"], bool)).gram
            values, vectors = np.linalg.eigh(gram)
            for c in range(min(k, len(names))):
                v = vectors[:, -1 - c]
                v = v * np.sign(v[np.abs(v).argmax()])
                share = values[-1 - c] / max(values.sum(), 1e-300)
                out += [[*[r[b] for b in by], c, float(share), f, float(x)] for f, x in zip(names, v)]
        return pd.DataFrame(out, columns=[*by, "component", "explained_variance", "feature", "loading"])

    ship_package(df.sparkSession)
    schema = ", ".join(f"`{b}` {types[b]}" for b in by) + ", component int, explained_variance double, feature string, loading double"
    # a group is one row of sums
    return sums.groupBy(*by).applyInPandas(run, schema)


METHODS = ("variance", "target_corr", "uncorrelated", "lasso", "rfe_l1")


def select_features(system: System, names: Sequence[str], alpha: float, least_variance: float = 0.01, least_corr: float = 0.1,
                    twin_corr: float = 0.8, threshold: float = 1e-5, n_keep: int | None = None) -> dict[str, set[str]]:
    """Features that each method keeps, from one system of sums.

    variance: at least ``least_variance`` before scaling; target_corr: correlation with the target above ``least_corr``;
    uncorrelated: not the later column of a pair with correlation ``twin_corr`` and more; lasso: weight of at least
    ``threshold`` at ``alpha``; rfe_l1: what is left of dropping the weakest Lasso weight (ties: the first) until half
    (or ``n_keep``) remain, refitted at every step."""
    p, corr = len(names), system.gram
    varies = np.diag(corr) > 0
    y_std = np.sqrt(max(system.yy, 0.0))
    with_y = system.xy / y_std if y_std > 0 else np.zeros(p)
    out = {"variance": {names[i] for i in range(p) if varies[i] and system.scales[i] ** 2 * system.n / max(system.n - 1, 1) >= least_variance},
           "target_corr": {names[i] for i in range(p) if varies[i] and with_y[i] > least_corr},
           "uncorrelated": {names[j] for j in range(p) if not any(varies[i] and varies[j] and corr[i, j] >= twin_corr for i in range(j))}}
    w = descend(corr, system.xy, alpha, np.zeros(p))
    out["lasso"] = {names[i] for i in range(p) if abs(w[i]) >= threshold}
    keep = list(range(p))
    while len(keep) > (n_keep or max(1, p // 2)):
        w = descend(corr[np.ix_(keep, keep)], system.xy[keep], alpha, np.zeros(len(keep)))
        keep.pop(int(np.abs(w).argmin()))
    out["rfe_l1"] = {names[i] for i in keep}
    return out


def selections(df: DataFrame, cats: Sequence[str], nums: Sequence[str], label: str, alpha: float = 1e-3,
               by: Sequence[str] = ("meter",), methods: Sequence[str] = METHODS) -> DataFrame:
    """(group, method, feature): the features that each method keeps in each group, all from the sums of one scan."""
    ensure_checkpoint_dir(df.sparkSession)
    by, names = list(by), _names(cats, nums)
    table = moment_table(df, by, cats, nums, label, None).checkpoint(eager=True)
    sums = fold_sums(table, by, cats, nums, 0).drop("valid")
    types = {f.name: f.dataType.simpleString() for f in sums.schema.fields}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, r in pdf.iterrows():
            system = System(np.array(r["train"], float), len(names), np.array(r["flat"], bool))
            kept = select_features(system, names, alpha)
            out += [[*[r[b] for b in by], m, f] for m in methods for f in names if f in kept[m]]
        return pd.DataFrame(out, columns=[*by, "method", "feature"])

    ship_package(df.sparkSession)
    # a group is one row of sums
    return sums.groupBy(*by).applyInPandas(run, ", ".join(f"`{b}` {types[b]}" for b in by) + ", method string, feature string")


def side_by_side(chosen: DataFrame, features: Sequence[str], methods: Sequence[str], by: str = "meter") -> DataFrame:
    """One row per group and feature: a 0/1 column per method, and the votes."""
    flags = [F.max((F.col("method") == m).cast("int")).alias(m) for m in methods]
    got = chosen.groupBy(by, "feature").agg(*flags)
    every = chosen.select(by).distinct().select(by, F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))
    out = every.join(got, [by, "feature"], "left").na.fill(0, list(methods))
    return out.withColumn("votes", sum((F.col(m) for m in methods), F.lit(0)))


def cross_validated(solved: DataFrame, by: Sequence[str] = ("meter",)) -> DataFrame:
    """Per (group, feature set, alpha): mean and standard deviation of the folds' error, ranked in the group (best first,
    ties to the smaller alpha, then by feature set)."""
    from pyspark.sql import Window
    g = solved.where(F.col("held") >= 0).groupBy(*by, "feature_set", "alpha").agg(
        F.avg("msle").alias("mean_msle"), F.stddev_pop("msle").alias("std_msle"))
    # a group has feature sets x alphas rows
    w = Window.partitionBy(*by).orderBy(F.round("mean_msle", 6), "alpha", "feature_set")
    return g.withColumn("rank", F.row_number().over(w))


def predict(encoded: DataFrame, solved: DataFrame, features: Sequence[str], by: str = "meter", pred: str = "prediction",
            clip_at_zero: bool = True) -> DataFrame:
    """Predictions of scaled rows by one solution per group (``solved``: one row per value of ``by``)."""
    # one row per group, as many as there are models
    coef = solved.select(F.col(by).alias("__g"), F.col("intercept").alias("__b"), F.col("weights").alias("__w"))
    j = encoded.join(F.broadcast(coef), F.col(by) == F.col("__g"), "left")
    value = F.col("__b")
    for i, f in enumerate(features):
        value = value + F.col("__w")[i] * F.col(f)
    if clip_at_zero:
        value = F.when(value < 0, 0.0).otherwise(value)
    return j.withColumn(pred, value).drop("__g", "__b", "__w")
