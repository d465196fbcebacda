"""Splits, regression models (Spark ML), tuning, scoring and metrics.

Models are Spark ML estimators on an assembled feature vector.  Per-meter
models are fitted on filtered views of one cached frame; metrics are SQL
aggregates, so they are exact and distributed.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions.split import split_bucket
from wattlake.operators import boosting
from wattlake.operators.boosting import BoostedTrees

FEATURES_COL = "features"


# ----------------------------------------------------------------- splits

def assign_split(df: DataFrame, key: str = "row_id", ratios: Sequence[float] = (0.64, 0.16, 0.20),
                 names: Sequence[str] = ("train", "val", "test"), out: str = "split") -> DataFrame:
    """Deterministic split by a hash bucket of the key (0..99): the same row
    lands in the same part on every run and after any recomputation."""
    if abs(sum(ratios) - 1.0) > 1e-9:
        raise ValueError("ratios must sum to 1")
    b = split_bucket(F.col(key))
    edges = []
    acc = 0.0
    for r in ratios:
        acc += r
        edges.append(int(round(acc * 100)))
    expr = None
    for edge, name in zip(edges, names):
        expr = F.when(b < edge, F.lit(name)) if expr is None else expr.when(b < edge, F.lit(name))
    return df.withColumn(out, expr)


def fold_column(df: DataFrame, key: str = "row_id", folds: int = 8, out: str = "fold") -> DataFrame:
    return df.withColumn(out, F.pmod(split_bucket(F.col(key), 1_000_003), F.lit(folds)).cast("int"))


def split_xy(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    return df.drop(target), df.select(target)


# ---------------------------------------------------------------- metrics

def rmsle(df: DataFrame, label: str, pred: str, by: Sequence[str] = (), scale: str = "raw") -> DataFrame:
    """sqrt(mean((log1p(y) - log1p(p))^2)) and the MSLE, per group.
    ``scale='log'`` treats y and p as already log1p-transformed."""
    y, p = F.col(label), F.col(pred)
    d = (y - p) if scale == "log" else (F.log1p(y) - F.log1p(p))
    g = df.groupBy(*by) if by else df
    return g.agg(F.avg(d * d).alias("msle"), F.sqrt(F.avg(d * d)).alias("rmsle"), F.count(d).alias("n"))


def r2(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """1 - SSE/SST per group (two aggregates: mean, then sums)."""
    y, p = F.col(label), F.col(pred)
    rows = df.where(y.isNotNull() & p.isNotNull())
    if by:
        m = rows.groupBy(*by).agg(F.avg(label).alias("__ym"))
        j = rows.join(m, list(by), "left")
        g = j.groupBy(*by)
    else:
        j = rows.withColumn("__ym", rows.select(F.avg(label)).scalar())
        g = j
    return g.agg((1 - F.sum((y - p) ** 2) / F.sum((y - F.col("__ym")) ** 2)).alias("r2"))


# ----------------------------------------------------------------- models

def assembler(feats: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(feats), outputCol=FEATURES_COL, handleInvalid="keep")


def lasso(feats: Sequence[str], label: str, alpha: float, max_iter: int = 100) -> Pipeline:
    """L1 regression with the objective 1/(2n)||y - Xw||^2 + alpha ||w||_1
    (no feature standardisation inside the solver)."""
    lr = LinearRegression(featuresCol=FEATURES_COL, labelCol=label, elasticNetParam=1.0, regParam=alpha,
                          standardization=False, maxIter=max_iter)
    return Pipeline(stages=[assembler(feats), lr])


# boosted-tree parameter profiles (re-aimed from two external boosters): the full budgets of rounds, ended early by
# ``patience`` rounds without a better validation error
GBT_PROFILES = {
    "a": dict(maxIter=10_000, stepSize=0.1, maxDepth=6, minInstancesPerNode=20, subsamplingRate=0.8,
              featureSubsetStrategy="0.8", patience=20),
    "b": dict(maxIter=1_000, stepSize=0.15, maxDepth=8, minInstancesPerNode=10, subsamplingRate=0.9,
              featureSubsetStrategy="all", patience=10),
}


def gbt(feats: Sequence[str], label: str, profile: str | dict = "a", validation_col: str | None = None,
        seed: int = 42) -> Pipeline:
    """Boosted trees of a profile.  Rows flagged in ``validation_col`` end them early; without, all rounds run."""
    params = dict(GBT_PROFILES[profile]) if isinstance(profile, str) else dict(profile)
    return Pipeline(stages=[assembler(feats), BoostedTrees(feats, FEATURES_COL, label, validation_col, seed, **params)])


def fit_by_group(df: DataFrame, make: Callable[[], Pipeline], by: str = "meter",
                 groups: Sequence | None = None, parallelism: int = 4) -> dict:
    """One model per group (meter type), fitted on filtered views of the
    cached input; group fits run concurrently from a driver thread pool."""
    if groups is None:
        groups = [r[0] for r in df.select(by).distinct().orderBy(by).collect()]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        models = list(ex.map(lambda g: make().fit(df.where(F.col(by) == g)), groups))
    return dict(zip(groups, models))


def predict_by_group(df: DataFrame, models: dict, by: str = "meter", pred: str = "prediction",
                     clip_at_zero: bool = True) -> DataFrame:
    """Score every group with its own model and reassemble (union).

    Rows of a group without a model (or with a null group) stay, with a null
    prediction."""
    unknown = df.where(~F.coalesce(F.col(by).isin(list(models)), F.lit(False)))
    parts = [unknown.withColumn(pred, F.lit(None).cast("double"))]
    for g, m in models.items():
        out = m.transform(df.where(F.col(by) == g)).drop(FEATURES_COL)
        if clip_at_zero:
            out = out.withColumn(pred, F.when(F.col(pred) < 0, F.lit(0.0)).otherwise(F.col(pred)))
        parts.append(out)
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p, allowMissingColumns=True)
    return res


# ----------------------------------------------------------------- tuning

def cross_validate(df: DataFrame, make: Callable[[], Pipeline], label: str, folds: int = 8,
                   fold_col: str = "fold", pred: str = "prediction", scale: str = "log",
                   parallelism: int = 4) -> DataFrame:
    """Per-fold MSLE of one setting (fold column from the row-id hash)."""
    spark = df.sparkSession

    def one(k):
        m = make().fit(df.where(F.col(fold_col) != k))
        s = rmsle(m.transform(df.where(F.col(fold_col) == k)), label, pred, scale=scale).first()
        return (k, float(s["msle"]), float(s["rmsle"]))

    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        rows = list(ex.map(one, range(folds)))
    return spark.createDataFrame(rows, "fold int, msle double, rmsle double")


def grid_search(df: DataFrame, feats: Sequence[str], label: str, alphas: Sequence[float], folds: int = 8,
                fold_col: str = "fold", parallelism: int = 8) -> DataFrame:
    """Lasso alpha grid x k folds: mean and std of the fold MSLE per alpha,
    ranked (best first).  All fits run from one driver thread pool."""
    spark = df.sparkSession
    tasks = [(a, k) for a in alphas for k in range(folds)]

    def one(t):
        a, k = t
        m = lasso(feats, label, a).fit(df.where(F.col(fold_col) != k))
        s = rmsle(m.transform(df.where(F.col(fold_col) == k)), label, "prediction", scale="log").first()
        return (float(a), k, float(s["msle"]))

    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        rows = list(ex.map(one, tasks))
    # the fold scores are already driver-side Python values (one per fit)
    import statistics
    summary = []
    for a in alphas:
        v = [m for (al, _, m) in rows if al == float(a)]
        summary.append((float(a), statistics.fmean(v), statistics.pstdev(v)))
    order = sorted(range(len(summary)), key=lambda i: (summary[i][1], i))
    rank = {i: r + 1 for r, i in enumerate(order)}
    return spark.createDataFrame([s + (rank[i],) for i, s in enumerate(summary)],
                                 "alpha double, mean_msle double, std_msle double, rank int")


def sample_params(space: dict, n_trials: int, seed: int = 42) -> list[dict]:
    """Random parameter maps: ('loguniform', lo, hi), ('uniform', lo, hi),
    ('int', lo, hi) or ('choice', [values])."""
    rng = random.Random(seed)
    out = []
    for _ in range(n_trials):
        p = {}
        for k, spec in space.items():
            kind = spec[0]
            if kind == "loguniform":
                p[k] = math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2])))
            elif kind == "uniform":
                p[k] = rng.uniform(spec[1], spec[2])
            elif kind == "int":
                p[k] = rng.randint(spec[1], spec[2])
            elif kind == "choice":
                p[k] = rng.choice(spec[1])
            else:
                raise ValueError(kind)
        out.append(p)
    return out


GBT_SPACE = {"stepSize": ("loguniform", 0.01, 0.3), "maxDepth": ("int", 2, 10),
             "minInstancesPerNode": ("int", 1, 100), "subsamplingRate": ("uniform", 0.4, 1.0),
             "featureSubsetStrategy": ("choice", ["0.4", "0.6", "0.8", "all"])}


def random_search(train: DataFrame, val: DataFrame, feats: Sequence[str], label: str, space: dict | None = None,
                  n_trials: int = 50, max_iter: int = 5_000, seed: int = 42, patience: int = 10) -> DataFrame:
    """Sampled GBT settings, each trained on ``train`` up to its best round on ``val`` (``patience`` rounds without a
    better one end it) and scored there by MSLE (log-scale labels); results ranked best first.  The rows become bins
    once for all trials, and the trials grow side by side."""
    spark = train.sparkSession
    trials = sample_params(space or GBT_SPACE, n_trials, seed)
    rows = (train.select(*feats, label).withColumn("__held_out", F.lit(False))
            .unionByName(val.select(*feats, label).withColumn("__held_out", F.lit(True)))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        data = boosting.prepare(rows, feats, label, "__held_out")
    finally:
        rows.unpersist()
    if not data.val_rows:
        raise ValueError("no validation rows")
    grown = boosting.boost(data, [boosting.setting(len(feats), seed, maxIter=max_iter, patience=patience, **p) for p in trials], keep=False)
    rows = [(i, str(sorted(p.items())), b.errors[b.best - 1]) for i, (p, b) in enumerate(zip(trials, grown))]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][2], rows[i][0]))
    rank = {i: r + 1 for r, i in enumerate(order)}
    return spark.createDataFrame([r + (rank[i],) for i, r in enumerate(rows)],
                                 "trial int, params string, msle double, rank int")


# ------------------------------------------------------ feature selection

def select_by_l1(df: DataFrame, feats: Sequence[str], label: str, alpha: float = 1.0,
                 threshold: float = 1e-5) -> list[str]:
    model = lasso(feats, label, alpha).fit(df)
    coef = model.stages[-1].coefficients.toArray()
    return [f for f, c in zip(feats, coef) if abs(c) >= threshold]


def select_by_importance(df: DataFrame, feats: Sequence[str], label: str, kind: str = "tree",
                         seed: int = 42) -> list[str]:
    """Features whose importance is at least the mean importance."""
    if kind == "tree":
        est = DecisionTreeRegressor(featuresCol=FEATURES_COL, labelCol=label, seed=seed)
    else:
        est = GBTRegressor(featuresCol=FEATURES_COL, labelCol=label, maxIter=20, seed=seed)
    model = Pipeline(stages=[assembler(feats), est]).fit(df)
    imp = model.stages[-1].featureImportances.toArray()
    mean = float(imp.mean()) if len(imp) else 0.0
    return [f for f, v in zip(feats, imp) if v >= mean]


def recursive_elimination(df: DataFrame, feats: Sequence[str], label: str, n_keep: int | None = None,
                          kind: str = "l1", alpha: float = 1e-3, seed: int = 42) -> list[str]:
    """Drop the weakest feature (|coef| or importance) until n_keep remain
    (default half).  One Spark fit per step on the cached input."""
    keep = list(feats)
    n_keep = n_keep or max(1, len(keep) // 2)
    while len(keep) > n_keep:
        if kind == "l1":
            m = lasso(keep, label, alpha).fit(df)
            w = [abs(x) for x in m.stages[-1].coefficients.toArray()]
        else:
            est = DecisionTreeRegressor(featuresCol=FEATURES_COL, labelCol=label, seed=seed)
            m = Pipeline(stages=[assembler(keep), est]).fit(df)
            w = list(m.stages[-1].featureImportances.toArray())
        keep.pop(min(range(len(keep)), key=lambda i: (w[i], i)))
    return keep


def selection_votes(selections: DataFrame, all_feats: DataFrame) -> DataFrame:
    """(feature, votes): how many methods chose each feature; features no
    method chose get 0.  ``selections`` is long form (method, feature)."""
    votes = selections.select("method", "feature").distinct().groupBy("feature").agg(F.count("*").alias("votes"))
    return all_feats.select("feature").distinct().join(votes, "feature", "left").na.fill(0, ["votes"])


# ----------------------------------------------------------------- PCA

def pca(df: DataFrame, feats: Sequence[str], k: int):
    from pyspark.ml.feature import PCA
    m = Pipeline(stages=[assembler(feats), PCA(k=k, inputCol=FEATURES_COL, outputCol="pca")]).fit(df)
    return m


def pca_by_variance(df: DataFrame, feats: Sequence[str], share: float = 0.9) -> tuple[int, list]:
    """Smallest k whose cumulative explained variance reaches ``share``."""
    m = pca(df, feats, len(feats))
    ev = list(m.stages[-1].explainedVariance.toArray())
    acc = 0.0
    for i, v in enumerate(ev):
        acc += v
        if acc >= share - 1e-12:
            return i + 1, ev
    return len(ev), ev
