"""Categorical encoders and scaling, fitted per group (meter type).

Each encoder's fitted state is a small DataFrame keyed by the group
columns, so the four per-meter fits of the modelled pipeline are ONE
grouped aggregate.  ``fit`` materialises the state (cache + count: the row
count is also the size check that decides whether ``transform`` broadcasts
it; beyond ``BROADCAST_MAX_ROWS`` the join stays a shuffle join).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.constants import RARE_LABEL, RARE_MIN_CATEGORIES, RARE_TOL

BROADCAST_MAX_ROWS = 2_000_000


def materialize(df: DataFrame) -> tuple[DataFrame, int]:
    """Cache a small fitted table and return it with its row count."""
    df = df.cache()
    return df, df.count()


def sized_broadcast(df: DataFrame, n_rows: int, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    return F.broadcast(df) if n_rows <= max_rows else df


def _by(by) -> list[str]:
    return [] if by is None else ([by] if isinstance(by, str) else list(by))


def _join_state(df: DataFrame, state: DataFrame, n_rows: int, on_df: list[Column], on_state: list[Column],
                ) -> DataFrame:
    cond = None
    for a, b in zip(on_df, on_state):
        c = a.eqNullSafe(b)
        cond = c if cond is None else cond & c
    return df.join(sized_broadcast(state, n_rows), cond, "left")


# ---------------------------------------------------------------------------

@dataclass
class RareLabelModel:
    state: DataFrame          # (by..., variable, category) kept categories
    n_rows: int
    cols: list
    by: list
    label: str = RARE_LABEL

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c in self.cols:
            s = (self.state.where(F.col("variable") == c)
                 .select(*[F.col(b).alias(f"__s_{b}") for b in self.by], F.col("category").alias("__kept")))
            out = _join_state(out, s, self.n_rows, [F.col(b) for b in self.by] + [F.col(c).cast("string")],
                              [F.col(f"__s_{b}") for b in self.by] + [F.col("__kept")])
            out = (out.withColumn(c, F.when(F.col("__kept").isNotNull(), F.col(c)).otherwise(F.lit(self.label)))
                   .drop("__kept", *[f"__s_{b}" for b in self.by]))
        return out


@dataclass
class RareLabelEncoder:
    """Categories whose share of the group's rows is below ``tol`` become
    'Rare' (only when the column has more than ``n_categories`` categories
    in the group; otherwise every seen category is kept).  Unseen categories
    become 'Rare' on transform."""
    cols: Sequence[str]
    tol: float = RARE_TOL
    n_categories: int = RARE_MIN_CATEGORIES
    by: Sequence[str] | str | None = ("meter",)

    def fit(self, df: DataFrame) -> RareLabelModel:
        by = _by(self.by)
        parts = []
        for c in self.cols:
            counts = (df.where(F.col(c).isNotNull()).groupBy(*by, F.col(c).cast("string").alias("category"))
                      .agg(F.count("*").alias("n")))
            if by:
                # one row per group (meter type): a size-proven broadcast
                totals = counts.groupBy(*by).agg(F.sum("n").alias("total"), F.count("*").alias("n_cats"))
                j = counts.join(F.broadcast(totals), by, "left")
            else:
                j = counts.withColumns({"total": counts.select(F.sum("n")).scalar(),
                                        "n_cats": counts.select(F.count("*")).scalar()})
            kept = j.where((F.col("n_cats") <= self.n_categories) | (F.col("n") / F.col("total") >= self.tol))
            parts.append(kept.select(*by, F.lit(c).alias("variable"), "category"))
        state = parts[0]
        for p in parts[1:]:
            state = state.unionByName(p)
        state, n = materialize(state)
        return RareLabelModel(state, n, list(self.cols), by)


@dataclass
class MeanTargetModel:
    state: DataFrame          # (by..., variable, category, mean)
    n_rows: int
    cols: list
    by: list

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c in self.cols:
            s = (self.state.where(F.col("variable") == c)
                 .select(*[F.col(b).alias(f"__s_{b}") for b in self.by], F.col("category").alias("__cat"),
                         F.col("mean").alias("__mean")))
            out = _join_state(out, s, self.n_rows, [F.col(b) for b in self.by] + [F.col(c).cast("string")],
                              [F.col(f"__s_{b}") for b in self.by] + [F.col("__cat")])
            out = out.withColumn(c, F.col("__mean")).drop("__cat", "__mean", *[f"__s_{b}" for b in self.by])
        return out


@dataclass
class MeanTargetEncoder:
    """Category -> mean target of the training rows in its group; unseen
    categories become NULL."""
    cols: Sequence[str]
    target: str
    by: Sequence[str] | str | None = ("meter",)

    def fit(self, df: DataFrame) -> MeanTargetModel:
        by = _by(self.by)
        parts = [df.groupBy(*by, F.col(c).cast("string").alias("category"))
                 .agg(F.avg(self.target).alias("mean")).select(*by, F.lit(c).alias("variable"), "category", "mean")
                 for c in self.cols]
        state = parts[0]
        for p in parts[1:]:
            state = state.unionByName(p)
        state, n = materialize(state)
        return MeanTargetModel(state, n, list(self.cols), by)


@dataclass
class ScalerModel:
    state: DataFrame          # (by..., variable, mean, scale)
    n_rows: int
    cols: list
    by: list

    def transform(self, df: DataFrame) -> DataFrame:
        wide = self.state.groupBy(*self.by).pivot("variable", self.cols).agg(
            F.first("mean").alias("m"), F.first("scale").alias("s"))
        ren = {f"{c}_m": f"__m_{c}" for c in self.cols} | {f"{c}_s": f"__s_{c}" for c in self.cols}
        wide = wide.withColumnsRenamed(ren)
        if self.by:
            out = df.join(sized_broadcast(wide, self.n_rows), self.by, "left")
        else:
            out = df.withColumns({k: wide.select(k).scalar() for k in ren.values()})
        out = out.withColumns({c: (F.col(c) - F.col(f"__m_{c}")) / F.col(f"__s_{c}") for c in self.cols})
        return out.drop(*ren.values())


@dataclass
class StandardScaler:
    """(x - mean) / std with the population std (ddof 0); a zero std
    scales by 1.  Fitted per group."""
    cols: Sequence[str]
    by: Sequence[str] | str | None = ("meter",)

    def fit(self, df: DataFrame) -> ScalerModel:
        by = _by(self.by)
        aggs = []
        for i, c in enumerate(self.cols):
            x = F.col(c).cast("double")
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
        agg = df.groupBy(*by).agg(*aggs)
        structs = [F.struct(F.lit(c).alias("variable"), F.col(f"m{i}").alias("mean"),
                            F.when(F.col(f"s{i}") == 0, F.lit(1.0)).otherwise(F.col(f"s{i}")).alias("scale"))
                   for i, c in enumerate(self.cols)]
        state = agg.select(*by, F.inline(F.array(*structs)))
        state, n = materialize(state)
        return ScalerModel(state, n, list(self.cols), by)


def category_list(df: DataFrame, col: str, max_categories: int) -> list:
    """The distinct non-null values in order; an error beyond ``max_categories`` (no more than that leaves the cluster)."""
    values = df.select(col).where(F.col(col).isNotNull()).distinct().limit(max_categories + 1).collect()
    if len(values) > max_categories:
        raise ValueError(f"{col} has more than {max_categories} categories")
    return sorted(r[0] for r in values)


def one_hot(df: DataFrame, col: str, categories: Sequence | None = None, drop: bool = True,
            max_categories: int = 1000) -> DataFrame:
    """One 0/1 column per category (``{col}_{category}``), for a small dictionary; ``stages.DictionaryEstimator`` makes
    sparse vectors for larger ones."""
    if categories is None:
        categories = category_list(df, col, max_categories)
    out = df.withColumns({f"{col}_{v}": (F.col(col) == F.lit(v)).cast("int") for v in categories})
    return out.drop(col) if drop else out


@dataclass
class FeatureEncoding:
    """rare-label -> mean-target -> standard scale, fitted per meter type."""
    rare: RareLabelModel
    mean: MeanTargetModel
    scaler: ScalerModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.scaler.transform(self.mean.transform(self.rare.transform(df)))

    def state_tables(self) -> dict:
        return {"rare": self.rare.state, "mean": self.mean.state, "scaler": self.scaler.state}


def fit_encoding(df: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str], target: str,
                 by: Sequence[str] | str | None = ("meter",), tol: float = RARE_TOL) -> FeatureEncoding:
    """Fit the three steps in order, each on the output of the previous one.
    Pass a materialised (checkpointed) frame: it is read three times."""
    rare = RareLabelEncoder(cat_cols, tol=tol, by=by).fit(df)
    d1 = rare.transform(df)
    mean = MeanTargetEncoder(cat_cols, target, by=by).fit(d1)
    d2 = mean.transform(d1)
    scaler = StandardScaler(list(cat_cols) + list(num_cols), by=by).fit(d2)
    return FeatureEncoding(rare, mean, scaler)


def load_encoding(spark, path: str, cat_cols, num_cols, by=("meter",)) -> FeatureEncoding:
    from wattlake.sources.state import load_state
    t = load_state(spark, path, ["rare", "mean", "scaler"])
    by = _by(by)
    r, nr = materialize(t["rare"])
    m, nm = materialize(t["mean"])
    s, ns = materialize(t["scaler"])
    return FeatureEncoding(RareLabelModel(r, nr, list(cat_cols), by), MeanTargetModel(m, nm, list(cat_cols), by),
                           ScalerModel(s, ns, list(cat_cols) + list(num_cols), by))
