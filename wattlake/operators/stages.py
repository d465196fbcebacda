"""The three group encoders as Spark ML stages, fitted from one grouped table.

``fit`` reads the training rows once: one aggregate per (group, categories)
with row counts, target sums and the moments of the numeric columns.  Rare
labels, category means and scales are all derived from that table, whose size
is the number of distinct category combinations, not of rows:

* a category's share is a sum of counts;
* the mean target of a label is a sum of target sums over counts;
* means and variances combine by Chan's rule (count, mean, squared deviations),
  without a difference of large numbers.

Models are ``pyspark.ml`` models: they sit in a ``PipelineModel`` next to an
assembler and a regressor, and are saved and loaded with it (parameters as JSON,
state as Parquet).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.constants import RARE_LABEL, RARE_MIN_CATEGORIES, RARE_TOL
from wattlake.operators import encoders as enc
from wattlake.operators.numbering import numbered
from wattlake.session import ensure_checkpoint_dir


class GroupParams(Params):
    """Columns shared by the stages: what to encode, the groups, the target and the rare-label limits."""

    catCols = Param(Params._dummy(), "catCols", "categorical columns", TypeConverters.toListString)
    numCols = Param(Params._dummy(), "numCols", "numeric columns", TypeConverters.toListString)
    by = Param(Params._dummy(), "by", "group columns, one set of encoders each", TypeConverters.toListString)
    target = Param(Params._dummy(), "target", "target column", TypeConverters.toString)
    tol = Param(Params._dummy(), "tol", "share of rows below which a category is rare", TypeConverters.toFloat)
    minCategories = Param(Params._dummy(), "minCategories", "no rare labels with this many categories or fewer",
                          TypeConverters.toInt)
    label = Param(Params._dummy(), "label", "label of rare categories", TypeConverters.toString)
    stateRows = Param(Params._dummy(), "stateRows", "rows of the fitted state", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(catCols=[], numCols=[], by=["meter"], target="meter_reading", tol=RARE_TOL,
                         minCategories=RARE_MIN_CATEGORIES, label=RARE_LABEL, stateRows=0)

    def get(self, name: str):
        return self.getOrDefault(self.getParam(name))


# ------------------------------------------------------------------ models

class _StateWriter(MLWriter):
    def __init__(self, instance: "GroupModel"):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.state.write.parquet(f"{path.rstrip('/')}/state")


class _StateReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> "GroupModel":
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(self.sparkSession.read.parquet(f"{path.rstrip('/')}/state"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class GroupModel(Model, GroupParams, MLReadable, MLWritable):
    """A fitted stage: parameters and a small state table."""

    def __init__(self, state: DataFrame | None = None):
        super().__init__()
        self.state = state

    def copy(self, extra=None):
        that = super().copy(extra)
        that.state = self.state
        return that

    def write(self) -> MLWriter:
        return _StateWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StateReader(cls)


class RareLabelModel(GroupModel):
    """Categories that were rare in the group, or not seen, become the rare label."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return enc.RareLabelModel(self.state, self.get("stateRows"), self.get("catCols"), self.get("by"),
                                  self.get("label")).transform(dataset)


class MeanTargetModel(GroupModel):
    """Categories become the mean target of their group's training rows; unseen ones NULL."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return enc.MeanTargetModel(self.state, self.get("stateRows"), self.get("catCols"), self.get("by")).transform(dataset)


class ScalerModel(GroupModel):
    """(x - mean) / population std of the group; a zero std scales by 1."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = self.get("catCols") + self.get("numCols")
        return enc.ScalerModel(self.state, self.get("stateRows"), cols, self.get("by")).transform(dataset)


# ------------------------------------------------------------------ the shared table

def group_table(df: DataFrame, by: Sequence[str], cats: Sequence[str], nums: Sequence[str], target: str) -> DataFrame:
    """One row per (group, categories): ``__n`` rows, ``__yn`` / ``__ys`` count and sum of the target, and per numeric
    column its count, mean and population variance (``__c{i}``, ``__m{i}``, ``__v{i}``)."""
    aggs = [F.count(F.lit(1)).alias("__n"), F.count(target).alias("__yn"), F.sum(F.col(target).cast("double")).alias("__ys")]
    for i, c in enumerate(nums):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"__c{i}"), F.avg(x).alias(f"__m{i}"), F.var_pop(x).alias(f"__v{i}")]
    return df.groupBy(*by, *[F.col(c).cast("string").alias(c) for c in cats]).agg(*aggs)


def _held(df: DataFrame) -> tuple[DataFrame, int]:
    """A small table written to the shared checkpoint folder (the lineage ends there), with its rows."""
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    return df, df.count()


def rare_state(table: DataFrame, by: Sequence[str], cats: Sequence[str], tol: float, min_categories: int) -> DataFrame:
    """(group, variable, category) of the categories to keep."""
    long = table.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("category"),
                                                        F.col("__n").alias("n")) for c in cats])))
    counts = long.where(F.col("category").isNotNull()).groupBy(*by, "variable", "category").agg(F.sum("n").alias("n"))
    totals = counts.groupBy(*by, "variable").agg(F.sum("n").alias("total"), F.count("*").alias("n_cats"))
    cond = None
    renamed = totals.withColumnsRenamed({b: f"__t_{b}" for b in by} | {"variable": "__t_variable"})
    for b in [*by, "variable"]:
        c = F.col(b).eqNullSafe(F.col(f"__t_{b}"))
        cond = c if cond is None else cond & c
    kept = counts.join(renamed, cond).where((F.col("n_cats") <= min_categories) | (F.col("n") / F.col("total") >= tol))
    return kept.select(*by, "variable", "category")


def mean_state(table: DataFrame, by: Sequence[str], cats: Sequence[str]) -> DataFrame:
    """(group, variable, category, mean) of a table whose categories are labelled already."""
    long = table.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("category"),
                                                        F.col("__yn").alias("n"), F.col("__ys").alias("s")) for c in cats])))
    return long.groupBy(*by, "variable", "category").agg(F.try_divide(F.sum("s"), F.sum("n")).alias("mean"))


def scaler_state(table: DataFrame, by: Sequence[str], cats: Sequence[str], nums: Sequence[str]) -> DataFrame:
    """(group, variable, mean, scale) of a table whose categories are encoded as numbers."""
    parts = [F.struct(F.lit(c).alias("variable"), F.when(F.col(c).isNotNull(), F.col("__n")).otherwise(0).alias("n"),
                      F.col(c).cast("double").alias("m"), F.lit(0.0).alias("v")) for c in cats]
    parts += [F.struct(F.lit(c).alias("variable"), F.col(f"__c{i}").alias("n"), F.col(f"__m{i}").alias("m"),
                       F.col(f"__v{i}").alias("v")) for i, c in enumerate(nums)]
    long = table.select(*by, F.inline(F.array(*parts)))
    means = long.groupBy(*by, "variable").agg(F.try_divide(F.sum(F.col("n") * F.col("m")), F.sum("n")).alias("mean"))
    renamed = means.withColumnsRenamed({b: f"__t_{b}" for b in by} | {"variable": "__t_variable"})
    cond = None
    for b in [*by, "variable"]:
        c = F.col(b).eqNullSafe(F.col(f"__t_{b}"))
        cond = c if cond is None else cond & c
    dev = F.col("n") * (F.col("v") + (F.col("m") - F.col("mean")) * (F.col("m") - F.col("mean")))
    std = F.sqrt(F.try_divide(F.sum(dev), F.sum("n")))
    return (long.join(renamed, cond).groupBy(*by, "variable").agg(F.first("mean").alias("mean"), std.alias("__std"))
            .select(*by, "variable", "mean", F.when(F.col("__std") == 0, 1.0).otherwise(F.col("__std")).alias("scale")))


# ------------------------------------------------------------------ estimators

class _GroupEstimator(Estimator, GroupParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, catCols=(), numCols=(), by=("meter",), target="meter_reading", tol=RARE_TOL,
                 minCategories=RARE_MIN_CATEGORIES, label=RARE_LABEL):
        super().__init__()
        given = {k: list(v) if isinstance(v, tuple) else v for k, v in self._input_kwargs.items()}
        self._set(**given)

    def _table(self, dataset: DataFrame) -> DataFrame:
        return group_table(dataset, self.get("by"), self.get("catCols"), self.get("numCols"), self.get("target"))

    def _model(self, cls, state: DataFrame) -> GroupModel:
        state, rows = _held(state)
        model = self._copyValues(cls(state))
        return model._set(stateRows=rows)


class RareLabelEstimator(_GroupEstimator):
    def _fit(self, dataset: DataFrame) -> RareLabelModel:
        return self._from(self._table(dataset))

    def _from(self, table: DataFrame) -> RareLabelModel:
        return self._model(RareLabelModel, rare_state(table, self.get("by"), self.get("catCols"), self.get("tol"),
                                                      self.get("minCategories")))


class MeanTargetEstimator(_GroupEstimator):
    def _fit(self, dataset: DataFrame) -> MeanTargetModel:
        return self._from(self._table(dataset))

    def _from(self, table: DataFrame) -> MeanTargetModel:
        return self._model(MeanTargetModel, mean_state(table, self.get("by"), self.get("catCols")))


class ScalerEstimator(_GroupEstimator):
    """Scales ``catCols`` (numbers by now) and ``numCols``."""

    def _fit(self, dataset: DataFrame) -> ScalerModel:
        cols = self.get("catCols") + self.get("numCols")
        return self._model(ScalerModel, scaler_state(group_table(dataset, self.get("by"), [], cols, self.get("target")),
                                                     self.get("by"), [], cols))

    def _from(self, table: DataFrame) -> ScalerModel:
        return self._model(ScalerModel, scaler_state(table, self.get("by"), self.get("catCols"), self.get("numCols")))


class FeatureEncoder(_GroupEstimator):
    """Rare labels, then category means, then scales: a ``PipelineModel`` of the three, from one read of the rows.

    Equal to fitting the three estimators one after the other, each on the output of the one before."""

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        given = {p: self.get(p) for p in ("catCols", "numCols", "by", "target", "tol", "minCategories", "label")}
        table, _ = _held(self._table(dataset))
        rare = RareLabelEstimator(**given)._from(table)
        labelled = rare.transform(table)
        mean = MeanTargetEstimator(**given)._from(labelled)
        return PipelineModel([rare, mean, ScalerEstimator(**given)._from(mean.transform(labelled))])


# ------------------------------------------------------------------ one-hot vectors by a stored dictionary

class DictionaryParams(Params):
    inputCol = Param(Params._dummy(), "inputCol", "categorical column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "sparse vector column", TypeConverters.toString)
    maxCategories = Param(Params._dummy(), "maxCategories", "largest dictionary; more categories are an error", TypeConverters.toInt)
    handleUnseen = Param(Params._dummy(), "handleUnseen", "error, or keep: one more slot for NULL and unseen values",
                         TypeConverters.toString)
    size = Param(Params._dummy(), "size", "categories of the dictionary", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(outputCol="one_hot", maxCategories=100_000, handleUnseen="error", size=0)

    def get(self, name: str):
        return self.getOrDefault(self.getParam(name))


class DictionaryModel(Model, DictionaryParams, MLReadable, MLWritable):
    """Categories in order, numbered from 0; a value becomes a sparse vector with a one in its slot.  No column per value
    and no list of values on the driver: the dictionary is a table."""

    def __init__(self, state: DataFrame | None = None):
        super().__init__()
        self.state = state

    def copy(self, extra=None):
        that = super().copy(extra)
        that.state = self.state
        return that

    def write(self) -> MLWriter:
        return _StateWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StateReader(cls)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        n, col = self.get("size"), self.get("inputCol")
        numbers = self.state.select(F.col("category").alias("__category"), F.col("index").cast("double").alias("__index"))
        j = dataset.join(enc.sized_broadcast(numbers, n), F.col(col).cast("string") == F.col("__category"), "left")
        if self.get("handleUnseen") == "keep":
            slot, width = F.coalesce("__index", F.lit(float(n))), n + 1
        else:
            problem = F.concat(F.lit(f"{col}: not in the dictionary: "), F.coalesce(F.col(col).cast("string"), F.lit("NULL")))
            slot, width = F.coalesce("__index", F.raise_error(problem).cast("double")), n
        slots = dataset.sparkSession.range(max(width, 1)).select(F.col("id").cast("double").alias("__slot"))
        hot = OneHotEncoder(inputCol="__slot", outputCol=self.get("outputCol"), dropLast=False).fit(slots)
        return hot.transform(j.withColumn("__slot", slot)).drop("__category", "__index", "__slot")


class DictionaryEstimator(Estimator, DictionaryParams, DefaultParamsReadable, DefaultParamsWritable):
    """Distinct non-null values of a column, numbered in string order; the count is checked before anything is written."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol="one_hot", maxCategories=100_000, handleUnseen="error"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> DictionaryModel:
        if self.get("handleUnseen") not in ("error", "keep"):
            raise ValueError("handleUnseen: error or keep")
        values = dataset.select(F.col(self.get("inputCol")).cast("string").alias("category")).where("category is not null").distinct()
        most = self.get("maxCategories")
        size = values.limit(most + 1).count()
        if size > most:
            raise ValueError(f"{self.get('inputCol')} has more than {most} categories")
        state, size = _held(numbered(values, [], ["category"], "index"))
        return self._copyValues(DictionaryModel(state))._set(size=size)
