"""Pipeline stages of the library's own: a scaler and a decision that are saved and loaded with the model between them."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from .calibration import Sigmoids
from .scoring import PROBABILITY, decide, linear_score

#: Columns that Spark ML models leave behind.
LEFT_OVER = ("features", "rawPrediction", "probability", "prediction")


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    def _with(self, given: dict):
        self._set(**{k: v for k, v in given.items() if v is not None})


class ColumnScaler(_Stage):
    """Columns minus their mean, divided by their spread; a spread of zero only centres."""

    columns = Param(Params._dummy(), "columns", "columns to scale", TypeConverters.toListString)
    means = Param(Params._dummy(), "means", "their means", TypeConverters.toListFloat)
    spreads = Param(Params._dummy(), "spreads", "their standard deviations", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, columns=None, means=None, spreads=None):
        super().__init__()
        self._with(self._input_kwargs)

    @classmethod
    def fitted(cls, stats: DataFrame) -> ColumnScaler:
        """From the statistics of ``prepare.scale_fit``, one row a column; a column without any is left as it is."""
        rows = stats.collect()
        return cls(columns=[r["feature"] for r in rows], means=[float(r["mean"] or 0.0) for r in rows], spreads=[float(r["std"] or 0.0) for r in rows])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        given = zip(*(self.getOrDefault(p) for p in ("columns", "means", "spreads")))
        return dataset.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s or 1.0) for c, m, s in given})


class LinearProbability(_Stage):
    """The probability of a logistic model given as weights, as a plain expression."""

    columns = Param(Params._dummy(), "columns", "features", TypeConverters.toListString)
    weights = Param(Params._dummy(), "weights", "their weights", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "the intercept", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, columns=None, weights=None, intercept=None):
        super().__init__()
        self._with(self._input_kwargs)

    def getInputCols(self) -> list[str]:
        return self.getOrDefault("columns")

    @property
    def coefficients(self):
        from pyspark.ml.linalg import Vectors
        return Vectors.dense(self.getOrDefault("weights"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = dict(zip(self.getOrDefault("columns"), self.getOrDefault("weights")))
        return dataset.withColumn(PROBABILITY, linear_score(weights, self.getOrDefault("intercept")))


class Decision(_Stage):
    """The positive class's probability, calibrated if there are sigmoids, and the decision at a threshold.

    Reads the probability vector of a Spark ML model or, without one, a column of probabilities.
    """

    slopes = Param(Params._dummy(), "slopes", "slopes of the sigmoids, none if not calibrated", TypeConverters.toListFloat)
    intercepts = Param(Params._dummy(), "intercepts", "their intercepts", TypeConverters.toListFloat)
    threshold = Param(Params._dummy(), "threshold", "probability from which the decision is 1", TypeConverters.toFloat)
    model = Param(Params._dummy(), "model", "name of the model", TypeConverters.toString)

    @keyword_only
    def __init__(self, slopes=None, intercepts=None, threshold=None, model=None):
        super().__init__()
        self._setDefault(slopes=[], intercepts=[], threshold=0.5, model="")
        self._with(self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        raw = vector_to_array("probability")[1] if "probability" in dataset.columns else F.col(PROBABILITY)
        pairs = list(zip(self.getOrDefault("slopes"), self.getOrDefault("intercepts")))
        value = Sigmoids(pairs).average(raw) if pairs else raw
        return decide(dataset.withColumn(PROBABILITY, value).drop(*LEFT_OVER), self.getOrDefault("threshold"))
