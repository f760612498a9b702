"""Classifiers and cross-validation on Spark ML."""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import freeze
from .metrics import (
    DEFAULT_THRESHOLD, average_precision, binary_metrics, evaluate_models, roc_auc, score_curve,
)
from .logistic import fit_newton
from .prepare import fold_assign
from .resample import rebalance
from .scoring import PROBABILITY, model_score
from .stages import LinearProbability

# Default settings of the three models.
DEFAULTS = {
    "logistic_regression": {"C": 1.0, "max_iter": 1000},
    "random_forest": {"n_estimators": 100, "max_depth": 10, "random_state": 42},
    "gradient_boosting": {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1, "random_state": 42},
}
PARALLELISM = 4  # fits at a time
DEEPEST = 30  # Spark ML's limit, used where no depth limit is asked for


def tree_depth(depth: int | None) -> int:
    """Spark ML's depth for a requested one: None is its limit, more than that cannot be built."""
    if depth is not None and depth > DEEPEST:
        raise ValueError(f"trees deeper than {DEEPEST} cannot be built")
    return DEEPEST if depth is None else int(depth)


def logistic_regression(params: dict, label: str, rows: int, weight: str | None = None) -> LogisticRegression:
    """C is the inverse penalty of the summed loss; Spark averages the loss, hence 1 / (C * rows)."""
    penalty = params.get("penalty", "l2")
    mix = {"l2": 0.0, "l1": 1.0}.get(penalty, params.get("l1_ratio", 0.5))
    est = LogisticRegression(
        featuresCol="features", labelCol=label, maxIter=int(params.get("max_iter", 1000)), standardization=False,
        regParam=1.0 / (float(params.get("C", 1.0)) * max(rows, 1)), elasticNetParam=float(mix))
    return est.setWeightCol(weight) if weight else est


def random_forest(params: dict, label: str, rows: int, weight: str | None = None) -> RandomForestClassifier:
    subset = params.get("max_features", "sqrt")
    est = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=int(params.get("n_estimators", 100)),
        maxDepth=tree_depth(params.get("max_depth", 10)), seed=int(params.get("random_state", 42)),
        featureSubsetStrategy="all" if subset is None else str(subset),
        minInstancesPerNode=int(params.get("min_samples_leaf", 1)))
    return est.setWeightCol(weight) if weight else est


def gradient_boosting(params: dict, label: str, rows: int, weight: str | None = None) -> GBTClassifier:
    est = GBTClassifier(
        featuresCol="features", labelCol=label, maxIter=int(params.get("n_estimators", 100)),
        maxDepth=tree_depth(params.get("max_depth", 6)), stepSize=float(params.get("learning_rate", 0.1)),
        seed=int(params.get("random_state", 42)))
    return est.setWeightCol(weight) if weight else est


REGISTRY = {
    "logistic_regression": logistic_regression,
    "random_forest": random_forest,
    "gradient_boosting": gradient_boosting,
}


def fit_model(df: DataFrame, name: str, features: list[str], label: str, params: dict | None = None,
              weight: str | None = None) -> PipelineModel:
    """Fit a model by name over already scaled columns; an unknown name is an error.

    Logistic regression with ``solver`` "newton" is fitted to full precision (L2 penalty only); the default is Spark ML's own.
    """
    if name not in REGISTRY:
        raise ValueError(f"unknown model {name!r}: use one of {sorted(REGISTRY)}")
    settings = {**DEFAULTS[name], **(params or {})}
    if name == "logistic_regression" and settings.get("solver") == "newton":
        if settings.get("penalty", "l2") != "l2":
            raise ValueError("Newton steps need the l2 penalty")
        weights, intercept = fit_newton(df, features, label, float(settings["C"]), weight)
        return PipelineModel([LinearProbability(columns=features, weights=weights, intercept=intercept)])
    rows = df.count() if name == "logistic_regression" else 0
    estimator = REGISTRY[name](settings, label, rows, weight)
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    return Pipeline(stages=[assembler, estimator]).fit(df)


def importances(model: PipelineModel, features: list[str]) -> DataFrame:
    """Rows ``(feature, importance)``: importances of trees, coefficients of a linear model."""
    last = model.stages[-1]
    values = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    return SparkSession.getActiveSession().createDataFrame(
        [(f, float(v)) for f, v in zip(features, values.toArray())], "feature string, importance double")


def model_info(model: PipelineModel, name: str) -> DataFrame:
    """Rows ``(name, type, parameter, value)`` describing a fitted model."""
    last = model.stages[-1]
    rows = [(name, type(last).__name__, p.name, str(last.getOrDefault(p)))
            for p in last.params if last.isDefined(p)]
    return SparkSession.getActiveSession().createDataFrame(rows, "name string, type string, parameter string, value string")


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def list_models(spark: SparkSession, folder: str) -> DataFrame:
    """Rows ``(name)``: the models saved below a folder of any file system Spark can reach."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(path)
             if s.isDirectory() and system.exists(hadoop.Path(s.getPath(), "metadata"))]
    return spark.createDataFrame([(n,) for n in sorted(names)], "name string")


# ---- training several models, cross-validation ---------------------------------------

def scored_rows(df: DataFrame, model: PipelineModel, name: str, key: str, label: str) -> DataFrame:
    """Rows ``(model, key, label, score)``."""
    return model_score(df.select(*_inputs(model), key, label), model).select(
        F.lit(name).alias("model"), F.col(key).alias("key"), F.col(label).alias("label"),
        F.col(PROBABILITY).alias("score"))


def _inputs(model: PipelineModel) -> list[str]:
    return model.stages[0].getInputCols()


def train_all(train: DataFrame, test: DataFrame, names: list[str], features: list[str], key: str, label: str,
              params: dict[str, dict] | None = None, weight: str | None = None) -> tuple[dict, DataFrame]:
    """``(models, results)``; a model that fails to fit becomes a row with ``error`` and the rest go on."""
    models, errors = {}, []
    for name in names:
        try:
            models[name] = fit_model(train, name, features, label, (params or {}).get(name), weight)
        except Exception as e:  # recorded per model, by design
            errors.append((name, str(e).splitlines()[0]))
    failed = train.sparkSession.createDataFrame(errors, "model string, error string")
    if not models:
        return models, failed
    scored = freeze(_union([scored_rows(test, m, n, key, label) for n, m in models.items()]), "scored")
    results = evaluate_models(scored, "label", "score").withColumn("error", F.lit(None).cast("string"))
    return models, results.unionByName(failed, allowMissingColumns=True)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def fold_parts(df: DataFrame, features: list[str], key: str, label: str, folds: int = 5, seed: int = 42,
               strategy: str = "none") -> list[tuple[DataFrame, DataFrame]]:
    """``(training part, held-out part)`` per fold, written once so that every model or trial reuses them.

    Rebalancing is applied to the training part only.
    """
    split = freeze(fold_assign(df.select(key, label, *features), key, label, folds, seed), "folds")

    def part(j):
        train = rebalance(split.where(F.col("fold") != j).drop("fold"), strategy, key, label, features, seed)
        return train if strategy == "none" else freeze(train, "train"), split.where(F.col("fold") == j)

    return at_once(df.sparkSession, part, range(folds))


def at_once(spark: SparkSession, work, items, parallelism: int = PARALLELISM) -> list:
    """Run independent jobs side by side, so that small ones do not leave the cluster idle."""
    with ThreadPool(parallelism) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)


def out_of_fold(parts: list[tuple[DataFrame, DataFrame]], name: str, features: list[str], key: str, label: str,
                params: dict | None = None) -> DataFrame:
    """Rows ``(model, key, label, score)`` with ``model`` the fold: each row scored by a model that never saw it."""
    def score(j):
        train, held_out = parts[j]
        weight = "weight" if "weight" in train.columns else None
        model = fit_model(train, name, features, label, params, weight)
        return scored_rows(held_out, model, str(j), key, label)

    return _union(at_once(parts[0][0].sparkSession, score, range(len(parts))))


def cross_validate(df: DataFrame, name: str, features: list[str], key: str, label: str, folds: int = 5,
                   seed: int = 42, params: dict | None = None, strategy: str = "none") -> DataFrame:
    """Rows ``(model, metric, mean, std)`` over the folds; one fit per fold serves every metric."""
    return cross_validate_parts(fold_parts(df, features, key, label, folds, seed, strategy), name, features, key,
                                label, params)


def cross_validate_parts(parts, name: str, features: list[str], key: str, label: str,
                         params: dict | None = None) -> DataFrame:
    scored = freeze(out_of_fold(parts, name, features, key, label, params), "oof")
    return cv_summary(scored).withColumn("model", F.lit(name)).select("model", "metric", "mean", "std")


def cv_summary(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows ``([by,] metric, mean, std)`` of PR-AUC, ROC-AUC and F1 over the folds in ``scored``."""
    by = list(by or [])
    fold = [*by, "model"]
    curve = score_curve(scored, "label", "score", fold)
    decided = scored.withColumn("_p", (F.col("score") >= DEFAULT_THRESHOLD).cast("int"))
    per_fold = average_precision(curve, fold).join(roc_auc(curve, fold), fold).join(
        binary_metrics(decided, "label", "_p", by=fold).select(*fold, "f1"), fold)
    long = per_fold.select(*by, F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in ("pr_auc", "roc_auc", "f1")])))
    return long.groupBy(*by, "metric").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))

