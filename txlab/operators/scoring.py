"""Batch scoring with closed-form or fitted models, and what is reported about it."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import logistic, ratio
from .validate import failed_rules

PROBABILITY, DECISION, THRESHOLD = "fraud_probability", "fraud_decision", "threshold"


def linear_score(weights: dict[str, float], intercept: float = 0.0) -> Column:
    """Probability of a logistic model given as plain weights; runs inside code generation."""
    z = F.lit(float(intercept))
    for name, w in weights.items():
        z = z + F.lit(float(w)) * F.col(name)
    return logistic(z)


def model_score(df: DataFrame, model) -> DataFrame:
    """``df`` with the positive-class probability of a fitted Spark ML model."""
    scored = model.transform(df)
    value = vector_to_array("probability")[1] if "probability" in scored.columns else F.col(PROBABILITY)
    return scored.select(*df.columns, value.alias(PROBABILITY))


def decide(df: DataFrame, threshold: float | Column) -> DataFrame:
    """Append decision (probability >= threshold) and the threshold used."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return df.withColumn(DECISION, F.when(F.col(PROBABILITY) >= limit, 1).otherwise(0)).withColumn(THRESHOLD, limit)


def score_batch(df: DataFrame, scorer: Column | object, threshold: float | Column) -> DataFrame:
    """Append probability, decision and threshold. ``scorer``: a column or a fitted model."""
    if isinstance(scorer, Column):
        return decide(df.withColumn(PROBABILITY, scorer), threshold)
    return decide(model_score(df, scorer), threshold)


def score_summary(scored: DataFrame, by: list | None = None) -> DataFrame:
    """total, flagged, rate, mean/min/max probability - overall or per group."""
    out = scored.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(DECISION), F.lit(0)).cast("long").alias("flagged"),
        F.avg(PROBABILITY).alias("mean_probability"), F.min(PROBABILITY).alias("min_probability"),
        F.max(PROBABILITY).alias("max_probability"))
    return out.withColumn("flagged_rate", ratio(F.col("flagged"), F.col("total")))


def positive_rate(scored: DataFrame, threshold: float) -> DataFrame:
    """Share of rows, in percent, whose probability reaches ``threshold``."""
    hit = (F.col(PROBABILITY) >= F.lit(float(threshold))).cast("int")
    return scored.agg(F.lit(float(threshold)).alias("threshold"),
                      F.coalesce(F.avg(hit) * 100, F.lit(0.0)).alias("positive_rate"))


def predict_models(df: DataFrame, key: str, scorers: dict[str, Column], threshold: float,
                   rules: dict[str, Column], model: str | None = None) -> DataFrame:
    """One record per row and model; rows that break a rule get ``error`` and NULL results.

    With ``model`` only that one is used. All models read the row once.
    """
    if not scorers:
        raise ValueError("no models available")
    if model is not None:
        if model not in scorers:
            raise ValueError(f"model not found: {model}")
        scorers = {model: scorers[model]}
    checked = failed_rules(df, rules)
    error = F.when(F.size("failed") > 0, F.array_join("failed", ","))
    per_model = F.array(*[F.struct(F.lit(name).alias("model_name"), p.alias("p")) for name, p in scorers.items()])
    long = checked.select(F.col(key).alias("index"), error.alias("error"), F.inline(per_model))
    good = F.col("error").isNull()
    flag = F.when(good, (F.col("p") >= F.lit(float(threshold))).cast("int"))
    return long.select("index", "model_name", flag.alias("prediction"), F.when(good, F.col("p")).alias("probability"),
                       (flag == 1).alias("is_fraud"), F.when(good, F.lit(float(threshold))).alias("threshold"), "error")


def with_top_importances(scored: DataFrame, importances: DataFrame, n: int = 5) -> DataFrame:
    """Add the map of the ``n`` most important features (the same for every row)."""
    top = importances.orderBy(F.desc(F.abs("importance")), "feature").limit(n)
    packed = top.agg(F.map_from_entries(F.collect_list(  # n entries
        F.struct("feature", F.abs("importance").alias("importance"))))).scalar()
    return scored.withColumn("top_importances", packed)
