"""Scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rounded
from ..operators import metrics as m, models, scoring as s
from ..operators.prepare import scale_fit
from ..operators.validate import non_negative
from ..plans.scoring import score_job
from ..session import freeze, scratch_path
from .modelling import newton_sql
from .registry import query
from .roles import (
    FEATURES, SCORED, SIGMOID_AMOUNT, TX, amount_score, table, transactions, vectors,
)

PROBABILITY, DECISION = s.PROBABILITY, s.DECISION
THRESHOLD = 0.6


def _round(df, columns):
    return df.withColumns({c: rounded(F.col(c)) for c in columns})


BATCH = f"""batch AS (
  SELECT event_id, "Class", {SIGMOID_AMOUNT} AS fraud_probability, ({SIGMOID_AMOUNT} >= 0.6e0)::INTEGER AS fraud_decision,
         0.6::DOUBLE AS threshold FROM tx)"""


@query("score_batch", f"""WITH {TX}, {BATCH} SELECT * FROM batch""")
def score_batch(spark, folder):
    """Probability, decision and threshold for every transaction."""
    return s.score_batch(transactions(spark, folder), amount_score(), THRESHOLD).select(
        "event_id", "Class", PROBABILITY, DECISION, "threshold")


SUMMARY = """count(*)::BIGINT AS total, sum(fraud_decision)::BIGINT AS flagged, round(avg(fraud_probability), 6) AS mean_probability,
  min(fraud_probability) AS min_probability, max(fraud_probability) AS max_probability,
  round(avg(fraud_decision), 6) AS flagged_rate"""


@query("score_summary", f"""
  WITH {TX}, sc AS (SELECT (("Amount" - avg("Amount") OVER ()) / stddev_pop("Amount") OVER ()) AS a,
                           (("Time" - avg("Time") OVER ()) / stddev_pop("Time") OVER ()) AS t, "Class" FROM tx),
  batch AS (SELECT "Class", round(1e0 / (1e0 + exp(-(-0.25e0 + 0.8e0 * a + 0.3e0 * t))), 6) AS fraud_probability FROM sc),
  d AS (SELECT *, (fraud_probability >= 0.5e0)::INTEGER AS fraud_decision FROM batch)
  SELECT "Class", {SUMMARY} FROM d GROUP BY "Class" """)
def score_summary(spark, folder):
    """Validate, scale, score with a logistic model, summarise per class."""
    tx = transactions(spark, folder)
    scored, _, _ = score_job(
        tx, "event_id", ["Time", "Amount", "Class"],
        rounded(s.linear_score({"Amount_scaled": 0.8, "Time_scaled": 0.3}, -0.25)), 0.5, scale_fit(tx, ["Amount", "Time"]))
    return _round(s.score_summary(scored, ["Class"]), ["mean_probability", "flagged_rate"])


@query("score_summary_overall", f"WITH {TX}, {BATCH} SELECT {SUMMARY} FROM batch")
def score_summary_overall(spark, folder):
    """One summary row of a scored batch."""
    return _round(s.score_summary(score_batch(spark, folder)), ["mean_probability", "flagged_rate"])


@query("positive_rate", f"""
  WITH {TX}, {BATCH} SELECT 0.7::DOUBLE AS threshold, round(avg((fraud_probability >= 0.7)::INTEGER) * 100, 6) AS positive_rate FROM batch""")
def positive_rate(spark, folder):
    """Share of rows at or above a threshold."""
    return _round(s.positive_rate(score_batch(spark, folder), 0.7), ["positive_rate"])


@query("predict_models", """
  WITH c AS (SELECT c_custkey AS index, c_acctbal, c_acctbal >= 0 AS good FROM customer),
  l AS (SELECT index, good, 'rising' AS model_name, round(1e0 / (1e0 + exp(-(c_acctbal / 5000e0 - 1e0))), 6) AS p FROM c
        UNION ALL SELECT index, good, 'falling', round(1e0 / (1e0 + exp(-(1e0 - c_acctbal / 5000e0))), 6) FROM c)
  SELECT index, model_name, CASE WHEN good THEN (p >= 0.5)::INTEGER END AS prediction, CASE WHEN good THEN p END AS probability,
         CASE WHEN good THEN p >= 0.5 END AS is_fraud, CASE WHEN good THEN 0.5::DOUBLE END AS threshold,
         CASE WHEN NOT good THEN 'c_acctbal_non_negative' END AS error FROM l""")
def predict_models(spark, folder):
    """One record per row and model; rows that break a rule carry an error."""
    scaled = F.col("c_acctbal") / 5000.0
    scorers = {"rising": rounded(1.0 / (1.0 + F.exp(-(scaled - 1.0)))), "falling": rounded(1.0 / (1.0 + F.exp(-(1.0 - scaled))))}
    return s.predict_models(table(spark, folder, "customer"), "c_custkey", scorers, 0.5, non_negative("c_acctbal"))


@query("apply_saved_scaler", f"""
  WITH {TX} SELECT event_id, round(("Amount" - (SELECT avg("Amount") FROM tx)) / (SELECT stddev_pop("Amount") FROM tx), 6) AS "Amount",
    "Ticks" FROM tx""")
def apply_saved_scaler(spark, folder):
    """Scale with stored statistics; a feature without any stays as it is."""
    from ..operators.prepare import scale_transform
    tx = transactions(spark, folder)
    path = scratch_path(spark, "scaler")
    scale_fit(tx, ["Amount"]).write.parquet(path)
    out = scale_transform(tx, spark.read.parquet(path), ["Amount", "Ticks"])
    return _round(out, ["Amount"]).select("event_id", "Amount", "Ticks")


@query("score_with_chosen_threshold", f"""
  WITH {SCORED}, g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY score),
  c AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p FROM g
        WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
  t AS (SELECT score AS threshold FROM c WHERE tp / p::DOUBLE >= 0.9 ORDER BY tp / (tp + fp)::DOUBLE DESC, score LIMIT 1)
  SELECT key, score AS fraud_probability, (score >= threshold)::INTEGER AS fraud_decision, threshold FROM scored, t""")
def score_with_chosen_threshold(spark, folder):
    """Decide with the threshold chosen from the same scores."""
    from .roles import scored
    rows = scored(spark, folder)
    chosen = m.optimal_threshold(m.score_curve(rows, "label", "score"))
    return s.score_batch(rows, F.col("score"), chosen.scalar()).select("key", PROBABILITY, DECISION, "threshold")


FITTED = newton_sql("1e0").split("scored_models AS")[0].rstrip(", \n").replace("rn <= round(n * 0.2e0) AS test", "false AS test")


@query("score_fitted_model", f"""
  WITH RECURSIVE {FITTED},
  named AS (SELECT 'V' || (i - 1) AS feature, abs(v) AS size FROM (SELECT unnest(w) AS v, generate_subscripts(w, 1) AS i FROM newton WHERE step = 10) WHERE i > 1),
  top AS (SELECT string_agg(feature, ',' ORDER BY size DESC, feature) AS top_features FROM (SELECT * FROM named ORDER BY size DESC, feature LIMIT 5)),
  s AS (SELECT vec_id, y, 1 / (1 + exp(-list_dot_product(w, x))) AS p FROM parts, newton WHERE step = 10)
  SELECT vec_id, y::INTEGER AS "Class", round(p, 6) AS fraud_probability, (p >= 0.5e0)::INTEGER AS fraud_decision, 0.5e0 AS threshold, top_features FROM s, top""")
def score_fitted_model(spark, folder):
    """Score with a fitted logistic model and attach its five most important features."""
    rows = freeze(vectors(spark, folder), "vectors")
    model = models.fit_model(rows, "logistic_regression", FEATURES, "Class", {"solver": "newton"})
    scored = s.score_batch(rows, model, 0.5).select("vec_id", "Class", PROBABILITY, DECISION, "threshold")
    return s.with_top_importances(_round(scored, [PROBABILITY]), models.importances(model, FEATURES)).select(
        "vec_id", "Class", PROBABILITY, DECISION, "threshold", F.array_join(F.map_keys("top_importances"), ",").alias("top_features"))


@query("top_importances")
def top_importances(spark, folder):
    """Features of a fitted forest by importance."""
    model = models.fit_model(vectors(spark, folder), "random_forest", FEATURES, "Class")
    return models.importances(model, FEATURES).orderBy(F.desc("importance"), "feature").limit(5)
