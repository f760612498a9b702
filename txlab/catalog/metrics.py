"""Metric queries over scored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rounded
from ..operators import metrics as m
from .registry import query
from .roles import SCORED, SCORED_MODELS, scored, scored_models, table

CURVE = """g AS (SELECT score, sum(label)::BIGINT AS pos, sum(1 - label)::BIGINT AS neg FROM scored GROUP BY score),
c AS (SELECT *, (sum(pos) OVER w)::BIGINT AS tp, (sum(neg) OVER w)::BIGINT AS fp, (sum(pos) OVER ())::BIGINT AS p,
             (sum(neg) OVER ())::BIGINT AS n
      FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""
DECIDED = "decided AS (SELECT *, (score >= 0.5)::INTEGER AS prediction FROM scored)"
COUNTS = """count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn"""
RATES = """round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1"""


def _round(df, skip=()):
    return df.withColumns({c: rounded(F.col(c)) for c, t in df.dtypes if t == "double" and c not in skip})


def _decided(spark, folder):
    return scored(spark, folder).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


@query("binary_metrics", f"""
  WITH {SCORED}, {CURVE}, {DECIDED}, k AS (SELECT {COUNTS} FROM decided)
  SELECT round((tp + tn) / (tp + tn + fp + fn)::DOUBLE, 6) AS accuracy, {RATES},
         (SELECT round(sum(neg * (tp - pos + pos / 2e0)) / (max(p)::DOUBLE * max(n)), 6) FROM c) AS roc_auc FROM k""")
def binary_metrics(spark, folder):
    """Accuracy, precision, recall, F1 and ROC-AUC."""
    return _round(m.binary_metrics(_decided(spark, folder), "label", "prediction", "score"))


@query("confusion_matrix", f"""
  WITH {SCORED}, {DECIDED} SELECT a.v AS actual, b.v AS predicted,
    (SELECT count(*) FROM decided WHERE label = a.v AND prediction = b.v)::BIGINT AS n
  FROM (VALUES (0), (1)) AS a(v), (VALUES (0), (1)) AS b(v)""")
def confusion_matrix(spark, folder):
    """Actual against predicted."""
    return m.confusion_matrix(_decided(spark, folder), "label", "prediction")


REPORT = """per AS (
  SELECT name, coalesce(hit / nullif(given, 0)::DOUBLE, 0) AS precision, coalesce(hit / nullif(support, 0)::DOUBLE, 0) AS recall,
         coalesce(2 * hit / nullif(given + support, 0)::DOUBLE, 0) AS f1, support, hit
  FROM (SELECT k.name, count(*) FILTER (WHERE y = k.name) AS support, count(*) FILTER (WHERE z = k.name) AS given,
               count(*) FILTER (WHERE y = k.name AND z = k.name) AS hit
        FROM (SELECT y AS name FROM yz UNION SELECT z FROM yz) k, yz GROUP BY k.name))
  SELECT name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support FROM per
  UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support)::DOUBLE, 6), round(sum(hit) / sum(support)::DOUBLE, 6),
    round(sum(hit) / sum(support)::DOUBLE, 6), sum(support)::BIGINT FROM per
  UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM per
  UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support)::DOUBLE, 6),
    round(sum(recall * support) / sum(support)::DOUBLE, 6), round(sum(f1 * support) / sum(support)::DOUBLE, 6),
    sum(support)::BIGINT FROM per"""


@query("classification_report", f"WITH {SCORED}, {DECIDED}, yz AS (SELECT label::VARCHAR AS y, prediction::VARCHAR AS z FROM decided), {REPORT}")
def classification_report(spark, folder):
    """Per class, accuracy, macro and weighted averages."""
    return _round(m.classification_report(_decided(spark, folder), "label", "prediction"))


@query("classification_report_multiclass", f"""
  WITH yz AS (SELECT o_orderstatus AS y, CASE WHEN o_totalprice < 150000 THEN 'F' WHEN o_totalprice < 300000 THEN 'O' ELSE 'P' END AS z
              FROM orders), {REPORT}""")
def classification_report_multiclass(spark, folder):
    """The same report for a label with three classes."""
    price = F.col("o_totalprice")
    orders = table(spark, folder, "orders").withColumn(
        "guess", F.when(price < 150000, "F").when(price < 300000, "O").otherwise("P"))
    return _round(m.classification_report(orders, "o_orderstatus", "guess"))


@query("pr_curve", f"""
  WITH {SCORED}, {CURVE}
  SELECT score AS threshold, round(tp / (tp + fp)::DOUBLE, 6) AS precision, round(tp / p::DOUBLE, 6) AS recall FROM c
  UNION ALL SELECT NULL, 1, 0""")
def pr_curve(spark, folder):
    """Precision and recall at every distinct score."""
    return _round(m.pr_curve(m.score_curve(scored(spark, folder), "label", "score")), ["threshold"])


@query("roc_curve", f"""
  WITH {SCORED}, {CURVE}
  SELECT score AS threshold, round(fp / n::DOUBLE, 6) AS fpr, round(tp / p::DOUBLE, 6) AS tpr FROM c
  UNION ALL SELECT 'infinity'::DOUBLE, 0, 0""")
def roc_curve(spark, folder):
    """False and true positive rate at every distinct score."""
    return _round(m.roc_curve(m.score_curve(scored(spark, folder), "label", "score")), ["threshold"])


@query("average_precision", f"""
  WITH {SCORED}, {CURVE} SELECT round(sum(pos / p::DOUBLE * (tp / (tp + fp)::DOUBLE)), 6) AS pr_auc FROM c""")
def average_precision(spark, folder):
    """Average precision, ties handled as one step."""
    return _round(m.average_precision(m.score_curve(scored(spark, folder), "label", "score")))


@query("roc_auc", f"""
  WITH {SCORED}, {CURVE} SELECT round(sum(neg * (tp - pos + pos / 2e0)) / (max(p)::DOUBLE * max(n)), 6) AS roc_auc FROM c""")
def roc_auc(spark, folder):
    """ROC-AUC with half credit for ties."""
    return _round(m.roc_auc(m.score_curve(scored(spark, folder), "label", "score")))


@query("brier_score", f"WITH {SCORED} SELECT round(avg((score - label) * (score - label)), 6) AS brier_score FROM scored")
def brier_score(spark, folder):
    """Mean squared gap between probability and label."""
    return _round(m.brier_score(scored(spark, folder), "label", "score"))


@query("precision_recall_at_k", f"""
  WITH {SCORED}, r AS (SELECT label, row_number() OVER (ORDER BY score DESC, key) AS rn, count(*) OVER () AS n FROM scored)
  SELECT k::DOUBLE AS k, floor(max(n) * k)::BIGINT AS rows,
         round(count(*) FILTER (WHERE label = 1 AND rn <= floor(n * k)) / floor(max(n) * k)::DOUBLE, 6) AS precision_at_k,
         round(count(*) FILTER (WHERE label = 1 AND rn <= floor(n * k)) / sum(label)::DOUBLE, 6) AS recall_at_k
  FROM r, (VALUES (0.1e0), (0.05e0)) AS s(k) GROUP BY k""")
def precision_recall_at_k(spark, folder):
    """Precision and recall among the top 10 % and 5 % by score."""
    return _round(m.precision_recall_at_k(scored(spark, folder), "key", "label", "score"), ["k"])


CHOSEN = """chosen AS (
  SELECT coalesce((SELECT score FROM c WHERE tp / p::DOUBLE >= 0.9 ORDER BY tp / (tp + fp)::DOUBLE DESC, score LIMIT 1), 0.5e0) AS threshold)"""


@query("optimal_threshold", f"WITH {SCORED}, {CURVE}, {CHOSEN} SELECT threshold FROM chosen")
def optimal_threshold(spark, folder):
    """The most precise threshold with a recall of at least 0.90."""
    return m.optimal_threshold(m.score_curve(scored(spark, folder), "label", "score"))


@query("metrics_at_threshold", f"""
  WITH {SCORED}, {CURVE}, {CHOSEN}, decided AS (SELECT label, (score >= threshold)::INTEGER AS prediction FROM scored, chosen),
  k AS (SELECT {COUNTS} FROM decided)
  SELECT threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, tn::BIGINT AS tn, {RATES} FROM k, chosen""")
def metrics_at_threshold(spark, folder):
    """Confusion counts and rates at the chosen threshold."""
    rows = scored(spark, folder)
    chosen = m.optimal_threshold(m.score_curve(rows, "label", "score"))
    return _round(m.metrics_at_threshold(rows, "label", "score", chosen), ["threshold"])


MODEL_CURVE = SCORED_MODELS + """,
mg AS (SELECT model, score, sum(label)::BIGINT AS pos, sum(1 - label)::BIGINT AS neg FROM scored_models GROUP BY model, score),
mc AS (SELECT *, (sum(pos) OVER w)::BIGINT AS tp, (sum(neg) OVER w)::BIGINT AS fp, (sum(pos) OVER a)::BIGINT AS p,
              (sum(neg) OVER a)::BIGINT AS n
       FROM mg WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY model))"""
RESULTS = MODEL_CURVE + """,
pick AS (SELECT model, coalesce(first(score ORDER BY tp / (tp + fp)::DOUBLE DESC, score)
                                FILTER (WHERE tp / p::DOUBLE >= 0.9), 0.5e0) AS threshold FROM mc GROUP BY model),
base AS (SELECT model, sum(pos / p::DOUBLE * (tp / (tp + fp)::DOUBLE)) AS pr_auc,
                sum(neg * (tp - pos + pos / 2e0)) / (max(p)::DOUBLE * max(n)) AS roc_auc FROM mc GROUP BY model),
cut AS (SELECT model, threshold, sum(label) AS p,
               count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp, count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp,
               count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tpt,
               count(*) FILTER (WHERE label = 0 AND score >= threshold) AS fpt,
               avg((score - label) * (score - label)) AS brier_score
        FROM scored_models JOIN pick USING (model) GROUP BY model, threshold),
results AS (
  SELECT model, round(pr_auc, 6) AS pr_auc, round(roc_auc, 6) AS roc_auc,
         round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS precision, round(tp / p::DOUBLE, 6) AS recall,
         round(coalesce(2 * tp / nullif(tp + fp + p, 0)::DOUBLE, 0), 6) AS f1, threshold,
         round(coalesce(tpt / nullif(tpt + fpt, 0)::DOUBLE, 0), 6) AS best_precision, round(tpt / p::DOUBLE, 6) AS best_recall,
         round(coalesce(2 * tpt / nullif(tpt + fpt + p, 0)::DOUBLE, 0), 6) AS best_f1, round(brier_score, 6) AS brier_score
  FROM base JOIN cut USING (model))"""


def results(spark, folder):
    return _round(m.evaluate_models(scored_models(spark, folder), "label", "score"), ["threshold"])


@query("evaluate_models", f"WITH {RESULTS} SELECT * FROM results")
def evaluate_models(spark, folder):
    """All metrics of several models from one curve."""
    return results(spark, folder)


@query("evaluate_models_long", f"WITH {RESULTS} SELECT * FROM (UNPIVOT (SELECT * FROM results) ON COLUMNS(* EXCLUDE model) INTO NAME metric VALUE value)")
def evaluate_models_long(spark, folder):
    """The same as rows (model, metric, value)."""
    return m.long_metrics(results(spark, folder))


@query("format_metrics", f"""
  WITH {RESULTS}, l AS (UNPIVOT (SELECT * FROM results) ON COLUMNS(* EXCLUDE model) INTO NAME metric VALUE value)
  SELECT model, metric, printf('%.4f', value) AS value FROM l""")
def format_metrics(spark, folder):
    """Metrics as text with four decimals."""
    return m.format_metrics(m.long_metrics(results(spark, folder)))


@query("leaderboard", f"""
  WITH {RESULTS} SELECT model, pr_auc, roc_auc, row_number() OVER (ORDER BY pr_auc DESC, model)::INTEGER AS rank FROM results""")
def leaderboard(spark, folder):
    """Models ranked by PR-AUC."""
    return m.leaderboard(results(spark, folder).select("model", "pr_auc", "roc_auc"))


@query("best_model", f"""
  WITH {RESULTS}, r AS (SELECT *, row_number() OVER (ORDER BY pr_auc DESC, model) AS rank FROM results)
  SELECT max(model) FILTER (WHERE rank = 1) AS best_model, max(pr_auc) AS pr_auc, max(model) FILTER (WHERE rank = 2) AS runner_up FROM r""")
def best_model(spark, folder):
    """Winner and runner-up."""
    return m.best_model(results(spark, folder))
