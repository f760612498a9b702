"""Model queries. Fitted models have no SQL counterpart; what is measured about scores has."""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from ..functions import rounded
from ..operators import calibration, models as mo, search
from ..operators.logistic import fit_newton
from ..operators.metrics import evaluate_models
from ..operators.prepare import stratified_split
from ..operators.scoring import DECISION, PROBABILITY
from ..plans import evaluation
from ..session import freeze, scratch_path
from .registry import query
from .metrics import RESULTS
from .roles import FEATURES, SCORED, SCORED_MODELS, VECTORS, scored, scored_models, sql_hash, sql_uniform, transactions, vectors

KEY, LABEL = "vec_id", "Class"


def _round(df):
    return df.withColumns({c: rounded(F.col(c)) for c, t in df.dtypes if t == "double"})


def _parts(spark, folder):
    split = freeze(stratified_split(vectors(spark, folder), KEY, LABEL), "split")
    return split.where(F.col("split") == "train"), split.where(F.col("split") == "test")


def _fit(spark, folder, name, params=None):
    train, test = _parts(spark, folder)
    _, results = mo.train_all(train, test, [name], FEATURES, KEY, LABEL, {name: params or {}})
    return _round(results)


# Newton steps in SQL: cells of the normal equations are sums, and pivots eliminate one unknown after the other.
P = len(FEATURES) + 1


def newton_sql(weight: str) -> str:
    return f"""{VECTORS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY "Class" ORDER BY {sql_hash('vec_id', '42')}, vec_id) AS rn, count(*) OVER (PARTITION BY "Class") AS n FROM vectors),
parts AS (SELECT vec_id, "Class"::DOUBLE AS y, [1e0, {", ".join(f'"{v}"' for v in FEATURES)}] AS x, rn <= round(n * 0.2e0) AS test FROM ranked),
sizes AS (SELECT y, count(*)::DOUBLE AS n FROM parts WHERE NOT test GROUP BY y),
train AS (SELECT p.*, {weight} AS t FROM parts p JOIN sizes USING (y) WHERE NOT test),
cells AS (SELECT a.i AS i, b.j AS j FROM (SELECT unnest(range(1, {P + 1})) AS i) a, (SELECT unnest(range(1, {P + 2})) AS j) b),
newton AS (
  SELECT 0 AS step, list_transform(range({P}), lambda k: 0e0) AS w
  UNION ALL
  SELECT step + 1, list_transform(w, lambda v, i: v - solved[i][{P + 1}])
  FROM (SELECT step, w, list_reduce(list_prepend(m, list_transform(range(1, {P + 1}), lambda k: [[k::DOUBLE]])), lambda acc, e:
               list_transform(acc, lambda line, i: CASE WHEN i = e[1][1] THEN list_transform(line, lambda v: v / line[e[1][1]::INT])
                 ELSE list_transform(line, lambda v, j: v - line[e[1][1]::INT] * acc[e[1][1]::INT][j] / acc[e[1][1]::INT][e[1][1]::INT]) END)) AS solved
        FROM (SELECT step, any_value(w) AS w, list(line ORDER BY i) AS m
              FROM (SELECT step, i, any_value(w) AS w, list(v ORDER BY j) AS line
                    FROM (SELECT step, i, j, any_value(w) AS w,
                                 sum(CASE WHEN j <= {P} THEN t * q * (1 - q) * x[i] * x[j] ELSE t * (q - y) * x[i] END)
                                 + CASE WHEN i > 1 AND j = i THEN 1e0 WHEN i > 1 AND j = {P + 1} THEN any_value(w[i]) ELSE 0e0 END AS v
                          FROM (SELECT f.step, f.w, r.x, r.y, r.t, 1 / (1 + exp(-list_dot_product(f.w, r.x))) AS q FROM newton f, train r WHERE f.step < 10), cells
                          GROUP BY step, i, j) GROUP BY step, i) GROUP BY step))),
scored_models AS (
  SELECT 'logistic_regression' AS model, vec_id AS key, y::INTEGER AS label, round(1 / (1 + exp(-list_dot_product(w, x))), 6) AS score
  FROM parts, newton WHERE test AND step = 10)""" + RESULTS[len(SCORED_MODELS):]


EXACT = {"solver": "newton"}


def _fit_exact(spark, folder, weighted):
    from ..operators.resample import with_class_weights
    train, test = _parts(spark, folder)
    train = freeze(with_class_weights(train, LABEL), "weighted") if weighted else train
    model = mo.fit_model(train, "logistic_regression", FEATURES, LABEL, EXACT, "weight" if weighted else None)
    scored = mo.scored_rows(test, model, "logistic_regression", KEY, LABEL).withColumn("score", rounded(F.col("score")))
    return _round(evaluate_models(freeze(scored, "scored"), "label", "score"))


@query("fit_logistic", "WITH RECURSIVE " + newton_sql("1e0") + " SELECT * FROM results")
def fit_logistic(spark, folder):
    """Logistic regression to full precision: fitted on train rows, measured on test rows."""
    return _fit_exact(spark, folder, False)


@query("fit_logistic_ml")
def fit_logistic_ml(spark, folder):
    """The same model by Spark ML's own optimiser."""
    return _fit(spark, folder, "logistic_regression")


@query("logistic_weights", "WITH RECURSIVE " + newton_sql("1e0") + """
  SELECT CASE WHEN i = 1 THEN 'intercept' ELSE 'V' || (i - 1) END AS feature, round(v, 6) AS weight
  FROM (SELECT unnest(w) AS v, generate_subscripts(w, 1) AS i FROM newton WHERE step = 10)""")
def logistic_weights(spark, folder):
    """The weights themselves."""
    weights, intercept = fit_newton(_parts(spark, folder)[0], FEATURES, LABEL)
    return _round(spark.createDataFrame([("intercept", intercept), *zip(FEATURES, weights)], "feature string, weight double"))


@query("fit_forest")
def fit_forest(spark, folder):
    """Random forest."""
    return _fit(spark, folder, "random_forest")


@query("fit_gbt")
def fit_gbt(spark, folder):
    """Boosted trees: 100 rounds of depth 6."""
    return _fit(spark, folder, "gradient_boosting")


@query("train_all")
def train_all(spark, folder):
    """All models; an unknown name is recorded as an error and the rest go on."""
    train, test = _parts(spark, folder)
    _, results = mo.train_all(train, test, ["logistic_regression", "random_forest", "gradient_boosting", "no_such_model"], FEATURES, KEY, LABEL)
    return _round(results)


@query("train_class_weight", "WITH RECURSIVE " + newton_sql("(SELECT sum(n) FROM sizes) / (2 * n)") + " SELECT * FROM results")
def train_class_weight(spark, folder):
    """Logistic regression with balanced class weights."""
    return _fit_exact(spark, folder, True)


@query("cross_validate")
def cross_validate(spark, folder):
    """Five stratified folds: PR-AUC, ROC-AUC and F1 from one fit per fold."""
    return _round(mo.cross_validate(vectors(spark, folder), "logistic_regression", FEATURES, KEY, LABEL))


@query("cross_validate_smote")
def cross_validate_smote(spark, folder):
    """The same with synthetic minority rows in the training part of each fold only."""
    return _round(mo.cross_validate(vectors(spark, folder), "logistic_regression", FEATURES, KEY, LABEL, strategy="smote"))


@query("random_search")
def random_search(spark, folder):
    """Twenty random settings of both models that have a search space, three folds each."""
    df = freeze(vectors(spark, folder), "vectors")
    found = [search.random_search(df, name, FEATURES, KEY, LABEL)[1] for name in ("logistic_regression", "random_forest")]
    trials = found[0].unionByName(found[1])
    return _round(trials.select("trial", "model", F.map_values("params").alias("settings"), "pr_auc_mean", "pr_auc_std"))


@query("refit_best")
def refit_best(spark, folder):
    """Search on the training rows, refit the winner, measure on the test rows."""
    train, test = _parts(spark, folder)
    best, _ = search.random_search(train, "logistic_regression", FEATURES, KEY, LABEL)
    _, results = search.refit_best(train, test, "logistic_regression", best, FEATURES, KEY, LABEL)
    return _round(results)


@query("model_info")
def model_info(spark, folder):
    """Settings of a model that was saved and loaded again."""
    model = mo.fit_model(vectors(spark, folder), "random_forest", FEATURES, LABEL)
    loaded = mo.load_model(mo.save_model(model, scratch_path(spark, "model")))
    return mo.model_info(loaded, "random_forest")


FOLD = f"floor({sql_uniform(sql_hash('key', '42', 'calibration'))} * 5)::INTEGER"
PLATT = f"""cal_rows AS (SELECT *, {FOLD} AS fold FROM scored_models),
cal_g AS (SELECT model, fold, score, sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg FROM cal_rows GROUP BY ALL),
cal_n AS (SELECT model, j, sum(pos) AS np, sum(neg) AS nn FROM cal_g, (SELECT unnest(range(5)) AS j) WHERE fold <> j GROUP BY ALL),
cal_fit AS (
  SELECT model, j, 0 AS step, 0e0 AS a, ln((np + 1) / (nn + 1)) AS b, (np + 1) / (np + 2) AS hi, 1 / (nn + 2) AS lo FROM cal_n
  UNION ALL
  SELECT model, j, step + 1, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b - (haa * gb - hab * ga) / (haa * hbb - hab * hab), hi, lo
  FROM (SELECT model, j, step, a, b, hi, lo, sum(g * score) AS ga, sum(g) AS gb, sum(h * score * score) AS haa, sum(h * score) AS hab, sum(h) AS hbb
        FROM (SELECT *, pos * (q - hi) + neg * (q - lo) AS g, (pos + neg) * q * (1 - q) AS h
              FROM (SELECT f.*, score, pos, neg, 1 / (1 + exp(-(a * score + b))) AS q
                    FROM cal_fit f JOIN cal_g g ON g.model = f.model AND g.fold <> f.j WHERE step < 15)) GROUP BY ALL)),
sigmoids AS (SELECT model, j, a, b FROM cal_fit WHERE step = 15),
cal AS (SELECT r.*, 1 / (1 + exp(-(a * score + b))) AS calibrated FROM cal_rows r JOIN sigmoids s ON s.model = r.model AND s.j = r.fold),
briers AS (SELECT model, avg((score - label) * (score - label)) AS original_brier, avg((calibrated - label) * (calibrated - label)) AS calibrated_brier FROM cal GROUP BY model),
final AS (SELECT model, key, label, round(CASE WHEN calibrated_brier < original_brier THEN calibrated ELSE score END, 6) AS score FROM cal JOIN briers USING (model))"""
CALIBRATED = SCORED_MODELS + ", " + PLATT + RESULTS[len(SCORED_MODELS):].replace("scored_models", "final")


@query("platt_fit", f"""
  WITH RECURSIVE {SCORED_MODELS}, {PLATT} SELECT model, j::INTEGER AS fold, round(a, 6) AS slope, round(b, 6) AS intercept FROM sigmoids""")
def platt_fit(spark, folder):
    """The sigmoid of every model and fold, fitted on the rows of the other folds."""
    fits = calibration.platt_cross_fit(scored_models(spark, folder), by=["model"])
    rows = [(g[0], j, a, b) for g, s in fits.items() for j, (a, b) in enumerate(s.pairs)]
    return _round(spark.createDataFrame(rows, "model string, fold int, slope double, intercept double"))


@query("platt_calibrate", f"""
  WITH RECURSIVE {SCORED_MODELS}, {PLATT}
  SELECT key, label, score, round(calibrated, 6) AS calibrated, round(CASE WHEN calibrated_brier < original_brier THEN calibrated ELSE score END, 6) AS final
  FROM cal JOIN briers USING (model) WHERE model = 'partial'""")
def platt_calibrate(spark, folder):
    """Scores calibrated out of fold, kept only if that is better."""
    final, _ = calibration.calibrate(scored(spark, folder))
    return _round(final).select("key", "label", "score", "calibrated", "final")


@query("evaluate_calibrated", f"""
  WITH RECURSIVE {CALIBRATED}
  SELECT r.*, round(original_brier, 6) AS original_brier, round(calibrated_brier, 6) AS calibrated_brier, calibrated_brier < original_brier AS use_calibrated, NULL::VARCHAR AS reason
  FROM results r JOIN briers USING (model)""")
def evaluate_calibrated(spark, folder):
    """Every model with its own calibration, then all metrics."""
    return _round(evaluation.evaluate_calibrated(scored_models(spark, folder), digits=6)[0])


@query("score_promoted_unit", f"""
  WITH RECURSIVE {CALIBRATED},
  best AS (SELECT model, threshold, calibrated_brier < original_brier AS use FROM results JOIN briers USING (model) ORDER BY pr_auc DESC, model LIMIT 1),
  mean AS (SELECT key, score, avg(1 / (1 + exp(-(a * score + b)))) AS smooth, any_value(threshold) AS threshold, any_value(use) AS use
           FROM scored_models JOIN best USING (model) JOIN sigmoids USING (model) GROUP BY ALL)
  SELECT key AS event_id, round(CASE WHEN use THEN smooth ELSE score END, 6) AS fraud_probability,
         (CASE WHEN use THEN smooth ELSE score END >= threshold)::INTEGER AS fraud_decision, threshold FROM mean""")
def score_promoted_unit(spark, folder):
    """Calibrate, compare, choose a threshold, promote, load, score: the evaluation job on closed-form models."""
    tx = transactions(spark, folder)
    expressions = {"amount": "round(1D / (1D + exp(-((Amount - 50D) / 40D))), 6)", "inverse": "round(1D / (1D + exp(-((50D - Amount) / 40D))), 6)",
                   "partial": "round(1D / (1D + exp(-(Class * 2D + Ticks / 50D - 1.5D))), 6)"}
    stages = {n: [SQLTransformer(statement=f"SELECT *, {e} AS {PROBABILITY} FROM __THIS__")] for n, e in expressions.items()}
    path = scratch_path(spark, "promoted")
    evaluation.compare_and_promote(scored_models(spark, folder), stages, path, digits=6)
    out = evaluation.score_promoted(tx, path).select("event_id", PROBABILITY, DECISION, "threshold")
    return out.withColumn(PROBABILITY, rounded(F.col(PROBABILITY)))


@query("calibration_choice", f"""
  WITH {SCORED}, c AS (SELECT *, 1e0 / (1e0 + exp(-(4e0 * score - 3e0))) AS calibrated FROM scored)
  SELECT round(avg((score - label) * (score - label)), 6) AS original_brier,
         round(avg((calibrated - label) * (calibrated - label)), 6) AS calibrated_brier,
         avg((calibrated - label) * (calibrated - label)) < avg((score - label) * (score - label)) AS use_calibrated FROM c""")
def calibration_choice(spark, folder):
    """Brier score before and after a given sigmoid, and which to keep."""
    return _round(calibration.calibration_choice(calibration.platt_apply(scored(spark, folder), 4.0, -3.0)))
