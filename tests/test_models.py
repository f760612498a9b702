import numpy as np
import pytest
from pyspark.sql import functions as F

from txlab.operators import calibration, models, scoring, search
from txlab.operators.resample import with_class_weights
from txlab.plans import evaluation

FEATURES = [f"f{i}" for i in range(4)]


def table(spark, n, share, seed=42):
    rng = np.random.default_rng(seed)
    y = np.zeros(n, dtype=int)
    y[rng.choice(n, max(2, int(n * share)), replace=False)] = 1
    x = rng.normal(size=(n, 4)) + y[:, None] * np.array([1.5, 0, 0, 0])
    rows = [(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, " + ", ".join(f"{f} double" for f in FEATURES) + ", Class int").cache(), x, y


@pytest.fixture(scope="module")
def data(spark):
    return table(spark, 300, 0.1)


def newton(x, y, c):
    """Minimise the summed logistic loss plus |w|^2 / (2 C), free intercept."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(a.shape[1]), np.diag([1 / c] * x.shape[1] + [0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        w -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (p - y) + ridge @ w)
    return w


@pytest.mark.parametrize("c", [0.05, 1.0])
def test_logistic_penalty_is_the_summed_one(data, c):
    df, x, y = data
    fitted = models.fit_model(df, "logistic_regression", FEATURES, "Class", {"C": c}).stages[-1]
    want = newton(x, y, c)
    assert np.allclose([*fitted.coefficients, fitted.intercept], want, atol=1e-3)


@pytest.mark.parametrize("c", [0.05, 1.0, 100.0])
def test_newton_fit(spark, data, tmp_path, c):
    df, x, y = data
    model = models.fit_model(df, "logistic_regression", FEATURES, "Class", {"C": c, "solver": "newton"})
    assert np.allclose([*model.stages[-1].coefficients, model.stages[-1].getOrDefault("intercept")], newton(x, y, c), atol=1e-8)
    loaded = models.load_model(models.save_model(model, str(tmp_path / "m")))
    assert scoring.model_score(df, loaded).exceptAll(scoring.model_score(df, model)).count() == 0
    assert models.importances(model, FEATURES).count() == 4


def test_newton_fit_with_weights_counts_rows_several_times(spark, data):
    df, _, _ = data
    heavy = df.withColumn("w", F.when(F.col("Class") == 1, 3.0).otherwise(1.0))
    twice = df.unionAll(df.where("Class = 1")).unionAll(df.where("Class = 1"))
    a, b = (models.fit_newton(d, FEATURES, "Class", 1.0, w) for d, w in ((heavy, "w"), (twice, None)))
    assert np.allclose([*a[0], a[1]], [*b[0], b[1]], atol=1e-8)


def test_newton_fit_refuses(spark, data):
    df, _, _ = data
    for bad in (df.where("Class = 0"), df.limit(0), df.withColumn("f0", F.when(F.col("id") == 3, None).otherwise(F.col("f0"))), df.withColumn("Class", F.col("Class") * 2)):
        with pytest.raises(ValueError):
            models.fit_newton(bad, FEATURES, "Class")
    with pytest.raises(ValueError):
        models.fit_model(df, "logistic_regression", FEATURES, "Class", {"penalty": "l1", "solver": "newton"})


@pytest.mark.parametrize("name,params", [("logistic_regression", {}), ("random_forest", {"n_estimators": 10}),
                                         ("gradient_boosting", {"n_estimators": 3, "max_depth": 2})])
def test_probabilities(data, name, params):
    df, _, y = data
    model = models.fit_model(df, name, FEATURES, "Class", params)
    scored = model.transform(df).select("probability").collect()
    p = np.array([r["probability"].toArray() for r in scored])
    assert p.shape == (300, 2) and np.allclose(p.sum(axis=1), 1) and p.min() >= 0 and p.max() <= 1
    top = models.importances(model, FEATURES).orderBy(F.desc(F.abs("importance"))).first()
    assert top["feature"] == "f0"


def test_unknown_model(data):
    with pytest.raises(ValueError):
        models.fit_model(data[0], "perceptron", FEATURES, "Class")


def test_failures_are_rows(data):
    df = data[0]
    fitted, results = models.train_all(df, df, ["random_forest", "perceptron"], FEATURES, "id", "Class", {"random_forest": {"n_estimators": 5}})
    rows = {r["model"]: r for r in results.collect()}
    assert list(fitted) == ["random_forest"] and rows["random_forest"]["error"] is None
    assert "perceptron" in rows["perceptron"]["error"] and rows["perceptron"]["pr_auc"] is None


def test_balanced_weights_raise_recall(spark):
    df, _, _ = table(spark, 1000, 0.01)
    plain = models.fit_model(df, "logistic_regression", FEATURES, "Class")
    weighted = models.fit_model(with_class_weights(df, "Class"), "logistic_regression", FEATURES, "Class", weight="weight")

    def flagged(model):
        return scoring.score_batch(df, model, 0.5).where("Class = 1").agg(F.sum("fraud_decision")).first()[0]

    assert flagged(weighted) > flagged(plain)


def test_save_load_describe(data, tmp_path):
    df = data[0]
    model = models.fit_model(df, "logistic_regression", FEATURES, "Class")
    loaded = models.load_model(models.save_model(model, str(tmp_path / "m")))
    assert scoring.model_score(df, loaded).exceptAll(scoring.model_score(df, model)).count() == 0
    info = {r["parameter"]: r["value"] for r in models.model_info(loaded, "lr").collect()}
    assert info["maxIter"] == "1000"


def test_list_and_promote(spark, data, tmp_path):
    df = data[0]
    model = models.fit_model(df, "logistic_regression", FEATURES, "Class")
    for name in ("b", "a"):
        models.save_model(model, str(tmp_path / "saved" / name))
    assert [r["name"] for r in models.list_models(spark, str(tmp_path / "saved")).orderBy("name").collect()] == ["a", "b"]
    plain = evaluation.score_promoted(df, evaluation.promote(model.stages, "a", str(tmp_path / "p"), 0.3))
    assert plain.exceptAll(scoring.score_batch(df, model, 0.3)).count() == 0
    sigmoids = calibration.Sigmoids([(2.0, -1.0), (4.0, -2.0)])
    tuned = evaluation.score_promoted(df, evaluation.promote(model.stages, "a", str(tmp_path / "q"), 0.3, sigmoids)).first()
    raw = plain.where(F.col("id") == tuned["id"]).first()["fraud_probability"]
    assert tuned["fraud_probability"] == pytest.approx((1 / (1 + np.exp(1 - 2 * raw)) + 1 / (1 + np.exp(2 - 4 * raw))) / 2)


def test_evaluation_job(spark, data, tmp_path):
    """Train, calibrate, compare, threshold, promote, load and score: what is loaded decides as the pieces do by hand."""
    df = data[0].withColumn("f1", F.col("f1") * 50 + 7)
    train, test = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    ranked, chosen = evaluation.evaluation_job(train, test, ["logistic_regression", "random_forest"], FEATURES, "id", "Class", str(tmp_path),
                                               params={"random_forest": {"n_estimators": 5}})
    rows = ranked.orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2] and rows[0]["pr_auc"] >= rows[1]["pr_auc"]
    assert all(r["use_calibrated"] == (r["calibrated_brier"] < r["original_brier"]) and r["reason"] is None for r in rows)
    best = chosen.first()
    assert best["best_model"] == rows[0]["model"] and best["threshold"] == rows[0]["threshold"]
    out = evaluation.score_promoted(test, str(tmp_path))
    assert out.columns == [*test.columns, "fraud_probability", "fraud_decision", "threshold"]
    assert out.select(*test.columns).exceptAll(test).count() == 0
    assert out.where("fraud_decision != CAST(fraud_probability >= threshold AS INT)").count() == 0
    assert out.first()["threshold"] == best["threshold"]
    unit = models.load_model(f"{tmp_path}/unit")
    scaler = unit.stages[0]
    mean = train.agg(F.avg("f1")).first()[0]
    assert scaler.getOrDefault("means")[1] == pytest.approx(mean) and bool(unit.stages[-1].getOrDefault("slopes")) == rows[0]["use_calibrated"]


@pytest.mark.parametrize("strategy", ["none", "class_weight", "under", "smote"])
def test_cross_validation(data, strategy):
    df = data[0]
    rows = {r["metric"]: r for r in models.cross_validate(df, "logistic_regression", FEATURES, "id", "Class", 3, strategy=strategy).collect()}
    assert set(rows) == {"pr_auc", "roc_auc", "f1"}
    assert 0.6 < rows["roc_auc"]["mean"] <= 1 and rows["roc_auc"]["std"] >= 0


def test_every_row_is_scored_once_by_another_fold(data):
    df = data[0]
    parts = models.fold_parts(df, FEATURES, "id", "Class", 3)
    for train, held_out in parts:
        assert train.join(held_out, "id").count() == 0
    scored = models.out_of_fold(parts, "logistic_regression", FEATURES, "id", "Class")
    assert scored.count() == 300 and scored.select("key").distinct().count() == 300


def test_search_spaces():
    every = search.distinct_settings("logistic_regression")
    assert len(every) == 6 * (2 + 5) and len({tuple(e.items()) for e in every}) == len(every)
    assert all(("l1_ratio" in e) == (e["penalty"] == "elasticnet") for e in every)
    assert len(search.draw("logistic_regression", 1000)) == len(every)  # all of them, each once
    assert len({tuple(d.items()) for d in search.draw("random_forest", 200)}) == 200
    drawn = search.draw("random_forest", 30)
    assert drawn == search.draw("random_forest", 30) != search.draw("random_forest", 30, seed=1)
    assert all(p[k] in v for p in drawn for k, v in search.SPACES["random_forest"].items())
    assert all(0.001 <= p["C"] <= 100 for p in search.draw("logistic_regression", 20, log_uniform=True))
    with pytest.raises(ValueError):
        search.draw("perceptron", 1)


def test_settings_reach_the_estimator():
    forest = models.random_forest({"max_depth": None, "max_features": None, "min_samples_leaf": 4, "n_estimators": 7}, "Class", 0)
    assert (forest.getMaxDepth(), forest.getFeatureSubsetStrategy(), forest.getMinInstancesPerNode(), forest.getNumTrees()) == (30, "all", 4, 7)
    lasso = models.logistic_regression({"penalty": "l1", "C": 2.0}, "Class", 50)
    assert (lasso.getElasticNetParam(), lasso.getRegParam()) == (1.0, 0.01)


def test_search_and_refit(data):
    df = data[0]
    best, trials = search.random_search(df, "logistic_regression", FEATURES, "id", "Class", trials=2, folds=2)
    rows = trials.orderBy("trial").collect()
    assert len(rows) == 2 and str(best["C"]) == max(rows, key=lambda r: (r["pr_auc_mean"], -r["trial"]))["params"]["C"]
    _, results = search.refit_best(df, df, "logistic_regression", best, FEATURES, "id", "Class")
    assert results.first()["roc_auc"] > 0.6


def test_search_summarises_all_trials_together(data, monkeypatch):
    df, calls = data[0], []
    summary = models.cv_summary
    for module in (models, search):
        monkeypatch.setattr(module, "cv_summary", lambda *a: calls.append(1) or summary(*a), raising=False)
    _, trials = search.random_search(df, "logistic_regression", FEATURES, "id", "Class", trials=3, folds=2)
    assert len(calls) == 1
    parts = models.fold_parts(df, FEATURES, "id", "Class", 2, 42)
    for row, params in zip(trials.orderBy("trial").collect(), search.draw("logistic_regression", 3)):
        alone = models.cross_validate_parts(parts, "logistic_regression", FEATURES, "id", "Class", params).where("metric = 'pr_auc'").first()
        assert (row["pr_auc_mean"], row["pr_auc_std"]) == pytest.approx((alone["mean"], alone["std"]))


def calibration_rows(spark, n=2000):
    rng = np.random.default_rng(0)
    p = rng.random(n).round(3)
    label = (rng.random(n) < p ** 3).astype(int)
    return spark.createDataFrame([(i, int(y), float(s)) for i, (y, s) in enumerate(zip(label, p))], "key int, label int, score double"), label, p


def test_calibration(spark):
    scored = calibration_rows(spark)[0]
    final, choice = calibration.calibrate(scored)
    row = choice.first()
    assert row["use_calibrated"] and row["calibrated_brier"] < row["original_brier"] and row["reason"] is None
    assert final.where("final != calibrated").count() == 0
    honest = scored.withColumn("calibrated", F.col("score"))
    assert calibration.calibration_choice(honest).first()["use_calibrated"] is False  # strictly better only


def test_sigmoids_minimise_the_smoothed_loss(spark):
    """Against plain Newton steps in numpy, on the rows outside each fold."""
    scored, label, p = calibration_rows(spark)
    fold = np.array([r["fold"] for r in scored.withColumn("fold", calibration.calibration_fold("key")).orderBy("key").collect()])
    assert set(fold) == set(range(5))
    got = calibration.platt_cross_fit(scored)[()].pairs
    for j in range(5):
        x, y = p[fold != j], label[fold != j]
        n1, n0 = y.sum(), (1 - y).sum()
        t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        a, w = np.stack([x, np.ones(len(x))], axis=1), np.zeros(2)
        for _ in range(50):
            q = 1 / (1 + np.exp(-a @ w))
            w -= np.linalg.solve((a * (q * (1 - q))[:, None]).T @ a, a.T @ (q - t))
        assert np.allclose(got[j], w, atol=1e-8)


def test_calibration_that_cannot_be_fitted(spark):
    schema = "model string, key int, label int, score double"
    rows = [("one class", k, 0, k / 50) for k in range(50)] + [("lone", k, int(k == 3), k / 50) for k in range(50)] + [("flat", k, k % 2, 0.5) for k in range(50)]
    rows += [("apart", k, int(k >= 25), float(k >= 25)) for k in range(50)]
    fits = calibration.platt_cross_fit(spark.createDataFrame(rows, schema), by=["model"])
    assert fits["one class",].reason and fits["lone",].reason and not fits["lone",].pairs
    assert fits["flat",].reason is None and all(abs(a * 0.5 + b) < 0.3 for a, b in fits["flat",].pairs)
    assert all(1 / (1 + np.exp(-(a + b))) > 0.9 and 1 / (1 + np.exp(-b)) < 0.1 for a, b in fits["apart",].pairs)  # finite for separable rows
    final, choice = calibration.calibrate(spark.createDataFrame(rows, schema), by=["model"])
    reasons = {r["model"]: (r["use_calibrated"], r["reason"]) for r in choice.collect()}
    assert reasons["lone"] == (False, calibration.ONE_CLASS) and final.where("model = 'lone' AND final != score").count() == 0
    empty, choice = calibration.calibrate(spark.createDataFrame(rows, schema).where("false"))
    assert empty.count() == 0 and choice.first()["reason"] == calibration.ONE_CLASS
    with pytest.raises(Exception, match="neither 0 nor 1"):
        calibration.platt_cross_fit(spark.createDataFrame([("m", 1, 2, 0.5)], schema))
    with pytest.raises(Exception, match="NULL or NaN"):
        calibration.platt_cross_fit(spark.createDataFrame([("m", 1, 1, None)], schema))


def test_catalog_uses_the_defaults(spark, monkeypatch):
    from txlab.catalog import QUERIES, modelling
    seen = {}
    monkeypatch.setattr(modelling.mo, "train_all", lambda train, test, names, f, k, l, params=None, **o: seen.setdefault("train", []).append((names, params)) or ({}, train.limit(0)))
    monkeypatch.setattr(modelling.mo, "cross_validate", lambda df, *a, **o: seen.update(cv=o) or df.limit(0))
    for name in ("fit_gbt", "train_all", "cross_validate_smote"):
        QUERIES[name](spark, "/root/testdata/sf0.001")
    assert seen["train"][0] == (["gradient_boosting"], {"gradient_boosting": {}})
    assert seen["train"][1] == (["logistic_regression", "random_forest", "gradient_boosting", "no_such_model"], None)
    assert seen["cv"] == {"strategy": "smote"}
