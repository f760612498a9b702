import numpy as np
import pytest
from pyspark.sql import functions as F

from txlab.operators import metrics as m
from txlab.plans.evaluation import evaluate_and_store

TIES = [(1, 1, 0.9), (2, 0, 0.9), (3, 1, 0.7), (4, 0, 0.7), (5, 0, 0.7), (6, 1, 0.4), (7, 0, 0.2), (8, 0, 0.2)]
SCHEMA = "key int, label int, score double"


@pytest.fixture(scope="module")
def ties(spark):
    return spark.createDataFrame(TIES, SCHEMA)


@pytest.fixture(scope="module")
def many(spark):
    """3,000 rows over many scores, a third of them on one score."""
    rng = np.random.default_rng(0)
    score = np.where(rng.random(3000) < 0.33, 0.3, rng.random(3000).round(4))
    label = (rng.random(3000) < score * 0.4).astype(int)
    return spark.createDataFrame([(i, int(y), float(s)) for i, (y, s) in enumerate(zip(label, score))], SCHEMA).cache()


def brute(rows):
    y, s = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    p, n = y.sum(), (1 - y).sum()
    points, ap, before = [], 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        tp, fp = y[s >= t].sum(), (1 - y)[s >= t].sum()
        points.append((t, tp / (tp + fp), tp / p, fp / n))
        ap += (tp / p - before) * tp / (tp + fp)
        before = tp / p
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]])
    return points, ap, auc


@pytest.mark.parametrize("which", ["ties", "many"])
def test_curves_and_areas(request, which):
    df = request.getfixturevalue(which)
    points, ap, auc = brute([tuple(r) for r in df.select("key", "label", "score").collect()])
    curve = m.score_curve(df, "label", "score")
    pr = {r["threshold"]: (r["precision"], r["recall"]) for r in m.pr_curve(curve).collect()}
    roc = {r["threshold"]: (r["fpr"], r["tpr"]) for r in m.roc_curve(curve).collect()}
    assert len(pr) == len(points) + 1 and pr[None] == (1.0, 0.0) and roc[float("inf")] == (0.0, 0.0)
    for t, precision, recall, fpr in points:
        assert pr[t] == pytest.approx((precision, recall)) and roc[t] == pytest.approx((fpr, recall))
    assert m.average_precision(curve).first()["pr_auc"] == pytest.approx(ap)
    assert m.roc_auc(curve).first()["roc_auc"] == pytest.approx(auc)
    good = [(-precision, t) for t, precision, recall, _ in points if recall >= 0.9]
    assert m.optimal_threshold(curve).first()["threshold"] == min(good)[1]


def test_unreachable_recall_falls_back(ties):
    assert m.optimal_threshold(m.score_curve(ties, "label", "score"), min_recall=1.1).first()["threshold"] == 0.5


def test_top_share(ties, many, monkeypatch):
    rows = sorted([tuple(r) for r in many.collect()], key=lambda r: (-r[2], r[0]))
    positives = sum(r[1] for r in rows)
    for small in (m.SMALL_ROWS, 0):  # top-k, and ordering by range beyond it
        monkeypatch.setattr(m, "SMALL_ROWS", small)
        for r in m.precision_recall_at_k(many, "key", "label", "score", (0.1, 0.75, 0.05)).collect():
            hits = sum(x[1] for x in rows[:int(3000 * r["k"])])
            assert r["precision_at_k"] == pytest.approx(hits / int(3000 * r["k"]))
            assert r["recall_at_k"] == pytest.approx(hits / positives)
    assert [tuple(r) for r in m.precision_recall_at_k(ties, "key", "label", "score", (0.1,)).collect()] == [(0.1, 0, 0.0, 0.0)]


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_only(spark, label):
    df = spark.createDataFrame([(i, label, 0.1 * i) for i in range(5)], SCHEMA).withColumn("p", F.lit(1 - label))
    row = m.binary_metrics(df, "label", "p", "score").first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"], row["roc_auc"]) == (0.0, 0.0, 0.0, 0.0, 0.0)
    assert m.average_precision(m.score_curve(df, "label", "score")).first()["pr_auc"] == float(label)
    report = {r["name"]: r["support"] for r in m.classification_report(df, "label", "p").collect()}
    assert report["accuracy"] == 5 and report[str(label)] == 5 and report[str(1 - label)] == 0


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA).withColumn("p", F.lit(0))
    curve = m.score_curve(df, "label", "score")
    assert m.average_precision(curve).first()["pr_auc"] == 0.0 and m.roc_auc(curve).first()["roc_auc"] == 0.0
    assert m.optimal_threshold(curve).first()["threshold"] == 0.5
    assert m.precision_recall_at_k(df, "key", "label", "score").first()["precision_at_k"] == 0.0
    assert [r["n"] for r in m.confusion_matrix(df, "label", "p").collect()] == [0, 0, 0, 0]


def test_rates_at_a_threshold(spark, ties):
    row = m.metrics_at_threshold(ties, "label", "score", spark.createDataFrame([(0.7,)], "threshold double")).first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (2, 3, 1, 2)
    assert row["precision"] == 0.4 and row["recall"] == pytest.approx(2 / 3)


def test_models_side_by_side(spark, ties, tmp_path):
    flipped = ties.withColumn("score", 1 - F.col("score")).withColumn("model", F.lit("bad"))
    scored = ties.withColumn("model", F.lit("good")).unionByName(flipped)
    ranked, chosen = evaluate_and_store(scored, str(tmp_path))
    assert [r["model"] for r in ranked.orderBy("rank").collect()] == ["good", "bad"]
    winner = chosen.first()
    assert (winner["best_model"], winner["runner_up"]) == ("good", "bad")
    assert spark.read.json(str(tmp_path / "threshold")).first()["threshold"] == winner["threshold"]
    alone = m.metrics_at_threshold(ties, "label", "score", chosen.select("threshold")).first()
    row = ranked.where("model = 'good'").first()
    assert (row["best_precision"], row["best_recall"]) == pytest.approx((alone["precision"], alone["recall"]))
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 2


def test_formatting(spark):
    df = spark.createDataFrame([("a", 0.123456), ("b", 1.0)], "metric string, value double")
    assert [r["value"] for r in m.format_metrics(df).collect()] == ["0.1235", "1.0000"]
