import math

import numpy as np
import pytest
from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import functions as F

from txlab.functions import kolmogorov_tail, normal_cdf
from txlab.operators import drift as d, scoring as s
from txlab.operators.prepare import scale_fit
from txlab.operators.validate import non_negative
from txlab.plans.monitoring import advice, monitor_report
from txlab.plans.scoring import score_job


def frame(spark, **columns):
    names = list(columns)
    return spark.createDataFrame(list(zip(*[[float(x) for x in v] for v in columns.values()])), ", ".join(f"{n} double" for n in names))


def brute_ks(a, b):
    x = np.unique(np.concatenate([a, b]))
    return max(abs(np.searchsorted(np.sort(a), x, "right") / len(a) - np.searchsorted(np.sort(b), x, "right") / len(b)))


def test_two_sample_statistic(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=400).round(1), np.where(rng.random(300) < 0.4, 0.5, rng.normal(size=300).round(1))
    c, e = rng.random(400), rng.random(300) + 0.01
    out = {r["feature"]: r for r in d.detect_drift(frame(spark, x=a, y=c), frame(spark, x=b, y=e)).collect()}
    assert out["x"]["ks_statistic"] == pytest.approx(brute_ks(a, b)) and out["x"]["drift"]
    assert out["y"]["ks_statistic"] == pytest.approx(brute_ks(c, e)) and not out["y"]["drift"]
    assert (out["x"]["n_ref"], out["x"]["n_new"]) == (400, 300)


def test_missing_values_and_features_are_left_out(spark):
    ref = frame(spark, x=[1, 2, 3, float("nan")], only_ref=[1, 1, 1, 1])
    new = frame(spark, x=[1, 2, 3], only_new=[0, 0, 0])
    rows = d.detect_drift(ref, new).collect()
    assert [(r["feature"], r["n_ref"], r["ks_statistic"], r["p_value"]) for r in rows] == [("x", 3, 0.0, 1.0)]
    assert d.shared_features(ref, new, ["x", "only_ref", "nowhere"]) == (["x"], ["only_ref", "nowhere"])
    report = monitor_report(ref, new)
    assert report.where("name = 'only_ref' AND metric = 'skipped'").count() == 1
    assert report.where("metric = 'total_features'").first()["value"] == 1.0


def test_against_normal(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(2, 3, size=500)
    df = frame(spark, x=x, shifted=x + 1, flat=np.ones(500))
    stats = d.reference_stats(frame(spark, x=x, shifted=x, flat=np.ones(500)))
    out = {r["feature"]: r for r in d.ks_normal(df, stats).collect()}
    assert set(out) == {"x", "shifted"}  # no spread, no test
    known = stats.where("feature = 'x'").first()
    library = KolmogorovSmirnovTest.test(df, "x", "norm", known["mean"], known["std"]).first()
    assert out["x"]["ks_statistic"] == pytest.approx(library["statistic"], abs=1e-9)
    assert out["x"]["p_value"] == pytest.approx(library["pValue"], abs=0.02)
    assert out["shifted"]["p_value"] < 1e-3


def test_distribution_functions(spark):
    z = [-8.0, -6.5, -1.96, -0.1, 0.0, 0.7, 3.0, 6.9, 9.0]
    got = [r["c"] for r in frame(spark, z=z).select(normal_cdf(F.col("z")).alias("c")).collect()]
    assert np.allclose(got, [0.5 * math.erfc(-v / math.sqrt(2)) for v in z], atol=1e-14)
    rows = frame(spark, k=[0.0, 0.5, 1.0, 1.3581, 3.0]).select(kolmogorov_tail(F.col("k"), F.lit(1)).alias("p")).collect()
    assert np.allclose([r["p"] for r in rows], [1.0, 0.9639, 0.27, 0.05, 3.05e-8], atol=1e-4)


def test_summary_and_severity(spark):
    none = spark.createDataFrame([], "feature string, ks_statistic double, p_value double, drift boolean")
    row = d.drift_severity(d.drift_summary(none)).first()
    assert (row["total_features"], row["drift_percentage"], row["avg_ks_statistic"], row["avg_p_value"], row["severity"]) == (0, 0.0, 0.0, 1.0, "low")
    for drifted, severity in ((1, "low"), (2, "moderate"), (3, "high")):
        flags = spark.createDataFrame([(str(i), 0.1, 0.5, i < drifted) for i in range(10)], none.schema)
        row = advice(d.drift_severity(d.drift_summary(flags))).first()
        assert row["severity"] == severity and severity in row["recommendation"].lower()


def test_plot_data(spark):
    rng = np.random.default_rng(2)
    ref, new = frame(spark, x=rng.normal(size=200), y=rng.normal(size=200)), frame(spark, x=rng.normal(size=200) + 2, y=rng.normal(size=200))
    flags = d.detect_drift(ref, new)
    out = d.drift_plot_data(flags, new, d.reference_stats(ref)).groupBy("plot", "series").count().collect()
    assert {(r["plot"], r["series"]): r["count"] for r in out} == {("ks_histogram", "ks_statistic"): 20, ("density", "x"): 50, ("normal", "x"): 100}


RECORD = {"Time": 0.0, "Amount": 100.0, **{f"V{i}": i / 10 for i in range(1, 29)}}


def test_one_record(spark):
    df = spark.createDataFrame([(7, *RECORD.values(), "x")], "id int, " + ", ".join(f"{c} double" for c in RECORD) + ", Extra string")
    scorer = s.linear_score({"V1": 1.0, "Amount_scaled": 0.01}, -1.1)
    out, bad, summary = score_job(df, "id", list(RECORD), scorer, 0.5)
    row = out.first()
    assert set(out.columns) == {"id", *RECORD, "fraud_probability", "fraud_decision", "threshold"}
    assert row["fraud_probability"] == 0.5 and row["fraud_decision"] == 1  # at the threshold counts
    assert bad.count() == 0 and summary.first()["flagged"] == 1
    with pytest.raises(ValueError, match="V5"):
        score_job(df.drop("V5"), "id", list(RECORD), scorer, 0.5)


def test_bad_records_are_set_aside(spark):
    df = spark.createDataFrame([(1, 0.0, -100.0), (2, -1.0, 5.0), (3, 1.0, 5.0)], "id int, Time double, Amount double")
    out, bad, summary = score_job(df, "id", ["Time", "Amount"], s.linear_score({"Amount_scaled": 1.0}), 0.5, scale_fit(df, ["Amount"]))
    assert [r["id"] for r in out.collect()] == [3] and sorted(r["id"] for r in bad.collect()) == [1, 2]
    assert summary.first()["total"] == 1


def test_several_models(spark):
    df = spark.createDataFrame([(1, 2.0), (2, -1.0)], "id int, Amount double")
    scorers = {"a": F.lit(0.2), "b": F.lit(0.8)}
    rows = {(r["index"], r["model_name"]): r for r in s.predict_models(df, "id", scorers, 0.5, non_negative("Amount")).collect()}
    assert (rows[(1, "a")]["prediction"], rows[(1, "b")]["prediction"], rows[(1, "b")]["is_fraud"]) == (0, 1, True)
    assert rows[(2, "a")]["error"] and rows[(2, "a")]["probability"] is None
    assert s.predict_models(df, "id", scorers, 0.5, {}, model="b").count() == 2
    with pytest.raises(ValueError):
        s.predict_models(df, "id", scorers, 0.5, {}, model="c")
    with pytest.raises(ValueError):
        s.predict_models(df, "id", {}, 0.5, {})


def test_empty_batch(spark):
    df = spark.createDataFrame([], "id int, Amount double")
    row = s.score_summary(s.score_batch(df, F.lit(0.5), 0.5)).first()
    assert (row["total"], row["flagged"], row["flagged_rate"]) == (0, 0, 0.0)
    assert s.positive_rate(s.score_batch(df, F.lit(0.5), 0.5), 0.5).first()["positive_rate"] == 0.0


def test_exact_two_sample_law(spark):
    """Against the share of all orders of two samples, counted; and the closed form for equal sizes."""
    from itertools import combinations
    from math import comb

    from txlab.functions import exact_two_sample
    cases = [(n, m, k) for n, m in ((1, 1), (3, 4), (5, 5), (2, 7)) for k in range(n * m + 1)]
    rows = spark.createDataFrame([(n, m, k / (n * m)) for n, m, k in cases], "n long, m long, d double")
    got = {(r["n"], r["m"], round(r["d"] * r["n"] * r["m"])): r["p"] for r in rows.withColumn("p", exact_two_sample(F.col("d"), F.col("n"), F.col("m"))).collect()}
    for n, m, k in cases:
        hit = 0
        for first in combinations(range(n + m), n):
            x = y = most = 0
            for i in range(n + m):
                x, y = (x + 1, y) if i in first else (x, y + 1)
                most = max(most, abs(x * m - y * n))
            hit += most >= k
        assert got[n, m, k] == pytest.approx(hit / comb(n + m, n), abs=1e-12), (n, m, k)
    n = 60
    rows = spark.createDataFrame([(n, n, j / n) for j in (5, 12, 30)], "n long, m long, d double")
    for r in rows.withColumn("p", exact_two_sample(F.col("d"), F.col("n"), F.col("m"))).collect():
        j = round(r["d"] * n)
        want = 2 * sum((-1) ** (i - 1) * comb(2 * n, n - i * j) for i in range(1, n // j + 1)) / comb(2 * n, n)
        assert r["p"] == pytest.approx(want, rel=1e-9, abs=1e-14)
