import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txlab.operators import correlation, histogram, profile, quantiles, validate
from txlab.plans.eda import eda_report

NAN = float("nan")


def test_missing_values_per_column(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("Time,Amount,V1,V2,Class\n0,100,0.1,,0\n1,,0.2,0.3,0\n2,300,0.4,0.5,1\n")
    df = spark.read.option("header", True).option("inferSchema", True).csv(str(path))
    found = {r["column"]: r["missing"] for r in validate.null_counts(df).collect()}
    assert found == {"Time": 0, "Amount": 1, "V1": 0, "V2": 1, "Class": 0}
    counts = {r["Class"]: r["n"] for r in profile.class_distribution(df, "Class").collect()}
    assert counts == {0: 2, 1: 1}


def test_nan_and_null_are_both_missing(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (None,)], "x double")
    assert validate.null_counts(df).first()["missing"] == 2
    row = profile.describe(df).first()
    assert (row["count"], row["mean"], row["p50"], row["max"]) == (1, 1.0, 1.0, 1.0) and row["std"] is None


def test_required_columns(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "id long, Time string, Extra double")
    with pytest.raises(ValueError, match="Amount"):
        validate.require(df, ["Amount", "Time"])
    with pytest.raises(ValueError, match="Time"):
        validate.require(df, ["Time"])
    assert validate.project_required(df, "id", ["Extra"]).columns == ["id", "Extra"]
    checks = {(r["check"], r["column"]): r["ok"] for r in validate.schema_check(df, ["Time", "Amount"]).collect()}
    assert checks[("present", "Amount")] is False and checks[("numeric", "Time")] is False
    assert checks[("expected", "Extra")] is False


def test_negative_amount_and_time_are_rejected(spark):
    df = spark.createDataFrame([(1, 0.0, 100.0), (2, 1.0, -100.0), (3, -1.0, 5.0), (4, -1.0, None)], "id int, Time double, Amount double")
    rules = validate.non_negative("Amount", "Time")
    good, bad = validate.quarantine(df, rules)
    assert [r["id"] for r in good.collect()] == [1]
    assert {r["id"]: list(r["failed"]) for r in bad.collect()} == {
        2: ["Amount_non_negative"], 3: ["Time_non_negative"], 4: ["Amount_non_negative", "Time_non_negative"]}
    with pytest.raises(ValueError, match="Amount_non_negative"):
        validate.reject_all_on_violation(df, rules)
    assert validate.reject_all_on_violation(good, rules).count() == 1


def test_one_class_only(spark):
    df = spark.createDataFrame([(0,), (0,)], "Class int")
    row = profile.imbalance(df, "Class").first()
    assert row["imbalance_ratio"] == math.inf and row["positive_rate"] == 0.0
    assert profile.imbalance(spark.createDataFrame([(1,)], "Class int"), "Class").first()["imbalance_ratio"] == 0.0


def test_empty_table(spark):
    df = spark.createDataFrame([], "x double, Class int")
    assert profile.describe(df, ["x"]).first()["count"] == 0
    assert profile.imbalance(df, "Class").first()["total_rows"] == 0
    assert profile.duplicate_rows(df).first()["duplicates"] == 0
    assert profile.class_distribution(df, "Class").count() == 0
    assert correlation.correlation_pairs(df, ["x", "Class"]).first()["r"] is None
    assert histogram.histogram(df, "x", 5).count() == 0
    assert validate.validation_report(df, ["x"], "Class").where("metric = 'positive_rate'").first()["value"] == 0.0


def test_duplicates_treat_missing_values_alike(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (NAN,), (None,)], "x double")
    row = profile.duplicate_rows(df).first()
    assert (row["total_rows"], row["duplicates"], row["duplicate_pct"]) == (5, 3, 60.0)


@pytest.mark.parametrize("one_task", [2_000_000, 0])
def test_exact_quantiles_on_awkward_columns(spark, monkeypatch, one_task):
    monkeypatch.setattr(quantiles, "ONE_TASK_ROWS", one_task)
    rng = np.random.default_rng(1)
    n = 3001
    hot = np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n))
    data = {"normal": rng.normal(size=n), "hot": hot, "few": rng.integers(0, 3, n).astype(float), "flat": np.full(n, 2.5)}
    df = spark.createDataFrame([tuple(float(v[i]) for v in data.values()) for i in range(n)], ", ".join(f"{c} double" for c in data))
    probs = (0.0, 0.1, 0.25, 0.5, 0.999, 1.0)
    got = {(r["feature"], r["prob"]): r["value"] for r in quantiles.exact_quantiles(df, list(data), probs).collect()}
    for c, v in data.items():
        for p in probs:
            assert got[(c, p)] == pytest.approx(np.quantile(v, p), abs=1e-12), (c, p)


def test_a_wrong_sketch_does_not_change_the_answer(spark, monkeypatch):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    real = F.percentile_approx
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda c, p, a: real(c, [0.9] * len(p), a))
    assert quantiles.exact_quantiles(df, ["x"], (0.5,)).first()["value"] == 499.5


def test_approx_quantiles(spark):
    df = spark.range(100_001).select(F.col("id").cast("double").alias("x"))
    got = [r["value"] for r in quantiles.approx_quantiles(df, ["x"]).orderBy("prob").collect()]
    assert np.allclose(got, [25_000, 50_000, 75_000], atol=20)


@pytest.mark.parametrize("limit", [50, 2])
def test_correlations_with_missing_and_constant_columns(spark, monkeypatch, limit):
    monkeypatch.setattr(correlation, "MAX_PAIRWISE", limit)
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=60), rng.normal(size=60)
    rows = [(float(a), None if i % 7 == 0 else float(b), NAN if i % 5 == 0 else float(a + b), 3.0, int(i % 2))
            for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x double, y double, z double, flat double, Class int")
    pdf = df.toPandas().astype(float)
    want = pdf.corr()
    for r in correlation.correlation_pairs(df, df.columns).collect():
        if "flat" in (r["a"], r["b"]):
            assert r["r"] is None
        else:
            assert r["r"] == pytest.approx(want.loc[r["a"], r["b"]], abs=1e-12)
    top = correlation.target_correlation(df, "Class", 2).collect()
    best = want["Class"].drop("Class").abs().sort_values(ascending=False)
    assert [t["feature"] for t in top] == list(best.index[:2])
    assert len(correlation.correlation_matrix(df, "Class", 2).collect()) == 9


def test_wide_tables_use_tiles(spark, monkeypatch):
    monkeypatch.setattr(correlation, "MAX_PAIRWISE", 2)
    df = spark.range(50).selectExpr("cast(id AS double) AS a", "cast(id * 2 AS double) AS b", "cast(id % 7 AS double) AS c")
    rows = {(r["a"], r["b"]): r["r"] for r in correlation.correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert rows[("a", "b")] == pytest.approx(1.0) and abs(rows[("a", "c")]) < 0.3
    assert [(r["a"], r["b"]) for r in correlation.perfect_correlations(df).collect()] == [("a", "b")]


@pytest.mark.parametrize("stripe", [1024, 128])
def test_200_columns_with_gaps(spark, monkeypatch, stripe):
    monkeypatch.setattr(correlation, "STRIPE", stripe)
    rng = np.random.default_rng(5)
    cells = rng.normal(size=(400, 200)) * 10.0 ** rng.integers(-3, 6, size=200) + 1e6
    cells[:, 1] = cells[:, 0] * 3 + 1
    cells[rng.random(cells.shape) < 0.2] = np.nan
    cells[:, 7], cells[:200, 8], cells[200:, 9], cells[5, 11] = 4.0, np.nan, np.nan, np.inf  # 8 and 9 share no row
    names = [f"c{k}" for k in range(200)]
    table = pd.DataFrame(cells, columns=names)
    got = {(r["a"], r["b"]): r["r"] for r in correlation.correlation_pairs(spark.createDataFrame(table).repartition(5), names).collect()}
    want = (table.drop(columns=["c7", "c11"]) - 1e6).corr()  # shifted, as pandas loses digits of values far from 0
    assert len(got) == 200 * 199 // 2
    for (a, b), r in got.items():
        if {a, b} & {"c7", "c11"} or {a, b} == {"c8", "c9"}:
            assert r is None
        else:
            assert r == pytest.approx(want.loc[a, b], abs=1e-9)


def test_variance_checks(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1e-5, 0), (2.0, 5.0, 2e-5, 0)], "x double, flat double, faint double, Class int")
    assert {r["feature"] for r in profile.zero_variance(df).collect()} == {"flat", "Class"}
    assert {r["feature"] for r in profile.low_variance(df, "Class").collect()} == {"flat", "faint"}


def test_histogram_closes_its_last_bin_and_fills_gaps(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (NAN,)], "x double")
    rows = histogram.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [2, 0, 0, 0, 1] and rows[-1]["hi"] == 10.0
    flat = histogram.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 4).orderBy("bin").collect()
    assert sum(r["n"] for r in flat) == 2 and (flat[0]["lo"], flat[-1]["hi"]) == (2.5, 3.5)
    area = histogram.density_histogram(df, "x", 5).select(F.sum(F.col("density") * (F.col("hi") - F.col("lo")))).first()[0]
    assert area == pytest.approx(1.0)


def test_report_has_every_section(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0), (2.0, 4.0, 1), (2.0, 4.0, 1)], "x double, twice double, Class int")
    report = eda_report(df, "Class", ["x"], bins=4)
    sections = {r["section"] for r in report.select("section").distinct().collect()}
    assert sections == {"summary", "missing", "describe", "class", "duplicates", "perfect_correlation",
                        "target_correlation", "histogram_x"}
    assert report.where("section = 'duplicates' AND metric = 'duplicates'").first()["value"] == 1.0


def test_report_by_class_with_matrix(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0), (2.0, 4.0, 1), (2.0, None, 1), (6.0, 4.0, 1), (9.0, 1.0, None)], "x double, y double, Class int")
    report = eda_report(df.where("Class IS NOT NULL"), "Class", ["x"], bins=4, by_class=True, matrix=True)
    got = {(r["name"], r["metric"]): r["value"] for r in report.where("section = 'class_histogram_x'").collect()}
    assert [got[f"1:{k}", "n"] for k in range(4)] == [2, 0, 0, 1] and sum(got[f"0:{k}", "n"] for k in range(4)) == 1
    assert (got["1:0", "lo"], got["1:3", "hi"]) == (2.0, 6.0)
    pairs = {r["name"] for r in report.where("section = 'correlation'").collect()}
    assert pairs == {"x~y", "x~Class", "y~Class"}
    assert eda_report(df.where("false"), "Class", ["x"], by_class=True, matrix=True).where("section = 'correlation'").count() == 3


def test_describe_reads_three_times(spark, tmp_path):
    """Two passes when it is called, for moments with the sketch and for the counts; its plan has the third."""
    spark.range(1000).selectExpr("id", "id % 7 AS b").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    out = profile.describe(df, ["id", "b"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 2  # the last pass, shown in both halves of an adaptive plan at most
    got = {r["feature"]: r for r in out.collect()}
    assert (got["id"]["p25"], got["id"]["p50"], got["id"]["max"], got["b"]["min"]) == (249.75, 499.5, 999.0, 0.0)
