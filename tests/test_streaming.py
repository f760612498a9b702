import datetime as dt

import pytest
from pyspark.sql import functions as F

from txlab.operators.drift import detect_drift, reference_stats, value_counts
from txlab.operators.scoring import linear_score
from txlab.operators.validate import non_negative
from txlab.streaming import run_available, stream_drift, stream_score, stream_summary, stream_value_counts, window_drift
from txlab.streaming.jobs import drift_severity_of_batches, to_files

SCHEMA = "id int, ts timestamp, Amount double"
START = dt.datetime(2024, 1, 1)


def rows(spark, folder, items):
    spark.createDataFrame([(i, START + dt.timedelta(hours=h), a) for i, h, a in items], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def folders(tmp_path):
    return {n: str(tmp_path / n) for n in ("in", "out", "offsets", "drift", "offsets2")}


def scored(spark, folder):
    stream = spark.readStream.schema(SCHEMA).parquet(folder)
    return stream_score(stream, non_negative("Amount"), linear_score({"Amount": 0.1}, -1.0), 0.5)


def test_stream_equals_batch_over_restarts(spark, folders):
    for batch in range(2):  # the second run continues from the checkpoint
        rows(spark, folders["in"], [(batch * 10 + i, i, 5.0 * i - 5) for i in range(6)])
        run_available(to_files(scored(spark, folders["in"]), folders["out"], folders["offsets"], ["accepted"]))
    got = spark.read.parquet(folders["out"]).select("id", "fraud_probability", "fraud_decision")
    batch = stream_score(spark.read.parquet(folders["in"]), non_negative("Amount"), linear_score({"Amount": 0.1}, -1.0), 0.5)
    assert got.count() == 12 and got.exceptAll(batch.select(got.columns)).count() == 0
    bad = spark.read.parquet(folders["out"]).where("NOT accepted").collect()
    assert {r["id"] for r in bad} == {0, 10} and all(r["fraud_probability"] is None and list(r["failed"]) == ["Amount_non_negative"] for r in bad)


def test_late_events_are_dropped(spark, folders):
    def run():
        summary = stream_summary(scored(spark, folders["in"]).where("accepted"), "ts", "1 hour", "30 minutes")
        run_available(to_files(summary, folders["out"], folders["offsets"]))

    rows(spark, folders["in"], [(1, 0.1, 20.0), (2, 0.2, 0.0), (3, 5.0, 1.0)])
    run()
    rows(spark, folders["in"], [(4, 0.3, 20.0), (5, 9.0, 1.0)])  # id 4 is hours behind the watermark
    run()
    got = spark.read.parquet(folders["out"]).orderBy("window_start").collect()
    assert [(r["window_start"].hour, r["total"], r["flagged"]) for r in got] == [(0, 2, 1), (5, 1, 0)]


@pytest.mark.parametrize("stored", [True, False])
def test_drift_of_each_batch(spark, folders, stored):
    reference = spark.range(200).select(F.randn(1).alias("Amount"))
    rows(spark, folders["in"], [(i, i, 5.0 + i % 3) for i in range(60)])
    stream = spark.readStream.schema(SCHEMA).parquet(folders["in"])
    run_available(stream_drift(stream, reference_stats(reference), folders["drift"], folders["offsets2"], ["Amount"],
                               reference=None if stored else reference))
    flags = spark.read.parquet(folders["drift"])
    assert flags.where("drift").count() == 1
    assert drift_severity_of_batches(flags).first()["severity"] == "high"


def test_drift_of_windows_over_batches(spark, folders):
    reference = spark.createDataFrame([(float(k % 11), float(k)) for k in range(50)], "Amount double, other double")
    known = value_counts(reference, ["Amount"])

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folders["in"])
        run_available(to_files(stream_value_counts(stream, "ts", ["Amount"], "1 hour", "90 minutes"), folders["out"], folders["offsets"]))
        return spark.read.parquet(folders["out"])

    values = {0: [1.0, 1.0, 4.5, -2.0], 1: [10.0, 10.0, 10.0], 2: [0.0, 3.0, None, 7.0, 7.5]}
    # Hours 0 and 1 arrive in two batches, the second out of order but in time; hour 9 closes all others.
    rows(spark, folders["in"], [(1, 0.1, 1.0), (2, 0.2, 4.5), (3, 1.5, 10.0)])
    run()
    rows(spark, folders["in"], [(4, 0.3, 1.0), (5, 0.9, -2.0), (6, 1.6, 10.0), (7, 1.7, 10.0)] + [(8 + k, 2.2, v) for k, v in enumerate(values[2])])
    run()
    rows(spark, folders["in"], [(20, 9.0, 5.0)])
    run()
    rows(spark, folders["in"], [(21, 0.4, 99.0), (22, 15.0, 5.0)])  # the first of them is too late
    counts = run()
    got = {r["window_start"].hour: r for r in window_drift(counts, known).collect()}
    assert set(got) == {0, 1, 2, 9}
    for hour, amounts in values.items():
        new = spark.createDataFrame([(a,) for a in amounts], "Amount double")
        want = detect_drift(reference, new, ["Amount"]).first()
        for name in ("feature", "n_ref", "n_new", "drift"):
            assert got[hour][name] == want[name]
        assert got[hour]["ks_statistic"] == pytest.approx(want["ks_statistic"], abs=1e-12)
        assert got[hour]["p_value"] == pytest.approx(want["p_value"], abs=1e-12)
    assert window_drift(counts.where("false"), known).count() == 0
    assert window_drift(counts, known.where("false")).count() == 0
