import hashlib
import logging

import numpy as np
import pytest
from pyspark.sql import functions as F

from txlab.operators import neighbours, prepare, resample, selection
from txlab.operators.validate import FEATURES
from txlab.plans.preparation import prepare_data


@pytest.fixture(scope="module")
def small(spark):
    rows = [(i, float(i), 100.0 * (i + 1), *[0.1 * (i + 1) * v for v in range(1, 29)], [0, 1, 0, 1, 0][i]) for i in range(5)]
    return spark.createDataFrame(rows, "id int, Time double, Amount double, " + ", ".join(f"V{v} double" for v in range(1, 29)) + ", Class int")


@pytest.fixture(scope="module")
def skewed(spark):
    """1,000 rows, 99 % of them in one class, and a class of a single row."""
    return spark.range(1000).selectExpr("id", "CASE WHEN id = 5 THEN 2 WHEN id % 111 = 0 THEN 1 ELSE 0 END AS Class", "cast(id AS double) AS x").cache()


def ordered(rows, seed=42):
    return sorted(rows, key=lambda k: (hashlib.md5(f"{k}:{seed}".encode()).hexdigest(), k))


def per_class(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["Class"], []).append(r["id"])
    return out


@pytest.mark.parametrize("include_time", [True, False])
def test_prepared_features(small, include_time):
    stats = prepare.scale_fit(small, ["Amount", "Time"])
    out = prepare.prepare_features(small, "id", stats, include_time=include_time)
    assert "Amount" not in out.columns and "Time" not in out.columns
    assert ("Time_scaled" in out.columns) == include_time
    assert len(out.columns) == 1 + 28 + 1 + include_time + 1
    values = [r["Amount_scaled"] for r in out.orderBy("id").collect()]
    amounts = np.array([100, 200, 300, 400, 500.0])
    assert np.allclose(values, (amounts - amounts.mean()) / amounts.std())


def test_scaler_edge_cases(spark, small):
    with pytest.raises(ValueError):
        prepare.scale_transform(small, None, ["Amount"])
    flat = spark.createDataFrame([(4.0, 1.0), (4.0, 2.0)], "flat double, free double")
    stats = prepare.scale_fit(flat, ["flat"])
    new = spark.createDataFrame([(6.0, 1.5)], "flat double, free double")
    row = prepare.scale_transform(new, stats, ["flat", "free"]).first()
    assert (row["flat"], row["free"]) == (2.0, 1.5)  # centred only; no statistics, no change


def test_cuts_match_a_plain_sort(skewed):
    wanted = {"few": F.lit(3), "fifth": F.round(F.col("n") * 0.2), "none": F.lit(0), "all": F.col("n"), "least": F.col("n_min")}
    marked = selection.with_cuts(skewed, "id", "Class", wanted, balanced=True).collect()
    classes = per_class(skewed)
    for name, count in {"few": lambda n: 3, "fifth": lambda n: round(n * 0.2), "none": lambda n: 0, "all": lambda n: n, "least": lambda n: 1}.items():
        for c, ids in classes.items():
            want = set(ordered(ids)[:count(len(ids))])
            assert {r["id"] for r in marked if r["Class"] == c and r[name]} == want, (name, c)


def test_splits_keep_class_shares(skewed):
    out = prepare.three_way_split(skewed, "id", "Class")
    assert out.count() == 1000
    info = {(r["split"], r["Class"]): r["count"] for r in out.groupBy("split", "Class").count().collect()}
    n0 = skewed.where("Class = 0").count()
    assert info[("test", 0)] == round(n0 * 0.2) and info[("test", 0)] + info[("val", 0)] == round(n0 * 0.36)
    again = prepare.three_way_split(skewed.repartition(7), "id", "Class")
    assert again.exceptAll(out).count() == 0  # independent of partitioning


def test_folds_are_even(skewed):
    sizes = prepare.fold_assign(skewed, "id", "Class", 5).groupBy("Class", "fold").count().collect()
    for c in (0, 1):
        counts = [r["count"] for r in sizes if r["Class"] == c]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_scaler_sees_only_training_rows(skewed):
    out = prepare.process_data(skewed, "id", "Class", ["x"])
    facts = out.where("split = 'train'").agg(F.avg("x"), F.stddev_pop("x")).first()
    assert abs(facts[0]) < 1e-9 and abs(facts[1] - 1) < 1e-9


def test_weights(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "Class int")
    weights = {r["Class"]: r["weight"] for r in resample.class_weights(df, "Class").collect()}
    assert weights == {0: pytest.approx(10 / 18), 1: 5.0}


def test_under_and_oversampling(skewed):
    under = resample.undersample(skewed, "id", "Class").groupBy("Class").count().collect()
    assert {r["count"] for r in under} == {1}
    over = resample.oversample(skewed, "id", "Class")
    sizes = {r["count"] for r in over.groupBy("Class").count().collect()}
    assert len(sizes) == 1 and over.select("id", "copy").distinct().count() == over.count()
    repeats = [r["count"] for r in over.where("Class = 1").groupBy("id").count().collect()]
    assert max(repeats) - min(repeats) <= 1


def test_unknown_strategy_is_reported(skewed, caplog):
    with caplog.at_level(logging.WARNING):
        out = resample.rebalance(skewed, "magic", "id", "Class", ["x"])
    assert out.count() == 1000 and "magic" in caplog.text


@pytest.mark.parametrize("chunk", [2048, 32, 2])
def test_neighbours_match_brute_force(spark, chunk, monkeypatch):
    """Clusters, a vector shared by a third of the rows, integer grid points with many ties."""
    if chunk == 2:
        monkeypatch.setattr(neighbours, "MAX_PIVOTS", 8)  # large cells, divided into rings
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(80, 3)), np.repeat(rng.normal(size=(1, 3)), 70, axis=0),
                   rng.integers(0, 2, size=(40, 3)), rng.normal(size=(20, 3)) * 0.01 + 4]).round(3)
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double, c double")
    got = {}
    for r in neighbours.nearest_rows(df, "id", ["a", "b", "c"], 4, chunk).collect():
        got.setdefault(r["key"], {})[r["rank"]] = (r["neighbour"], r["distance"], tuple(r["vector"]))
    d = neighbours._distances(x, x)
    for i in range(len(x)):
        want = sorted((d[i, j], j) for j in range(len(x)) if j != i)[:4]
        assert [got[i][k][0] for k in (1, 2, 3, 4)] == [j for _, j in want]
        assert got[i][1][2] == tuple(x[want[0][1]])


def test_neighbours_need_complete_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None)], "id int, a double")
    with pytest.raises(Exception, match="complete features"):
        neighbours.nearest_rows(df, "id", ["a"]).collect()


def test_synthetic_rows_lie_between_neighbours(spark):
    rng = np.random.default_rng(4)
    rows = [(i, *map(float, rng.normal(size=2)), int(i < 12)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a double, b double, Class int")
    out = resample.smote(df, "id", "Class", ["a", "b"], k=3)
    assert {r["Class"]: r["count"] for r in out.groupBy("Class").count().collect()} == {0: 48, 1: 48}
    x = np.array([r[1:3] for r in rows[:12]])
    d = neighbours._distances(x, x)
    for r in out.where("copy > 0").collect():
        near = np.argsort(d[r["id"]] + np.where(np.arange(12) == r["id"], np.inf, 0))[:3]
        p, base = np.array([r["a"], r["b"]]), x[r["id"]]
        gaps = [np.linalg.norm(p - base) + np.linalg.norm(p - x[j]) - np.linalg.norm(base - x[j]) for j in near]
        assert min(gaps) < 1e-9


def test_preparation_end_to_end(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i, float(i), float(rng.random() * 1000), *map(float, rng.normal(size=28)), int(i % 5 == 0)) for i in range(100)]
    raw = spark.createDataFrame(rows, "id int, Time double, Amount double, " + ", ".join(f"{v} double" for v in FEATURES) + ", Class int")
    data, stats, info = prepare_data(raw, "id", strategy="over", path=str(tmp_path / "data"))
    sizes = {r["split"]: (r["total"], r["positive"]) for r in info.collect()}
    assert sizes == {"train": (128, 64), "test": (20, 4)}
    assert {r["Class"] for r in data.select("Class").distinct().collect()} == {0, 1}
    assert not {"Amount", "Time"} & set(data.columns) and stats.count() == 2


@pytest.mark.parametrize("small", [10_000, 5, 1])
def test_selection_with_repeated_keys_and_rows(spark, small):
    """Keys that occur three times, rows that occur many times: sizes are exact at every level of refinement."""
    from txlab.operators.selection import with_cuts
    rows = [(k // 3, k % 7, "a") for k in range(300)] + [(1, 1, "b")] * 200 + [(k, 0, "b") for k in range(50)] + [(None, None, "c")] * 7
    df = spark.createDataFrame(rows, "id int, v int, label string").repartition(5)
    wanted = {"x": F.floor(F.col("n") * 0.37), "y": F.floor(F.col("n") * 0.9), "none": F.lit(0), "all": F.col("n") + 5}
    out = with_cuts(df, "id", "label", wanted, small=small)
    got = {r["label"]: r for r in out.groupBy("label").agg(F.count("*").alias("n"), *[F.count_if(c).alias(c) for c in wanted], F.count_if(F.expr("x AND NOT y")).alias("odd")).collect()}
    for label, n in (("a", 300), ("b", 250), ("c", 7)):
        r = got[label]
        assert (r["n"], r["x"], r["y"], r["none"], r["all"], r["odd"]) == (n, n * 37 // 100, n * 9 // 10, 0, n, 0)
    assert out.select("id", "v", "label").exceptAll(df).count() == 0


def test_copies_of_one_row_are_dealt_out(spark):
    from txlab.operators import resample
    made = spark.createDataFrame([(1, 100_000, "x"), (2, 3, "y"), (3, 0, "z")], "id int, _made int, v string").coalesce(1)
    for first in (0, 1):
        out = resample._each_copy(made, "id", first, copies=1000)
        got = {r["id"]: (r["n"], r["d"], r["low"], r["high"]) for r in out.groupBy("id").agg(
            F.count("*").alias("n"), F.count_distinct("copy").alias("d"), F.min("copy").alias("low"), F.max("copy").alias("high")).collect()}
        want = {1: (100_001 - first, 100_001 - first, first, 100_000), 2: (4 - first, 4 - first, first, 3)}
        assert got == want | ({3: (1, 1, 0, 0)} if first == 0 else {})
    # the rows made from one row come out of more than one task
    dealt = resample._each_copy(made, "id", 0, copies=1000).where("id = 1").withColumn("p", F.spark_partition_id())
    assert dealt.select("p").distinct().count() > 1
