import pytest
from pyspark.errors import AnalysisException

from txlab import session
from txlab.operators.validate import REQUIRED
from txlab.sources import artefacts, synthetic, tables


def csv(tmp_path, text):
    path = tmp_path / "in.csv"
    path.write_text(text)
    return str(path)


def test_csv_values_come_back(spark, tmp_path):
    path = csv(tmp_path, "Time,Amount,V1,V2,V3,Class\n0,100.5,0.1,0.2,0.3,0\n1,200.0,0.4,0.5,0.6,1\n")
    rows = tables.read_any(spark, path).orderBy("Time").collect()
    assert [r["Amount"] for r in rows] == [100.5, 200.0]
    assert [r["Class"] for r in rows] == [0, 1]


def test_explicit_schema(spark, tmp_path):
    header = ",".join(["Time", *[f"V{i}" for i in range(1, 29)], "Amount", "Class"])
    path = csv(tmp_path, header + "\n" + ",".join(["1"] * 30) + ",0\n")
    df = tables.read_csv(spark, path, tables.transaction_schema())
    assert df.dtypes[0] == ("Time", "double") and df.dtypes[-1] == ("Class", "int")
    assert df.count() == 1


def test_missing_file_and_unknown_suffix(spark, tmp_path):
    with pytest.raises(AnalysisException):
        tables.read_any(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(ValueError):
        tables.read_any(spark, "table.xlsx")


def test_written_table_is_kept_unless_forced(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.write_if_absent(spark.range(3), path).count() == 3
    assert tables.write_if_absent(spark.range(5), path).count() == 3
    assert tables.write_if_absent(spark.range(5), path, force=True).count() == 5


def test_reading_one_split_touches_only_its_files(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "if(id < 3, 'test', 'train') AS split")
    back = tables.write_splits(df, str(tmp_path / "s")).where("split = 'test'")
    assert back.count() == 3
    assert all("split=test" in f for f in back.inputFiles()) or "PartitionFilters: [isnotnull(split" in back._jdf.queryExecution().toString()


def test_template_has_no_rows(spark):
    template = tables.empty_template(spark)
    assert template.columns == REQUIRED and template.count() == 0


def test_threshold_precedence(spark, tmp_path):
    path = str(tmp_path / "threshold")
    artefacts.save_threshold(spark.createDataFrame([(0.25, "m")], "threshold double, model_name string"), path)
    saved = artefacts.load_threshold(spark, path)

    def value(column):
        return spark.range(1).select(column.alias("t")).first()["t"]

    assert value(artefacts.resolve_threshold(saved, 0.7)) == 0.7
    assert value(artefacts.resolve_threshold(saved)) == 0.25
    assert value(artefacts.resolve_threshold(None)) == 0.5


def test_runs_are_appended(spark, tmp_path):
    path = str(tmp_path / "runs")
    for value in (0.1, 0.2):
        results = spark.createDataFrame([("m", value)], "model string, pr_auc double")
        artefacts.record_runs(results, path, "model", ["pr_auc"], {"C": "1"})
    runs = artefacts.read_runs(spark, path)
    assert runs.count() == 2 and runs.select("run_id").distinct().count() == 2
    assert sorted(r["value"] for r in artefacts.run_metrics(runs).collect()) == [0.1, 0.2]
    assert runs.first()["params"] == {"C": "1"}


def test_synthetic_rows_do_not_depend_on_partitioning(spark):
    one = synthetic.synthetic_transactions(spark.range(0, 200, 1, 1), "id")
    many = synthetic.synthetic_transactions(spark.range(0, 200, 1, 7), "id")
    assert one.exceptAll(many).count() == 0
    assert set(one.columns) == {"id", *REQUIRED}
    facts = synthetic.sample_transactions(spark, 4000).selectExpr(
        "min(Time)", "max(Time)", "min(Amount)", "avg(V1)", "stddev(V1)", "corr(V1, V2)", "percentile(ln(Amount), 0.5)").first()
    assert 0 <= facts[0] and facts[1] < 172800 and facts[2] > 0
    assert abs(facts[3]) < 0.06 and abs(facts[4] - 1) < 0.06 and abs(facts[5]) < 0.06 and abs(facts[6] - 4.5) < 0.1


class Cluster:
    """The parts of a cluster session that decide where shared files go."""
    master, applicationId = "spark://host:7077", "app"

    def __init__(self, named=None):
        self.named, self.sparkContext, self.conf = named, self, self

    def getConf(self):
        return self

    def get(self, name, default=None):
        return self.named if name == "spark.checkpoint.dir" and self.named else default

    def getCheckpointDir(self):
        return None


def test_shared_folder_comes_from_the_session():
    assert session.shared_dir(Cluster("hdfs://shared/tmp/")) == "hdfs://shared/tmp"
    assert session.scratch_path(Cluster("hdfs://shared/tmp"), "x").startswith("hdfs://shared/tmp/txlab-app/x-")
    with pytest.raises(RuntimeError):  # never a machine-local folder on a cluster
        session.shared_dir(Cluster())


def test_frozen_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    assert session.freeze(spark.range(4)).count() == 4
    assert list(tmp_path.glob("txlab-*"))
    assert session.drop_scratch(spark) and not list(tmp_path.glob("txlab-*"))


@pytest.mark.parametrize("limit", [10, 1])
def test_lookup_join_is_the_same_broadcast_or_shuffled(spark, limit):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    small = spark.createDataFrame([("a", 10), (None, 30)], "k string, v int")
    rows = session.attach_small(df, small, ["k"], limit=limit).orderBy("id").collect()
    assert [(r["id"], r["k"], r["v"]) for r in rows] == [(1, "a", 10), (2, "b", None), (3, None, 30)]


def test_malformed_cells_are_named(spark, tmp_path):
    from pyspark.sql.types import StructType

    from txlab.operators import validate
    from txlab.sources import tables
    schema = StructType.fromDDL("id int, amount double, note string, day date")
    (tmp_path / "a.csv").write_text("id,amount,note,day\n1,2.5,x,2024-01-02\n2,abc,x,\n3, 7 ,,2024-13-01\n4.5,NaN,x,2024-01-02\n5,1\n6,1,x,2024-01-02,9\n,,,\n")
    rows = tables.read_checked_csv(spark, str(tmp_path / "a.csv"), schema)
    assert rows.schema[:4] == schema[:4]
    got = [(r["id"], r["amount"], r["malformed"]) for r in rows.collect()]
    assert [x[2] for x in got] == [[], ["amount"], ["day"], ["id"], ["*"], ["*"], []]
    assert [x[0] for x in got] == [1, 2, 3, None, 5, 6, None] and got[0][1] == 2.5 and got[2][1] == 7.0
    assert rows.select("id", "malformed").where("size(malformed) > 0").count() == 5  # also if other columns are pruned
    good, bad = validate.quarantine(rows, validate.well_formed() | validate.non_negative("amount"))
    assert good.count() == 1 and bad.count() == 6
    assert {r["column"]: r["malformed"] for r in validate.malformed_counts(rows, schema.names).collect()} == {"id": 1, "amount": 1, "note": 0, "day": 1, "*": 2}
    with pytest.raises(ValueError, match="amount"):
        tables.read_checked_csv(spark, str(tmp_path / "a.csv"), schema, strict=True)
    (tmp_path / "b.csv").write_text("id,amount,note,day\n1,2.5,x,2024-01-02\n")
    assert tables.read_checked_csv(spark, str(tmp_path / "b.csv"), schema, strict=True).count() == 1
