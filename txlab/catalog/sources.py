"""Queries over readers, sinks and artefacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rounded
from ..operators import metrics as m
from ..operators.prepare import stratified_split
from ..plans.evaluation import evaluate_and_store
from ..session import scratch_path
from ..sources import artefacts as a, synthetic, tables as t
from .metrics import CHOSEN, CURVE, RESULTS
from .prepare import RANKED
from .registry import query
from .roles import FEATURES, SCORED, TX, scored, scored_models, sql_uniform, table, transactions


@query("csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_roundtrip(spark, folder):
    """Write CSV, read it with an explicit schema."""
    customers = table(spark, folder, "customer")
    path = t.write_csv(customers, scratch_path(spark, "csv"))
    return t.read_csv(spark, path, customers.schema)


@query("parquet_scan", "SELECT event_id, event_type, value FROM events")
def parquet_scan(spark, folder):
    """Read Parquet; only the wanted columns leave the files."""
    return t.read_parquet(spark, f"{folder}/events.parquet").select("event_id", "event_type", "value")


@query("read_any", """
  SELECT 'csv' AS source, count(*)::BIGINT AS n, round(sum(s_acctbal), 2) AS total FROM supplier
  UNION ALL SELECT 'parquet', count(*)::BIGINT, round(sum(s_acctbal), 2) FROM supplier""")
def read_any(spark, folder):
    """The reader chosen by the suffix of the path."""
    path = t.write_csv(table(spark, folder, "supplier"), scratch_path(spark, "supplier") + ".csv")
    out = None
    for source in (path, f"{folder}/supplier.parquet"):
        rows = t.read_any(spark, source).agg(
            F.lit(source.rsplit(".", 1)[1]).alias("source"), F.count(F.lit(1)).alias("n"), rounded(F.sum("s_acctbal"), 2).alias("total"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("csv_to_parquet", "SELECT c_custkey, c_acctbal FROM customer")
def csv_to_parquet(spark, folder):
    """Convert CSV to Parquet once."""
    customers = table(spark, folder, "customer")
    path = t.write_csv(customers, scratch_path(spark, "csv"))
    return t.csv_to_parquet(spark, path, scratch_path(spark, "parquet"), customers.schema).select("c_custkey", "c_acctbal")


@query("split_partitioned_write", f"""
  WITH {TX}, {RANKED}
  SELECT event_id, "Amount", "Class", 'test' AS split FROM ranked WHERE rn <= round(n * 0.2e0)""")
def split_partitioned_write(spark, folder):
    """Store both splits in one data set and read one: only its files are touched."""
    split = stratified_split(transactions(spark, folder), "event_id", "Class").select("event_id", "Amount", "Class", "split")
    return t.write_splits(split, scratch_path(spark, "splits")).where(F.col("split") == "test")


@query("write_if_absent", """
  SELECT 'first' AS attempt, round(sum(value), 2) AS total FROM events
  UNION ALL SELECT 'second', round(sum(value), 2) FROM events
  UNION ALL SELECT 'forced', round(sum(value * 2), 2) FROM events""")
def write_if_absent(spark, folder):
    """A table that is there is left alone unless forced."""
    values = table(spark, folder, "events").select("value")
    path, out = scratch_path(spark, "once"), None
    for attempt, factor, force in (("first", 1, False), ("second", 2, False), ("forced", 2, True)):
        found = t.write_if_absent(values.select((F.col("value") * factor).alias("value")), path, force)
        total = found.agg(rounded(F.sum("value"), 2).alias("total")).first()["total"]  # before the next write
        row = spark.range(1).select(F.lit(attempt).alias("attempt"), F.lit(total).alias("total"))
        out = row if out is None else out.unionByName(row)
    return out


@query("resolve_threshold", f"""
  WITH {SCORED}, {CURVE}, {CHOSEN}
  SELECT 'argument' AS case, 0.3::DOUBLE AS threshold UNION ALL SELECT 'saved', threshold FROM chosen
  UNION ALL SELECT 'default', 0.5::DOUBLE""")
def resolve_threshold(spark, folder):
    """Argument, else the stored threshold, else the default."""
    chosen = m.optimal_threshold(m.score_curve(scored(spark, folder), "label", "score"))
    path = a.save_threshold(chosen.withColumn("model_name", F.lit("partial")), scratch_path(spark, "threshold"))
    saved = a.load_threshold(spark, path)
    cases = {"argument": a.resolve_threshold(saved, 0.3), "saved": a.resolve_threshold(saved),
             "default": a.resolve_threshold(None)}
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("case"), v.alias("threshold")) for c, v in cases.items()])))


@query("run_table", f"""
  WITH {RESULTS} SELECT * FROM (UNPIVOT (SELECT model AS run_name, * EXCLUDE model FROM results)
                                ON COLUMNS(* EXCLUDE run_name) INTO NAME metric VALUE value)""")
def run_table(spark, folder):
    """Evaluate, append to the run table, read the metrics back."""
    path = scratch_path(spark, "models")
    evaluate_and_store(scored_models(spark, folder), path)
    return a.run_metrics(a.read_runs(spark, f"{path}/runs")).withColumn("value", rounded(F.col("value")))


def _digest(name: str) -> str:
    return f"md5(event_id::VARCHAR || ':42:{name}')"


def _normal(name: str, which: int = 0) -> str:
    d, pair = _digest(name), 2 * (which // 2)
    turn = "sin" if which % 2 else "cos"
    return f"(sqrt(-2e0 * ln(1e0 - {sql_uniform(d, pair)})) * {turn}(6.283185307179586e0 * {sql_uniform(d, pair + 1)}))"


@query("synthetic_transactions", f"""
  SELECT event_id, floor({sql_uniform(_digest("Time"))} * 172800)::DOUBLE AS "Time",
         round(exp(4.5e0 + 1.2e0 * {_normal("Amount")}), 2) AS "Amount", """ + ", ".join(
    f"""round({_normal(f"V{i // 4}", i % 4)} + CASE WHEN {sql_uniform(_digest("noisy"))} < 0.16e0
        THEN {_normal(f"noise{i // 4}", i % 4)} * 0.5e0 ELSE 0e0 END, 6) AS "{v}" """ for i, v in enumerate(FEATURES)) + " FROM events")
def synthetic_transactions(spark, folder):
    """One synthetic transaction per event key."""
    rows = synthetic.synthetic_transactions(table(spark, folder, "events"), "event_id")
    return rows.withColumns({v: rounded(F.col(v)) for v in FEATURES})


# customer as text in which some balances and nations are no numbers, some are empty, and some rows are too short
BROKEN = """broken AS (
  SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 OR c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
         CASE WHEN c_custkey % 11 = 0 OR c_custkey % 17 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
         c_custkey % 7 = 0 AS w1, c_custkey % 11 = 0 AND c_custkey % 17 <> 0 AS w2, c_custkey % 17 = 0 AS w3 FROM customer)"""


def _broken_csv(spark, folder) -> str:
    key, balance, nation = F.col("c_custkey"), F.col("c_acctbal").cast("string"), F.col("c_nationkey").cast("string")
    cells = [key.cast("string"), F.when(key % 7 == 0, "n/a").when(key % 13 == 0, "").otherwise(balance),
             F.when(key % 11 == 0, F.concat(nation, F.lit("x"))).otherwise(nation)]
    line = F.when(key % 17 == 0, F.concat_ws(",", *cells[:2])).otherwise(F.concat_ws(",", *cells))
    path = scratch_path(spark, "broken") + ".csv"
    whole = table(spark, folder, "customer").coalesce(1).select(line.alias("value"))
    header = spark.createDataFrame([("c_custkey,c_acctbal,c_nationkey",)], "value string")
    header.coalesce(1).union(whole).coalesce(1).write.text(path)
    return path


BROKEN_SCHEMA = "c_custkey long, c_acctbal double, c_nationkey int"


def _schema():
    from pyspark.sql.types import StructType
    return StructType.fromDDL(BROKEN_SCHEMA)


@query("malformed_cells", f"""
  WITH {BROKEN} SELECT c_custkey, c_acctbal, c_nationkey,
    concat_ws(',', CASE WHEN w1 THEN 'c_acctbal' END, CASE WHEN w2 THEN 'c_nationkey' END, CASE WHEN w3 THEN '*' END) AS malformed FROM broken""")
def malformed_cells(spark, folder):
    """A broken CSV: every row is read, and the cells that could not be are named."""
    rows = t.read_checked_csv(spark, _broken_csv(spark, folder), _schema())
    return rows.withColumn("malformed", F.array_join("malformed", ","))


@query("malformed_report", f"""
  WITH {BROKEN}
  SELECT 'rows' AS metric, '' AS name, count(*)::DOUBLE AS value FROM broken UNION ALL SELECT 'columns', '', 3
  UNION ALL SELECT 'class_count', '0', count(*) FILTER (WHERE c_nationkey = 0) FROM broken UNION ALL SELECT 'class_count', '1', count(*) FILTER (WHERE c_nationkey = 1) FROM broken
  UNION ALL SELECT 'positive_rate', '', round(count(*) FILTER (WHERE c_nationkey = 1) / count(*)::DOUBLE, 6) FROM broken
  UNION ALL SELECT 'missing_columns', '', 0 UNION ALL SELECT 'non_numeric_columns', '', 0
  UNION ALL SELECT 'missing_values', '', count(*) - count(c_acctbal) FROM broken UNION ALL SELECT 'missing_values', 'c_acctbal', count(*) - count(c_acctbal) FROM broken
  UNION ALL SELECT 'malformed_rows', '', count(*) FILTER (WHERE w1 OR w2 OR w3) FROM broken
  UNION ALL SELECT 'malformed_cells', 'c_custkey', 0 UNION ALL SELECT 'malformed_cells', 'c_acctbal', count(*) FILTER (WHERE w1) FROM broken
  UNION ALL SELECT 'malformed_cells', 'c_nationkey', count(*) FILTER (WHERE w2) FROM broken UNION ALL SELECT 'malformed_cells', '*', count(*) FILTER (WHERE w3) FROM broken""")
def malformed_report(spark, folder):
    """The validation report of a broken CSV counts what could not be read."""
    from ..operators.validate import validation_report
    rows = t.read_checked_csv(spark, _broken_csv(spark, folder), _schema())
    return validation_report(rows, ["c_acctbal"], "c_nationkey").withColumn("value", rounded(F.col("value")))


@query("stream_malformed", f"""
  WITH {BROKEN} SELECT c_custkey, NOT (w1 OR w2 OR w3) AND coalesce(c_acctbal >= 0, false) AS accepted,
    concat_ws(',', CASE WHEN w1 OR w2 OR w3 THEN 'well_formed' END, CASE WHEN NOT coalesce(c_acctbal >= 0, false) THEN 'c_acctbal_non_negative' END) AS failed,
    CASE WHEN NOT (w1 OR w2 OR w3) AND c_acctbal >= 0 THEN round(1 / (1 + exp(-(c_acctbal / 5000e0 - 1))), 6) END AS fraud_probability FROM broken""")
def stream_malformed(spark, folder):
    """The same file as a stream: malformed rows are rejected with the rule they break, the others scored."""
    from ..operators.scoring import PROBABILITY
    from ..operators.validate import non_negative, well_formed
    from ..streaming import jobs
    rows = t.read_checked_csv(spark, _broken_csv(spark, folder), _schema(), stream=True)
    score = rounded(1.0 / (1.0 + F.exp(-(F.col("c_acctbal") / 5000.0 - 1.0))))
    out = jobs.stream_score(rows, well_formed() | non_negative("c_acctbal"), score, 0.5)
    path = scratch_path(spark, "scored")
    jobs.run_available(jobs.to_files(out, path, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(path).select("c_custkey", "accepted", F.array_join("failed", ",").alias("failed"), PROBABILITY)


@query("csv_reports", f"""
  WITH {SCORED}, c AS (SELECT (score >= 0.5)::INTEGER AS p, label FROM scored)
  SELECT a::INTEGER AS actual, b::INTEGER AS predicted, (SELECT count(*) FROM c WHERE label = a AND p = b)::BIGINT AS n
  FROM (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS b)""")
def csv_reports(spark, folder):
    """A small report written as one CSV file and read back."""
    from pyspark.sql.types import StructType
    decided = scored(spark, folder).withColumn("p", (F.col("score") >= 0.5).cast("int"))
    path = t.write_csv(m.confusion_matrix(decided, "label", "p"), scratch_path(spark, "report"), single=True)
    return t.read_checked_csv(spark, path, StructType.fromDDL("actual int, predicted int, n long"), strict=True).drop("malformed")
