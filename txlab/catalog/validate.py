"""Validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rounded
from ..operators import validate as v
from .registry import query
from .roles import GAPS, TX, gaps, table, transactions

COLUMNS = ["Time", "Amount", "User", "Ticks", "Hour"]


@query("schema_check", """
  WITH c AS (SELECT column_name, data_type FROM (DESCRIBE SELECT * FROM customer) AS d(column_name, data_type, n, k, de, e))
  SELECT 'present' AS "check", w.name AS "column", (c.column_name IS NOT NULL) AS ok
  FROM (VALUES ('c_acctbal'), ('c_custkey'), ('c_name'), ('c_risk')) AS w(name) LEFT JOIN c ON c.column_name = w.name
  UNION ALL
  SELECT 'numeric', w.name, c.data_type IN ('BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT')
  FROM (VALUES ('c_acctbal'), ('c_custkey'), ('c_name'), ('c_risk')) AS w(name) JOIN c ON c.column_name = w.name
  UNION ALL SELECT 'integer_label', 'c_nationkey', c.data_type IN ('BIGINT', 'INTEGER') FROM c WHERE column_name = 'c_nationkey'
  UNION ALL SELECT 'expected', column_name, false FROM c
  WHERE column_name NOT IN ('c_acctbal', 'c_custkey', 'c_name', 'c_risk', 'c_nationkey')""")
def schema_check(spark, folder):
    """Presence, type and extra columns of a table against what is required of it."""
    return v.schema_check(table(spark, folder, "customer"), ["c_acctbal", "c_custkey", "c_name", "c_risk"], "c_nationkey")


@query("project_required", f"""WITH {TX} SELECT event_id, round("Time", 6) AS "Time", "Amount" FROM tx""")
def project_required(spark, folder):
    """Key and required columns only."""
    return v.project_required(transactions(spark, folder), "event_id", ["Time", "Amount"]).withColumn(
        "Time", rounded(F.col("Time")))


@query("null_counts", f"""WITH {GAPS} """ + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE "{c}" IS NULL OR isnan("{c}"))::BIGINT AS missing FROM gaps"""
    for c in COLUMNS))
def null_counts(spark, folder):
    """Missing values (NULL or NaN) per column."""
    return v.null_counts(gaps(spark, folder), COLUMNS)


RULES = ["c_acctbal", "c_nationkey"]


@query("range_violations", """
  SELECT 'c_acctbal_non_negative' AS rule, count(*) FILTER (WHERE NOT c_acctbal >= 0)::BIGINT AS violations FROM customer
  UNION ALL SELECT 'c_nationkey_non_negative', count(*) FILTER (WHERE NOT c_nationkey >= 0)::BIGINT FROM customer""")
def range_violations(spark, folder):
    """How many rows break each range rule."""
    return v.range_violations(table(spark, folder, "customer"), v.non_negative(*RULES))


@query("quarantine_split", """
  SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal < 0 THEN 'rejected' ELSE 'accepted' END AS status,
         CASE WHEN c_acctbal < 0 THEN 'c_acctbal_non_negative' ELSE '' END AS failed
  FROM customer""")
def quarantine_split(spark, folder):
    """Every row either accepted, or rejected with the rules it breaks."""
    good, bad = v.quarantine(table(spark, folder, "customer"), v.non_negative(*RULES))
    columns = ["c_custkey", "c_acctbal"]
    return good.select(*columns, F.lit("accepted").alias("status"), F.lit("").alias("failed")).unionByName(
        bad.select(*columns, F.lit("rejected").alias("status"), F.array_join("failed", ",").alias("failed")))


@query("validation_report", f"""
  WITH {GAPS}
  SELECT 'rows' AS metric, '' AS name, count(*)::DOUBLE AS value FROM gaps
  UNION ALL SELECT 'columns', '', 7e0
  UNION ALL SELECT 'class_count', '0', count(*) FILTER (WHERE "Class" = 0)::DOUBLE FROM gaps
  UNION ALL SELECT 'class_count', '1', count(*) FILTER (WHERE "Class" = 1)::DOUBLE FROM gaps
  UNION ALL SELECT 'positive_rate', '', round(avg("Class"), 6) FROM gaps
  UNION ALL SELECT 'missing_columns', '', 1e0
  UNION ALL SELECT 'non_numeric_columns', '', 0e0
  UNION ALL SELECT 'missing_values', '', count(*) FILTER (WHERE "Amount" IS NULL)::DOUBLE
                   + count(*) FILTER (WHERE isnan("User"))::DOUBLE FROM gaps
  UNION ALL SELECT 'missing_values', 'Time', 0e0
  UNION ALL SELECT 'missing_values', 'Amount', count(*) FILTER (WHERE "Amount" IS NULL)::DOUBLE FROM gaps
  UNION ALL SELECT 'missing_values', 'User', count(*) FILTER (WHERE isnan("User"))::DOUBLE FROM gaps""")
def validation_report(spark, folder):
    """Rows, columns, class counts, positive rate and missing values in one pass."""
    report = v.validation_report(gaps(spark, folder), ["Time", "Amount", "User", "V1"], "Class")
    return report.withColumn("value", rounded(F.col("value")))
