"""Streaming queries: the events file as a stream, processed until nothing is left."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rounded
from ..operators import drift as d
from ..operators.validate import non_negative
from ..session import freeze, scratch_path
from ..streaming import run_available, stream_drift, stream_score, stream_summary, stream_value_counts, window_drift
from ..streaming.jobs import to_files
from .drift import TAIL_AT, sql_tail
from .registry import query
from .roles import SIGMOID_AMOUNT, amount_score, table

FEE = 1.0  # amounts are taken net of it, so that some are negative


def _stream(spark, folder):
    schema = table(spark, folder, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    return rows.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", (F.col("value") - FEE).alias("Amount"))


def _scored(spark, folder):
    return stream_score(_stream(spark, folder), non_negative("Amount"), amount_score(), 0.5)


@query("stream_score", f"""
  WITH e AS (SELECT event_id, value - 1e0 AS "Amount" FROM events), p AS (SELECT *, {SIGMOID_AMOUNT} AS p, "Amount" >= 0 AS ok FROM e)
  SELECT event_id, ok AS accepted, CASE WHEN ok THEN p END AS fraud_probability, CASE WHEN ok THEN (p >= 0.5)::INTEGER END AS fraud_decision,
         CASE WHEN ok THEN '' ELSE 'Amount_non_negative' END AS failed FROM p""")
def stream_score_query(spark, folder):
    """Validate and score a stream; accepted and rejected rows in one partitioned sink."""
    out = scratch_path(spark, "scored")
    run_available(to_files(_scored(spark, folder), out, scratch_path(spark, "offsets"), ["accepted"]))
    return spark.read.parquet(out).select(
        "event_id", F.col("accepted").cast("boolean").alias("accepted"), "fraud_probability", "fraud_decision",
        F.array_join("failed", ",").alias("failed"))


@query("stream_score_summary", f"""
  WITH p AS (SELECT date_trunc('day', ts) AS day, value - 1e0 AS "Amount", {SIGMOID_AMOUNT.replace('"Amount"', "(value - 1e0)")} AS p FROM events
             WHERE value - 1e0 >= 0),
  closed AS (SELECT max(date_trunc('day', ts - INTERVAL 1 HOUR)) AS open_day FROM events)
  SELECT strftime(day, '%Y-%m-%d') AS day, count(*)::BIGINT AS total, sum((p >= 0.5)::INTEGER)::BIGINT AS flagged,
         round(avg(p), 6) AS mean_probability, min(p) AS min_probability, max(p) AS max_probability,
         round(avg((p >= 0.5)::INTEGER), 6) AS flagged_rate
  FROM p, closed WHERE day < open_day GROUP BY day""")
def stream_score_summary(spark, folder):
    """Summary per day of event time; the last day stays open until the watermark passes it."""
    summary = stream_summary(_scored(spark, folder).where("accepted"), "ts")
    out = scratch_path(spark, "summary")
    run_available(to_files(summary, out, scratch_path(spark, "offsets")))
    return spark.read.parquet(out).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "total", "flagged", rounded(F.col("mean_probability")).alias("mean_probability"),
        "min_probability", "max_probability", rounded(F.col("flagged_rate")).alias("flagged_rate"))


@query("stream_drift", f"""
  WITH s AS (SELECT avg(value - 1e0) AS m, stddev_samp(value - 1e0) AS sd FROM events),
  cells AS (SELECT value - 1e0 AS value, count(*) AS w FROM events GROUP BY value),
  z AS (SELECT (value - m) / sd AS z, w, sum(w) OVER (ORDER BY value ROWS UNBOUNDED PRECEDING) AS upto, sum(w) OVER () AS n FROM cells, s),
  e AS (SELECT *, CASE WHEN z > 0 THEN 1e0 - tail ELSE tail END AS f
        FROM (SELECT *, CASE WHEN abs(z) > 7 THEN 0e0 ELSE {TAIL_AT} END AS tail FROM z)),
  ks AS (SELECT max(n)::BIGINT AS n_new, max(greatest(abs(upto / n::DOUBLE - f), abs(f - (upto - w) / n::DOUBLE))) AS ks_statistic FROM e),
  p AS (SELECT *, {sql_tail("n_new::DOUBLE")} AS p_value FROM ks)
  SELECT 0 AS batch, 'Amount' AS feature, n_new, round(ks_statistic, 6) AS ks_statistic, round(p_value, 6) AS p_value,
         p_value < 0.05 AS drift FROM p""")
def stream_drift_query(spark, folder):
    """Each micro-batch against stored statistics of the same table."""
    events = table(spark, folder, "events").select((F.col("value") - FEE).alias("Amount"))
    stats = freeze(d.reference_stats(events, ["Amount"], exact=False), "stats")
    out = scratch_path(spark, "drift")
    run_available(stream_drift(_stream(spark, folder), stats, out, scratch_path(spark, "offsets"), ["Amount"]))
    return spark.read.parquet(out).select(
        "batch", "feature", "n_new", rounded(F.col("ks_statistic")).alias("ks_statistic"), rounded(F.col("p_value")).alias("p_value"), "drift")


@query("stream_drift_windows", """
  WITH e AS (SELECT date_trunc('day', ts) AS day, value - 1e0 AS value FROM events WHERE value IS NOT NULL),
  closed AS (SELECT max(date_trunc('day', ts - INTERVAL 1 HOUR)) AS open_day FROM events),
  r AS (SELECT value, sum(count(*)) OVER (ORDER BY value) AS r FROM e GROUP BY value),
  d AS (SELECT day, count(*) AS n FROM e, closed WHERE day < open_day GROUP BY day),
  c AS (SELECT day, value, count(*) AS w FROM e GROUP BY day, value),
  g AS (SELECT d.day, n, r.value, r, sum(coalesce(w, 0)) OVER (PARTITION BY d.day ORDER BY r.value) AS upto
        FROM d CROSS JOIN r LEFT JOIN c ON c.day = d.day AND c.value = r.value)
  SELECT strftime(day, '%Y-%m-%d') AS day, 'Amount' AS feature, (SELECT count(*) FROM e)::BIGINT AS n_ref, max(n)::BIGINT AS n_new,
         round(max(abs(r / (SELECT count(*) FROM e)::DOUBLE - upto / n::DOUBLE)), 6) AS ks_statistic
  FROM g GROUP BY day""")
def stream_drift_windows(spark, folder):
    """Each day of the stream, counted in the state store, against all rows, counted once."""
    events = table(spark, folder, "events").select((F.col("value") - FEE).alias("Amount"))
    known = freeze(d.value_counts(events, ["Amount"]), "reference")
    out = scratch_path(spark, "counts")
    counts = stream_value_counts(_stream(spark, folder), "ts", ["Amount"])
    run_available(to_files(counts, out, scratch_path(spark, "offsets")))
    return window_drift(spark.read.schema(counts.schema).parquet(out), known).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "feature", "n_ref", "n_new", rounded(F.col("ks_statistic")).alias("ks_statistic"))
