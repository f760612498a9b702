"""Streaming jobs. Sinks are files with a checkpoint, so a restart repeats or loses nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.drift import ALPHA, drift_flags, drift_severity, drift_summary, ks_counts, ks_normal, shared_features, value_counts
from ..operators.ranks import long_values
from ..operators.scoring import PROBABILITY, score_batch, score_summary
from ..operators.validate import failed_rules
from ..session import freeze


def stream_score(rows: DataFrame, rules: dict[str, Column], scorer: Column | object, threshold: float | Column) -> DataFrame:
    """Validated and scored rows: ``accepted`` and, for rejected rows, the broken rules and no probability."""
    marked = score_batch(failed_rules(rows, rules), scorer, threshold)
    good = F.size("failed") == 0
    return marked.withColumn("accepted", good).withColumns({
        PROBABILITY: F.when(good, F.col(PROBABILITY)), "fraud_decision": F.when(good, F.col("fraud_decision"))})


def stream_summary(scored: DataFrame, time: str, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Score summary per tumbling event-time window; rows later than ``delay`` are dropped."""
    timed = scored.withWatermark(time, delay)
    out = score_summary(timed, [F.window(time, window).alias("window")])
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      *[c for c in out.columns if c != "window"])


def to_files(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] = ()) -> DataStreamWriter:
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint)
    return writer.partitionBy(*partition_by) if partition_by else writer


def run_available(writer: DataStreamWriter) -> None:
    """Process everything that is there, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def stream_drift(stream: DataFrame, stats: DataFrame, path: str, checkpoint: str, features: list[str] | None = None,
                 alpha: float = ALPHA, reference: DataFrame | None = None) -> DataStreamWriter:
    """Each micro-batch is tested and its result written below ``path/batch=<id>``.

    Against the stored statistics, or against the rows of ``reference`` if given, which are counted once. A batch
    is read once and held while it is tested; one that is repeated after a failure overwrites its own folder.
    """
    if reference is not None:
        compared, _ = shared_features(reference, stream, features)
        known = freeze(value_counts(reference, compared), "reference")

    def check(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            if held.isEmpty():
                return
            if reference is None:
                flags = drift_flags(ks_normal(held, stats, features), alpha)
            else:
                flags = drift_flags(ks_counts(known, value_counts(held, compared), []), alpha)
            flags.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            held.unpersist()

    return stream.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)


def stream_value_counts(stream: DataFrame, time: str, features: list[str], window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Rows ``(window_start, feature, value, n)``, one for each different value of a closed window of event time.

    The state store keeps the counts of open windows, so batches are merged and nothing is read again. A window closes when the
    watermark, ``delay`` behind the latest row, passes its end; rows that come later than that are dropped. Append to one
    folder (``to_files``) and test with ``window_drift``, as often as wanted.
    """
    timed = stream.withWatermark(time, delay).withColumn("window", F.window(time, window))
    counts = long_values(timed, features, ["window"]).groupBy("window", "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), "feature", "value", "n")


def window_drift(counts: DataFrame, reference: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Rows ``(window_start, feature, n_ref, n_new, ks_statistic, p_value, drift)`` of the windows of ``stream_value_counts``.

    ``reference`` are ``value_counts``, stored once.
    """
    return drift_flags(ks_counts(reference, counts, ["window_start"]), alpha)


def drift_severity_of_batches(flags: DataFrame) -> DataFrame:
    """One summary row with severity over all tested batches."""
    return drift_severity(drift_summary(flags))
