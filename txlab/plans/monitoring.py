"""The drift report as one long table ``(section, name, metric, value)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import is_missing
from ..operators.drift import ALPHA, detect_drift, drift_severity, drift_summary, shared_features
from ..session import freeze
from .eda import long_lines

# What to do about each severity.
ADVICE = {
    "high": "High drift detected: consider retraining the model",
    "moderate": "Moderate drift detected: monitor closely",
    "low": "Low drift: the model should remain stable",
}


def monitor_report(reference: DataFrame, new: DataFrame, features: list[str] | None = None,
                   alpha: float = ALPHA) -> DataFrame:
    """Data summary, drift per feature, skipped features, summary and severity; the test runs once."""
    compared, skipped = shared_features(reference, new, features)
    flags = freeze(detect_drift(reference, new, compared, alpha), "drift")
    summary = drift_severity(drift_summary(flags))
    missing = sum((F.count_if(is_missing(new, c)) for c in new.columns), F.lit(0))
    facts = new.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(new.columns)).alias("columns"),
                    missing.alias("missing_values"))
    measured = flags.withColumn("drift", F.col("drift").cast("double"))
    parts = [
        long_lines(facts, "data", "", ["rows", "columns", "missing_values"]),
        long_lines(measured, "feature", F.col("feature"), ["ks_statistic", "p_value", "drift"]),
        long_lines(summary, "summary", "", ["total_features", "features_with_drift", "drift_percentage",
                                        "avg_ks_statistic", "avg_p_value"]),
        long_lines(summary.withColumn("given", F.lit(1.0)), "severity", F.col("severity"), ["given"]),
    ]
    if skipped:
        names = reference.sparkSession.createDataFrame([(s, 1.0) for s in skipped], "n string, skipped double")
        parts.append(long_lines(names, "feature", F.col("n"), ["skipped"]))
    return reduce(DataFrame.unionByName, parts)


def advice(summary: DataFrame) -> DataFrame:
    """Add ``recommendation`` for the severity."""
    text = F.create_map(*[F.lit(x) for pair in ADVICE.items() for x in pair])
    return summary.withColumn("recommendation", text[F.col("severity")])
