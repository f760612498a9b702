"""The exploratory report as one long table ``(section, name, metric, value)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..functions import is_missing, numeric_columns, present
from ..operators.correlation import MAX_PAIRWISE, correlation_pairs, target_correlation
from ..operators.histogram import histogram
from ..operators.profile import duplicate_rows, row_bytes
from ..operators.quantiles import QUARTILES, exact_quantiles, sketched

SCHEMA = "section string, name string, metric string, value double"
PERFECT, LOW = 1 - 1e-9, 1e-6


def long_lines(df: DataFrame, section: str, name, metrics: list[str]) -> DataFrame:
    """The numbers in columns ``metrics`` as report lines."""
    name = F.lit(name) if isinstance(name, str) else name
    return df.select(name.alias("name"), F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]))).select(
        F.lit(section).alias("section"), "name", "metric", "value")


def _facts(df: DataFrame, label: str, numeric: list[str]) -> Row:
    """Everything a single pass can tell; its size depends on the width of the table only."""
    aggregates = [F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df)).alias("bytes"),
                  F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives")]
    aggregates += [F.count_if(is_missing(df, c)).alias(f"missing_{c}") for c in df.columns]
    for c in numeric:
        v = present(df, c).cast("double")
        aggregates.append(F.struct(
            F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
            F.max(v).alias("max"), F.var_samp(v).alias("variance"), F.stddev_pop(v).alias("spread")).alias(f"about_{c}"))
    return df.agg(*aggregates, *sketched(numeric)).first()


def _fact_lines(facts: Row, df: DataFrame, label: str, numeric: list[str]) -> list[tuple]:
    n, negatives, positives = facts["rows"], facts["negatives"], facts["positives"]
    lines = [("summary", "", "total_rows", n), ("summary", "", "total_columns", len(df.columns)),
             ("summary", "", "size_mb", (facts["bytes"] or 0) / 1048576.0),
             ("class", "", "positive_rate", positives * 100.0 / n if n else 0.0),
             ("class", "", "imbalance_ratio", negatives / positives if positives else float("inf"))]
    lines += [("missing", "", c, facts[f"missing_{c}"]) for c in df.columns]
    for c in numeric:
        about = facts[f"about_{c}"]
        lines += [("describe", c, m, about[m]) for m in ("count", "mean", "std", "min", "max")]
        if about["variance"] == 0:
            lines.append(("zero_variance", c, "found", 1.0))
        if c != label and about["variance"] is not None and about["variance"] < LOW:
            lines.append(("low_variance", c, "found", 1.0))
    return lines


def _correlation_lines(df: DataFrame, label: str, numeric: list[str], facts: Row, top_n: int, matrix: bool) -> list[tuple]:
    """Perfectly correlated pairs, the strongest correlates of the label and, if asked, every pair (a row per pair of columns)."""
    moments = (facts["rows"], {c: tuple(facts[f"about_{c}"][m] for m in ("count", "mean", "spread")) for c in numeric})
    pairs = [(r["a"], r["b"], r["r"]) for r in correlation_pairs(df, numeric, moments).collect()]
    lines = [("perfect_correlation", f"{a}~{b}", "found", 1.0) for a, b, r in pairs if r is not None and abs(r) >= PERFECT]
    if matrix:
        lines += [("correlation", f"{a}~{b}", "r", r) for a, b, r in pairs]
    if label not in numeric or len(numeric) > MAX_PAIRWISE:
        top = [(r["feature"], r["abs_corr"]) for r in target_correlation(df, label, top_n).collect()]
    else:
        found = [(b if a == label else a, None if r is None else abs(r)) for a, b, r in pairs if label in (a, b)]
        top = sorted(found, key=lambda x: (x[1] is None, -(x[1] or 0.0), x[0]))[:top_n]
    return lines + [("target_correlation", c, "abs_corr", r) for c, r in top]


def _frame(spark: SparkSession, lines: list[tuple]) -> DataFrame:
    return spark.createDataFrame([(s, n, m, None if v is None else float(v)) for s, n, m, v in lines], SCHEMA)


def eda_report(df: DataFrame, label: str, histogram_columns: list[str] = (), bins: int = 50, top_n: int = 15,
               by_class: bool = False, matrix: bool = False) -> DataFrame:
    """Summary, missing values, describe, class balance, leakage checks and the plotted numbers.

    One pass for all plain aggregates and the sketch of the quartiles, one for all correlations, one per histogram, one for
    the class counts, two that make the quartiles exact, and the shuffle that finds duplicates. ``by_class`` adds each
    histogram per class, over that class's own range, and ``matrix`` the correlation of every pair of columns.
    """
    numeric = numeric_columns(df)
    facts = _facts(df, label, numeric)
    lines = _fact_lines(facts, df, label, numeric) + _correlation_lines(df, label, numeric, facts, top_n, matrix)
    n = max(facts["rows"], 1)
    classes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).withColumn("pct", F.col("n") * 100.0 / F.lit(float(n)))
    quartiles = exact_quantiles(df, numeric, QUARTILES, facts)
    parts = [
        _frame(df.sparkSession, lines),
        quartiles.select(F.lit("describe").alias("section"), F.col("feature").alias("name"),
                         F.concat(F.lit("p"), F.round(F.col("prob") * 100).cast("int").cast("string")).alias("metric"), "value"),
        long_lines(classes, "class", F.col(label).cast("string"), ["n", "pct"]),
        long_lines(duplicate_rows(df), "duplicates", "", ["duplicates", "duplicate_pct"]),
    ]
    for c in histogram_columns:
        about = facts[f"about_{c}"]
        if about["count"]:
            counts = histogram(df, c, bins, span=(about["min"], about["max"]))
            parts.append(long_lines(counts, f"histogram_{c}", F.col("bin").cast("string"), ["lo", "hi", "n"]))
            if by_class:
                counts = histogram(df, c, bins, by=label)
                name = F.concat_ws(":", F.col(label).cast("string"), F.col("bin").cast("string"))
                parts.append(long_lines(counts, f"class_histogram_{c}", name, ["lo", "hi", "n"]))
    return reduce(DataFrame.unionByName, parts)
