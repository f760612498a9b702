"""Profiling aggregates: table facts, describe, class balance, duplicates, variance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from ..functions import is_missing, numeric_columns, present, ratio, string_columns
from .quantiles import QUARTILES, approx_quantiles, exact_quantiles, sketched

WIDTHS = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4,
    T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
}


def table_info(df: DataFrame, label: str) -> DataFrame:
    """Rows ``(section, name, value)``: shape, column types, missing counts, label counts."""
    columns = df.columns
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(columns)])

    def line(section, name, value):
        return F.struct(F.lit(section).alias("section"), F.lit(name).alias("name"), value.cast("string").alias("value"))

    facts = row.select(F.inline(F.array(
        line("shape", "rows", F.col("n")), line("shape", "columns", F.lit(len(columns))),
        *[line("dtype", f.name, F.lit(f.dataType.simpleString())) for f in df.schema],
        *[line("missing", c, F.col(f"m{i}")) for i, c in enumerate(columns)])))
    labels = df.groupBy(label).count().select(
        F.lit("label_count").alias("section"), F.col(label).cast("string").alias("name"),
        F.col("count").cast("string").alias("value"))
    return facts.unionByName(labels)


def row_bytes(df: DataFrame) -> Column:
    """Size of a row: the widths of its fixed-size columns plus the bytes of its texts."""
    fixed = sum(WIDTHS.get(type(f.dataType), 0) for f in df.schema)
    return sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in string_columns(df)), F.lit(fixed).cast("long"))


def table_summary(df: DataFrame) -> DataFrame:
    """One row: row and column counts, numeric and text column names, data size in MB."""
    numeric, text = numeric_columns(df), string_columns(df)
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.sum(row_bytes(df)).alias("_bytes")).select(
        "total_rows", F.lit(len(df.columns)).cast("long").alias("total_columns"),
        F.lit(",".join(numeric)).alias("numeric_columns"), F.lit(",".join(text)).alias("text_columns"),
        (F.coalesce(F.col("_bytes"), F.lit(0)).cast("double") / 1048576.0).alias("size_mb"))


def _moments(df: DataFrame, columns: list[str], beside: list[Column]) -> tuple[DataFrame, Row]:
    """Count, mean, deviation and range per column, and the row of the same pass that also has the aggregates ``beside``."""
    parts = list(beside)
    for i, c in enumerate(columns):
        v = present(df, c).cast("double")
        parts += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"a{i}"), F.stddev_samp(v).alias(f"s{i}"),
                  F.min(v).alias(f"l{i}"), F.max(v).alias(f"h{i}")]
    row = df.agg(*parts).first()
    lines = [(c, *(row[f"{figure}{i}"] for figure in "naslh")) for i, c in enumerate(columns)]
    return df.sparkSession.createDataFrame(
        [(c, n, *(None if x is None else float(x) for x in rest)) for c, n, *rest in lines],
        "feature string, count long, mean double, std double, min double, max double"), row


def describe(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Rows ``feature, count, mean, std, min, p25, p50, p75, max``; std has n-1 below the line.

    The table is read three times: one pass for the moments and the sketch of the quartiles, and the two that make
    them exact. With ``exact=False`` it is read twice.
    """
    columns = columns or numeric_columns(df)
    moments, row = _moments(df, columns, sketched(columns) if exact else [])
    quantiles = exact_quantiles(df, columns, QUARTILES, row) if exact else approx_quantiles(df, columns, QUARTILES)
    wide = quantiles.groupBy("feature").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"p{round(p * 100)}") for p in QUARTILES])
    return moments.join(wide, "feature", "left").select(
        "feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows ``(label, n, pct)``."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(label, "n", (ratio(F.col("n"), total) * 100).alias("pct"))


def imbalance(df: DataFrame, label: str) -> DataFrame:
    """One row: total, both class counts, positive rate in percent, ratio negatives/positives."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label) == 1).alias("positives"),
    ).select("*", (ratio(F.col("positives"), F.col("total_rows")) * 100).alias("positive_rate"),
             ratio(F.col("negatives"), F.col("positives"), float("inf")).alias("imbalance_ratio"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: rows beyond the first of each identical group, and their share in percent.

    NaN and NULL count as the same missing value. Equal rows are combined before the shuffle.
    """
    same = df.select(*[present(df, c).alias(c) for c in df.columns])
    groups = same.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
                      F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates")).select(
        "total_rows", "duplicates", (ratio(F.col("duplicates"), F.col("total_rows")) * 100).alias("duplicate_pct"))


def variances(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows ``(feature, variance)`` with n-1 below the line."""
    columns = columns or numeric_columns(df)
    row = df.agg(*[F.var_samp(present(df, c).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"v{i}").alias("variance")) for i, c in enumerate(columns)])))


def zero_variance(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return variances(df, columns).where(F.col("variance") == 0)


def low_variance(df: DataFrame, label: str, below: float = 1e-6) -> DataFrame:
    """Features, label excluded, whose variance is under ``below`` (constant ones included)."""
    return variances(df, numeric_columns(df, exclude=[label])).where(F.col("variance") < below)
