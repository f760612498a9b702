"""Distribution drift: two-sample and one-sample Kolmogorov-Smirnov tests per feature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import exact_two_sample, is_missing, kolmogorov_tail, normal_cdf, normal_pdf, numeric_columns, ratio
from ..session import attach_small, freeze
from .histogram import histogram
from .profile import describe
from .ranks import long_values, running_totals

ALPHA = 0.05
EXACT_CELLS = 100_000  # product of two sample sizes up to which the exact law is worked out
# Share of drifted features, in percent, above which drift is called so.
HIGH, MODERATE = 20.0, 10.0


def reference_stats(df: DataFrame, features: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Rows ``feature, mean, std, min, max, p25, p50, p75`` to be stored with the model."""
    return describe(df, features, exact).select("feature", "mean", "std", "min", "max", "p25", "p50", "p75")


def shared_features(reference: DataFrame, new: DataFrame, features: list[str] | None = None) -> tuple[list, list]:
    """``(compared, skipped)``: a feature missing on either side is skipped."""
    wanted = list(features) if features is not None else numeric_columns(reference)
    both = set(numeric_columns(reference)) & set(numeric_columns(new))
    return [f for f in wanted if f in both], [f for f in wanted if f not in both]


def ks_two_sample(reference: DataFrame, new: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Rows ``(feature, n_ref, n_new, ks_statistic)``: largest gap between the empirical distributions.

    All features go through one shuffle of value counts, and no feature is sorted in one task.
    """
    compared, _ = shared_features(reference, new, features)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    cells = long_values(reference, compared, [one.alias("r"), none.alias("w")]).unionByName(
        long_values(new, compared, [none.alias("r"), one.alias("w")]))
    counts = cells.groupBy("feature", "value").agg(F.sum("r").alias("r"), F.sum("w").alias("w"))
    totals = running_totals(counts, "value", ["r", "w"], by=["feature"])
    gap = F.abs(ratio(F.col("cum_r"), F.col("all_r")) - ratio(F.col("cum_w"), F.col("all_w")))
    return totals.groupBy("feature").agg(
        F.max("all_r").alias("n_ref"), F.max("all_w").alias("n_new"), F.max(gap).alias("ks_statistic"))


def ks_pvalue(statistics: DataFrame) -> DataFrame:
    """Add the two-sample ``p_value``: exact for samples with ``n_ref * n_new`` up to ``EXACT_CELLS``, asymptotic beyond.

    The exact law takes values as distinct; ties, as always, make it conservative.
    """
    d, n, m = F.col("ks_statistic"), F.col("n_ref"), F.col("n_new")
    small = n.cast("double") * m.cast("double") <= EXACT_CELLS
    return statistics.withColumn("p_value", F.when(small, exact_two_sample(d, n, m)).otherwise(kolmogorov_tail(d, n, m)))


def ks_groups(df: DataFrame, group: str, value: str, new: Column) -> DataFrame:
    """Rows ``(<group>, n_ref, n_new, ks_statistic, p_value)``: within each group, rows for which ``new`` holds against the others.

    Missing values are left out, and groups without rows on both sides. Values are counted per group first, so a hot group costs its
    distinct values, and running totals split it over ranges.
    """
    known = df.where(~is_missing(df, value) & new.isNotNull() & F.col(group).isNotNull())
    counts = known.groupBy(F.col(group).alias("_group"), F.col(value).cast("double").alias("value")).agg(
        F.count_if(~new).alias("r"), F.count_if(new).alias("w"))
    totals = running_totals(counts, "value", ["r", "w"], ["_group"]).where("all_r > 0 AND all_w > 0")
    gap = F.abs(F.col("cum_r") / F.col("all_r").cast("double") - F.col("cum_w") / F.col("all_w").cast("double"))
    found = totals.groupBy("_group").agg(F.max("all_r").alias("n_ref"), F.max("all_w").alias("n_new"), F.max(gap).alias("ks_statistic"))
    return ks_pvalue(found.withColumnRenamed("_group", group))


def value_counts(df: DataFrame, features: list[str]) -> DataFrame:
    """Rows ``(feature, value, n)``: how often each value occurs. Enough for KS tests, and mergeable by sums."""
    return long_values(df, features).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def ks_counts(reference: DataFrame, new: DataFrame, by: list[str]) -> DataFrame:
    """Rows ``(*by, feature, n_ref, n_new, ks_statistic, p_value)``: each group of ``new`` against one reference.

    ``reference`` are ``value_counts``, ``new`` has them per group of columns ``by``; equal rows of either are added up. The
    reference is ranked once and not repeated for each group: between two values of a group its own distribution stands still, so
    the gap is largest just below or at one of them. Features that only one side has are left out.
    """
    counted = freeze(new.groupBy(*by, "feature", "value").agg(F.sum("n").alias("w")), "counts")
    places = reference.select("feature", "value", F.col("n").alias("r")).unionByName(
        counted.select("feature", "value", F.lit(0).cast("long").alias("r")))
    ranked = running_totals(places.groupBy("feature", "value").agg(F.sum("r").alias("r")), "value", ["r"], ["feature"])
    ranked = ranked.where("all_r > 0").select("feature", "value", "all_r", ratio(F.col("cum_r"), F.col("all_r")).alias("_at"),
                                              ratio(F.col("cum_r") - F.col("r"), F.col("all_r")).alias("_below"))
    totals = running_totals(counted, "value", ["w"], [*by, "feature"]).join(ranked, ["feature", "value"])
    at, below = ratio(F.col("cum_w"), F.col("all_w")), ratio(F.col("cum_w") - F.col("w"), F.col("all_w"))
    gap = F.greatest(F.abs(F.col("_at") - at), F.abs(F.col("_below") - below))
    return ks_pvalue(totals.groupBy(*by, "feature").agg(
        F.max("all_r").alias("n_ref"), F.max("all_w").alias("n_new"), F.max(gap).alias("ks_statistic")))


def ks_normal(new: DataFrame, stats: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Rows ``(feature, n_new, ks_statistic, p_value)`` of each feature against Normal(mean, std) of ``stats``.

    One shuffle of value counts for all features. Features without statistics, or without
    any spread in them, are left out.
    """
    spreads = stats.where(F.col("std") > 0).select("feature", "mean", "std")
    known = [r["feature"] for r in spreads.select("feature").collect()]
    compared = [f for f in (features or known) if f in known and f in numeric_columns(new)]
    counts = long_values(new, compared).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("w"))
    totals = attach_small(running_totals(counts, "value", ["w"], by=["feature"]), spreads, ["feature"], how="inner")
    expected = normal_cdf((F.col("value") - F.col("mean")) / F.col("std"))
    upto, before = ratio(F.col("cum_w"), F.col("all_w")), ratio(F.col("cum_w") - F.col("w"), F.col("all_w"))
    gap = F.greatest(F.abs(upto - expected), F.abs(expected - before))
    out = totals.groupBy("feature").agg(F.max("all_w").alias("n_new"), F.max(gap).alias("ks_statistic"))
    return out.withColumn("p_value", kolmogorov_tail(F.col("ks_statistic"), F.col("n_new")))


def drift_flags(tested: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Add ``drift``: is the p-value below alpha?"""
    return tested.withColumn("drift", F.col("p_value") < F.lit(float(alpha)))


def detect_drift(reference: DataFrame, new: DataFrame, features: list[str] | None = None,
                 alpha: float = ALPHA) -> DataFrame:
    """Rows ``(feature, n_ref, n_new, ks_statistic, p_value, drift)`` for the compared features."""
    return drift_flags(ks_pvalue(ks_two_sample(reference, new, features)), alpha)


def drift_summary(flags: DataFrame) -> DataFrame:
    """One row: features compared, drifted, percent, mean statistic (0 if none), mean p-value (1 if none)."""
    counted = flags.agg(
        F.count(F.lit(1)).alias("total_features"), F.count_if("drift").alias("features_with_drift"),
        F.coalesce(F.avg("ks_statistic"), F.lit(0.0)).alias("avg_ks_statistic"),
        F.coalesce(F.avg("p_value"), F.lit(1.0)).alias("avg_p_value"))
    return counted.withColumn(
        "drift_percentage", ratio(F.col("features_with_drift"), F.col("total_features")) * 100)


def drift_severity(summary: DataFrame) -> DataFrame:
    """Add ``severity``: high, moderate or low."""
    share = F.col("drift_percentage")
    return summary.withColumn("severity", F.when(share > HIGH, "high").when(share > MODERATE, "moderate").otherwise("low"))


def drift_plot_data(flags: DataFrame, new: DataFrame, stats: DataFrame, bins: int = 20, density_bins: int = 50,
                    points: int = 100, top: int = 5) -> DataFrame:
    """Rows ``(plot, series, x, y)``: KS histogram, densities of the top drifted features, their normal curves."""
    ks = histogram(flags, "ks_statistic", bins).select(
        F.lit("ks_histogram").alias("plot"), F.lit("ks_statistic").alias("series"),
        F.col("lo").alias("x"), F.col("n").cast("double").alias("y"))
    leading = [r["feature"] for r in flags.where("drift").orderBy(F.desc("ks_statistic"), "feature").limit(top).collect()]
    if not leading:
        return ks
    long = long_values(new, leading)
    widths = histogram(long, "value", density_bins, by="feature")
    area = widths.groupBy("feature").agg(F.sum("n").alias("_t"))
    density = widths.join(area, "feature").select(
        F.lit("density").alias("plot"), F.col("feature").alias("series"), F.col("lo").alias("x"),
        ratio(F.col("n"), F.col("_t") * (F.col("hi") - F.col("lo"))).alias("y"))
    step = F.col("i") * F.lit(6.0) / F.lit(float(points - 1)) - F.lit(3.0)
    x = F.col("mean") + step * F.col("std")
    normal = stats.where(F.col("feature").isin(leading)).select(
        "feature", "mean", "std", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")).select(
        F.lit("normal").alias("plot"), F.col("feature").alias("series"), x.alias("x"),
        normal_pdf(x, F.col("mean"), F.col("std")).alias("y"))
    return ks.unionByName(density).unionByName(normal)
