"""Equal-width histograms over the observed range; the last bin is closed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import present, ratio
from ..session import attach_small


def _bin(value, low, high, bins: int):
    width = (high - low) / F.lit(float(bins))
    return F.least(F.floor(ratio(value - low, width)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, column: str, bins: int = 50, by: str | None = None,
              span: tuple[float, float] | None = None) -> DataFrame:
    """Rows ``([by,] bin, lo, hi, n)``; with ``by``, each group is binned over its own range.

    ``span`` gives the smallest and largest value where they are known already. A constant column has no width: it is binned over [value - 0.5, value + 0.5].
    """
    group = [by] if by else []
    values = df.select(*group, present(df, column).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    if span is not None:
        spread = df.sparkSession.range(1).select(F.lit(span[0]).alias("_min"), F.lit(span[1]).alias("_max"))
    else:
        spread = values.groupBy(*group).agg(F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    flat = F.col("_min") == F.col("_max")
    spread = spread.select(
        *group, F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_lo"),
        F.when(flat, F.col("_max") + 0.5).otherwise(F.col("_max")).alias("_hi"))
    if by:
        ranged = attach_small(values, spread, [by])
    else:
        ranged = values.withColumn("_r", spread.select(F.struct("_lo", "_hi").alias("r")).scalar()).select(
            "_v", "_r._lo", "_r._hi")
    counts = ranged.groupBy(*group, _bin(F.col("_v"), F.col("_lo"), F.col("_hi"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    frame = spread.where(F.col("_lo").isNotNull()).select(
        *group, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return frame.join(counts, [*group, "bin"], "left").select(
        *group, "bin", (F.col("_lo") + F.col("bin") * width).alias("lo"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def density_histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Rows ``(bin, lo, hi, density)`` whose area is one."""
    counts = histogram(df, column, bins)
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("bin", "lo", "hi", ratio(F.col("n"), total * (F.col("hi") - F.col("lo"))).alias("density"))
