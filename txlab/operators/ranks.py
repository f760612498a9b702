"""Running totals over an ordered column without sorting everything in one task."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import freeze

PART = "_part"
#: Finest share of the rows that the sketch of range bounds tells apart, as ranges to one.
ACCURACY = 10


def _ranges(df: DataFrame, order: str) -> DataFrame:
    """``df``, written once, with the number of its range of ``order`` in ``PART``.

    The bounds of numbers come from a mergeable sketch of the written column, NULLs and NaNs having ranges of their own at
    either end; one range bound is as good for a group as for another, and a group with most rows has most ranges. Other
    types are range-partitioned, which samples and shuffles the rows.
    """
    if not isinstance(df.schema[order].dataType, T.NumericType):
        return freeze(df.repartitionByRange(F.col(order)).withColumn(PART, F.spark_partition_id()), "ranges")
    held = freeze(df, "ranges")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.nanvl(F.col(order).cast("double"), F.lit(None).cast("double"))
    found = held.agg(F.percentile_approx(at, [k / n for k in range(1, n)], ACCURACY * n)).first()[0] if n > 1 else None
    bounds = sorted({b for b in found or [] if abs(b) != float("inf")})
    # A search of the bounds for each row, in the JVM; NaN has the last bucket.
    split = Bucketizer(splits=[float("-inf"), *(bounds or [0.0]), float("inf")], inputCol="_at", outputCol=PART, handleInvalid="keep")
    numbered = split.transform(held.withColumn("_at", F.col(order).cast("double")))
    return numbered.withColumn(PART, F.when(F.col(order).isNull(), -1).otherwise(F.col(PART)).cast("int")).drop("_at")


def running_totals(df: DataFrame, order: str, measures: list[str], by: list[str] | None = None,
                   descending: bool = False) -> DataFrame:
    """Add ``cum_<m>`` (running total up to and including the row) and ``all_<m>`` per group ``by``.

    Rows must be unique per ``by`` + ``order``, and ``by`` not NULL: pre-aggregate first,
    which also collapses any value shared by many rows. The frame is written once, and its rows
    get the numbers of ranges of ``order``; the totals of each range are a small table (at most
    ranges x groups rows) whose running sum becomes the starting offset of the range. No
    task holds more than one range, the written rows are shuffled once, and the final join needs
    no shuffle of its own: it has the keys by which the running totals inside a range are partitioned.
    """
    by = list(by or [])
    direction = F.col(order).desc() if descending else F.col(order).asc()
    held = _ranges(df, order)

    part_totals = held.groupBy(*by, PART).agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    ahead = F.col(PART).desc() if descending else F.col(PART).asc()
    before = Window.partitionBy(*by).orderBy(ahead).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    zero = {m: F.lit(0).cast(part_totals.schema[f"_t_{m}"].dataType) for m in measures}
    offsets = part_totals.select(
        *by, PART,
        *[F.coalesce(F.sum(f"_t_{m}").over(before), zero[m]).alias(f"_off_{m}") for m in measures],
        *[F.sum(f"_t_{m}").over(whole).alias(f"all_{m}") for m in measures],
    )
    inside = Window.partitionBy(*by, PART).orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    local = held.select("*", *[F.sum(m).over(inside).alias(f"_loc_{m}") for m in measures])
    return local.join(offsets, [*by, PART]).select(
        *df.columns,
        *[(F.col(f"_loc_{m}") + F.col(f"_off_{m}")).alias(f"cum_{m}") for m in measures],
        *[F.col(f"all_{m}") for m in measures],
    )


def long_values(df: DataFrame, columns: list[str], keep: list[str | Column] = ()) -> DataFrame:
    """One row ``(*keep, feature, value)`` per non-missing cell of the numeric ``columns``."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("value"))
        for c in columns])
    filled = F.filter(cells, lambda cell: cell["value"].isNotNull())
    return df.select(*keep, F.inline(filled))
