"""Scaling, feature projection, deterministic stratified splits and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import hash_hex, present, ratio, uniform
from .selection import with_cuts
from .validate import FEATURES, LABEL


def scale_fit(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows ``(feature, mean, std)`` with the population standard deviation."""
    parts = []
    for i, c in enumerate(columns):
        v = present(df, c).cast("double")
        parts += [F.avg(v).alias(f"m{i}"), F.stddev_pop(v).alias(f"s{i}")]
    return df.agg(*parts).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"))
        for i, c in enumerate(columns)])))


def scaled(stats: DataFrame | None, columns: list[str]) -> dict[str, Column]:
    """Scaled column expressions. The statistics are one row, read as a scalar subquery.

    A feature without statistics stays as it is; one with zero spread is only centred.
    """
    if stats is None:
        raise ValueError("the scaler must be fitted before data is transformed")
    row = stats.agg(F.struct(*[
        F.max(F.when(F.col("feature") == c, F.struct("mean", "std"))).alias(f"f{i}")
        for i, c in enumerate(columns)]).alias("all")).scalar()
    out = {}
    for i, c in enumerate(columns):
        mean, std = row[f"f{i}"]["mean"], row[f"f{i}"]["std"]
        spread = F.when(std.isNull() | (std == 0), F.lit(1.0)).otherwise(std)
        out[c] = (F.col(c).cast("double") - F.coalesce(mean, F.lit(0.0))) / spread
    return out


def scale_transform(df: DataFrame, stats: DataFrame | None, columns: list[str]) -> DataFrame:
    """``df`` with the columns replaced by their scaled values."""
    return df.withColumns(scaled(stats, columns))


def prepare_features(df: DataFrame, key: str, stats: DataFrame | None, features: list[str] = FEATURES,
                     label: str | None = LABEL, include_time: bool = True, keep: list[str] = ()) -> DataFrame:
    """Key, features, ``Amount_scaled`` (and ``Time_scaled``), label; raw amount and time are gone."""
    scaled_columns = ["Amount", "Time"] if include_time else ["Amount"]
    values = scaled(stats, scaled_columns)
    return df.select(key, *features, *[values[c].alias(f"{c}_scaled") for c in scaled_columns],
                     *([label] if label else []), *keep)


def stratified_split(df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """``df`` with ``split`` in {train, test}: ``round(n * test_size)`` rows of every class are test rows."""
    marked = with_cuts(df, key, label, {"_test": F.round(F.col("n") * test_size)}, seed)
    return marked.withColumn("split", F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def approx_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """One pass and no counts: each row is a test row with probability ``test_size``, by its hash."""
    return df.withColumn("split", F.when(uniform(hash_hex(key, seed)) < test_size, "test").otherwise("train"))


def three_way_split(df: DataFrame, key: str, label: str, test_size: float = 0.2, val_size: float = 0.2,
                    seed: int = 42) -> DataFrame:
    """``split`` in {train, val, test}; validation is ``val_size`` of what the test rows leave."""
    upto = test_size + (1 - test_size) * val_size
    marked = with_cuts(df, key, label, {"_test": F.round(F.col("n") * test_size),
                                        "_val": F.round(F.col("n") * upto)}, seed)
    split = F.when(F.col("_test"), "test").when(F.col("_val"), "val").otherwise("train")
    return marked.withColumn("split", split).drop("_test", "_val")


def process_data(df: DataFrame, key: str, label: str, features: list[str], fit_on: str = "train",
                 test_size: float = 0.2, val_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Three-way split, scaler fitted on ``fit_on`` ('train' or 'all'), every split transformed."""
    split = three_way_split(df, key, label, test_size, val_size, seed)
    fitted = scale_fit(split if fit_on == "all" else split.where(F.col("split") == fit_on), features)
    return scale_transform(split, fitted, features)


def fold_assign(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """``df`` with ``fold`` in 0..k-1: each class in hash order, cut into k parts of equal size.

    Where a class is not divisible by k, the first folds get one more row.
    """
    n = F.col("n")
    ends = {f"_f{j}": F.floor(n / k) * (j + 1) + F.least(n % k, F.lit(j + 1)) for j in range(k - 1)}
    marked = with_cuts(df, key, label, ends, seed)
    fold = F.lit(k - 1)
    for j in reversed(range(k - 1)):
        fold = F.when(F.col(f"_f{j}"), F.lit(j)).otherwise(fold)
    return marked.withColumn("fold", fold.cast("int")).drop(*ends)


def split_info(df: DataFrame, label: str) -> DataFrame:
    """Rows ``(split, total, positive, negative, positive_rate)``, rate in percent."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col(label) == 1).alias("positive"),
        F.count_if(F.col(label) == 0).alias("negative"),
    ).withColumn("positive_rate", ratio(F.col("positive"), F.col("total")) * 100)
