"""From raw transactions to training and test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.prepare import prepare_features, scale_fit, split_info, stratified_split
from ..operators.resample import rebalance
from ..operators.validate import FEATURES, LABEL
from ..session import freeze
from ..sources.tables import write_splits


def prepare_data(raw: DataFrame, key: str, features: list[str] = FEATURES, label: str = LABEL,
                 strategy: str = "none", include_time: bool = True, fit_on: str = "train", test_size: float = 0.2,
                 seed: int = 42, path: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(data, scaler statistics, split report)``; with ``path`` the data is stored partitioned by split.

    Split first, fit the scaler on ``fit_on`` ('train' or 'all'), rebalance the training rows only.
    """
    # Written once: the scaler, both parts and every pass of the rebalancing read it.
    split = freeze(stratified_split(raw, key, label, test_size, seed), "split")
    columns = ["Amount", "Time"] if include_time else ["Amount"]
    stats = freeze(scale_fit(split if fit_on == "all" else split.where(F.col("split") == "train"), columns), "scaler")
    prepared = prepare_features(split, key, stats, features, label, include_time, keep=["split"])
    inputs = [*features, *[f"{c}_scaled" for c in columns]]
    test = prepared.where(F.col("split") == "test").drop("split").withColumn("copy", F.lit(0))
    train = rebalance(prepared.where(F.col("split") == "train").drop("split"), strategy, key, label, inputs, seed)
    data = train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test")), allowMissingColumns=True)
    if path is not None:
        data = write_splits(data, path)
    return data, stats, split_info(data, label)
