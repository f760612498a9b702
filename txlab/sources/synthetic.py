"""Synthetic transactions of any size, the same on every partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import hash_hex, normal, uniform
from ..operators.validate import FEATURES

# Ranges and distribution parameters of a synthetic transaction.
SECONDS = 172800
LOG_AMOUNT_MEAN, LOG_AMOUNT_STD = 4.5, 1.2
EXTRA_NOISE = 0.5
NOISY_SHARE = 8 / 50


def synthetic_transactions(keys: DataFrame, key: str, seed: int = 42, noisy_share: float = NOISY_SHARE) -> DataFrame:
    """One transaction per key: whole-second Time, log-normal Amount, standard normal V1..V28.

    ``noisy_share`` of the rows (chosen by hash) get additional noise on V1..V28. All numbers
    come from md5 of the key, never from a per-partition random generator.
    """
    def digest(name):
        return hash_hex(key, seed, name)

    def normals(prefix):
        """28 normal numbers, four from each of seven digests."""
        digests = F.transform(F.sequence(F.lit(0), F.lit(len(FEATURES) // 4 - 1)),
                              lambda g: digest(F.concat(F.lit(prefix), g.cast("string"))))
        return F.flatten(F.transform(digests, lambda d: F.array(*[normal(d, i) for i in range(4)])))

    # V1..V28 are one array expression, so that the generated code stays small
    drawn = keys.select(key, (uniform(digest("noisy")) < F.lit(float(noisy_share))).alias("_noisy"), normals("V").alias("_v"))
    noise = F.zip_with("_v", normals("noise"), lambda v, extra: v + extra * EXTRA_NOISE)
    amount = F.exp(F.lit(LOG_AMOUNT_MEAN) + F.lit(LOG_AMOUNT_STD) * normal(digest("Amount")))
    made = drawn.select(key, F.floor(uniform(digest("Time")) * SECONDS).cast("double").alias("Time"),
                        F.round(amount, 2).alias("Amount"), F.when(F.col("_noisy"), noise).otherwise(F.col("_v")).alias("_w"))
    return made.select(key, "Time", *[F.col("_w")[i].alias(v) for i, v in enumerate(FEATURES)], "Amount")


def sample_transactions(spark: SparkSession, rows: int = 50, seed: int = 42) -> DataFrame:
    return synthetic_transactions(spark.range(rows), "id", seed)
