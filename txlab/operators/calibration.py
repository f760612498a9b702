"""Platt calibration: a sigmoid over scores, cross-fitted over folds by Newton steps on Spark aggregates.

Rows are combined per group, fold and distinct score once; every step is one aggregate over that table for all groups and
folds at a time. Only two numbers per group and fold reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import hash_hex, logistic, uniform
from ..session import freeze
from .metrics import brier_score, score_groups

FOLDS = 5
STEPS = 60
SETTLED = 1e-11  # of a Newton step
RIDGE = 1e-12  # keeps the system solvable where all scores are equal
ONE_CLASS = "a fold leaves one class only"


@dataclass
class Sigmoids:
    """``(slope, intercept)`` per fold, fitted on the rows outside it; none where ``reason`` says why."""

    pairs: list[tuple[float, float]]
    reason: str | None = None

    def average(self, score: Column) -> Column:
        """The calibrated value of rows that no fold has seen: the mean over the folds' sigmoids."""
        return reduce(Column.__add__, [logistic(F.lit(a) * score + F.lit(b)) for a, b in self.pairs]) / F.lit(float(len(self.pairs)))


def calibration_fold(key: str, folds: int = FOLDS, seed: int = 42) -> Column:
    """The fold of a row, from its key alone: equal keys share a fold, and nothing is counted or shuffled."""
    return F.floor(uniform(hash_hex(key, seed, "calibration")) * F.lit(float(folds))).cast("int")


def _softplus(z: Column) -> Column:
    return F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))


def platt_cross_fit(scored: DataFrame, key: str = "key", label: str = "label", score: str = "score", by: list[str] | None = None,
                    folds: int = FOLDS, seed: int = 42) -> dict[tuple, Sigmoids]:
    """``{group: Sigmoids}``, one entry for each combination of the (few) values of ``by``; without ``by`` the key is ``()``.

    The sigmoid of a fold minimises the cross-entropy against smoothed targets, (n1 + 1) / (n1 + 2) for positive rows and 1 / (n0 + 2) for
    negative ones, over the rows of the other folds. Newton steps start from the class odds and are halved while they
    do not lower the loss. A group in which some fold leaves one class has no sigmoids but a reason; any other failure
    is raised. Labels other than 0 and 1 and NULL or NaN scores are errors. No rows give no entries, or a reason for ``()``.
    """
    by = list(by or [])
    rows = scored.select(*by, F.col(label).alias("label"), F.col(score).cast("double").alias("score"), calibration_fold(key, folds, seed).alias("fold"))
    groups = freeze(score_groups(rows, "label", "score", [*by, "fold"]), "calibration")
    found: dict[tuple, dict[int, tuple[int, int]]] = {}
    for r in groups.groupBy(*by, "fold").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect():  # groups x folds
        found.setdefault(tuple(r[c] for c in by), {})[r["fold"]] = (r["pos"], r["neg"])
    out: dict[tuple, Sigmoids] = {} if found or by else {(): Sigmoids([], ONE_CLASS)}
    state: dict[tuple, dict] = {}
    for group, counts in found.items():
        outside = [(sum(v[0] for k, v in counts.items() if k != j), sum(v[1] for k, v in counts.items() if k != j)) for j in range(folds)]
        if not all(p and n for p, n in outside):
            out[group] = Sigmoids([], ONE_CLASS)
            continue
        out[group] = Sigmoids([(0.0, 0.0)] * folds)
        for j, (p, n) in enumerate(outside):
            state[group, j] = {"at": (0.0, math.log((p + 1) / (n + 1))), "hi": (p + 1) / (p + 2), "lo": 1 / (n + 2), "last": None}
    schema = ", ".join(f"`{c}` {dict(groups.dtypes)[c]}" for c in by) + (", " if by else "") + "_j int, _a double, _b double, _hi double, _lo double"
    z = F.col("_a") * F.col("score") + F.col("_b")
    p, n = logistic(z), F.col("pos") + F.col("neg")
    target = F.col("pos") * F.col("_hi") + F.col("neg") * F.col("_lo")  # of all rows of a score
    gap, bend = n * p - target, n * p * (F.lit(1.0) - p)
    sums = {"loss": target * _softplus(-z) + (n - target) * _softplus(z), "ga": gap * F.col("score"), "gb": gap,
            "haa": bend * F.col("score") * F.col("score"), "hab": bend * F.col("score"), "hbb": bend}
    for _ in range(STEPS):
        if not state:
            break
        table = groups.sparkSession.createDataFrame([(*g, j, *s["at"], s["hi"], s["lo"]) for (g, j), s in state.items()], schema)
        other = F.col("fold") != F.col("_j")
        joined = groups.join(F.broadcast(table), by).where(other) if by else groups.join(F.broadcast(table), other)  # groups x folds rows
        for r in joined.groupBy(*by, "_j").agg(*[F.sum(v).alias(k) for k, v in sums.items()]).collect():
            g, j = tuple(r[c] for c in by), r["_j"]
            s = state[g, j]
            if s["last"] and r["loss"] > s["last"][0] + 1e-12 * abs(s["last"][0]):
                a, b = s["last"][1]
                step = s["last"][2] = tuple(x / 2 for x in s["last"][2])
            else:
                a, b = s["at"]
                haa, hbb = r["haa"] + RIDGE, r["hbb"] + RIDGE
                det = haa * hbb - r["hab"] ** 2
                step = (-(hbb * r["ga"] - r["hab"] * r["gb"]) / det, -(haa * r["gb"] - r["hab"] * r["ga"]) / det)
                s["last"] = [r["loss"], (a, b), step]
            s["at"] = (a + step[0], b + step[1])
            if max(map(abs, step)) < SETTLED * (1 + max(map(abs, s["at"]))):
                out[g].pairs[j] = s["at"]
                del state[g, j]
    for (g, j), s in state.items():
        out[g].pairs[j] = s["at"]
    return out


def platt_apply(scored: DataFrame, slope: float, intercept: float, score: str = "score") -> DataFrame:
    return scored.withColumn("calibrated", logistic(F.lit(slope) * F.col(score) + F.lit(intercept)))


def calibration_choice(scored: DataFrame, label: str = "label", score: str = "score", calibrated: str = "calibrated",
                       by: list[str] | None = None) -> DataFrame:
    """``[by,] original_brier, calibrated_brier, use_calibrated``: calibrated only if strictly better. Without ``by`` one row."""
    by = list(by or [])
    if not by:
        before = brier_score(scored, label, score).withColumnRenamed("brier_score", "original_brier")
        out = before.withColumn("calibrated_brier", brier_score(scored, label, calibrated).scalar())
    else:
        gap = lambda c: F.avg((F.col(c) - F.col(label)) * (F.col(c) - F.col(label)))
        out = scored.groupBy(*by).agg(gap(score).alias("original_brier"), gap(calibrated).alias("calibrated_brier"))
    return out.withColumn("use_calibrated", F.coalesce(F.col("calibrated_brier") < F.col("original_brier"), F.lit(False)))


def calibrate(scored: DataFrame, key: str = "key", label: str = "label", score: str = "score", by: list[str] | None = None,
              folds: int = FOLDS, seed: int = 42, fits: dict[tuple, Sigmoids] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(scored with "calibrated" and "final", choice)``; ``choice`` is a row per group with Brier scores and ``reason``.

    A row is calibrated by the sigmoid of its own fold, which never saw it, so that both Brier scores are honest.
    ``final`` is the calibrated score where it is strictly better, else the score itself; a group
    without sigmoids keeps its scores, has no ``calibrated`` ones, and ``reason`` says why.
    """
    by = list(by or [])
    fits = platt_cross_fit(scored, key, label, score, by, folds, seed) if fits is None else fits
    kinds = dict(scored.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in by) + (", " if by else "") + "_fold int, _a double, _b double, _reason string"
    rows = [(*g, j, *(s.pairs[j] if s.pairs else (None, None)), s.reason) for g, s in fits.items() for j in range(folds)]
    table = F.broadcast(scored.sparkSession.createDataFrame(rows, schema))  # groups x folds rows
    marked = scored.withColumn("_fold", calibration_fold(key, folds, seed)).join(table, [*by, "_fold"], "left")
    marked = marked.withColumn("calibrated", logistic(F.col("_a") * F.col(score) + F.col("_b")))
    choice = calibration_choice(marked, label, score, by=by)
    if by:
        reasons = scored.sparkSession.createDataFrame([(*g, s.reason) for g, s in fits.items()], ", ".join(f"`{c}` {kinds[c]}" for c in by) + ", reason string")
        choice = freeze(choice.join(F.broadcast(reasons), by), "choice")
        marked = marked.join(F.broadcast(choice.select(*by, "use_calibrated")), by)
        use = F.col("use_calibrated")
    else:
        choice = freeze(choice.withColumn("reason", F.lit(fits[()].reason).cast("string")), "choice")
        use = choice.select("use_calibrated").scalar()
    return marked.select(*scored.columns, "calibrated", F.when(use, F.col("calibrated")).otherwise(F.col(score)).alias("final")), choice
