"""Exact, tie-aware metrics over scored rows ``([model,] key, label, score)``.

Everything that depends on the order of scores starts from one row per distinct score
(``score_groups``), so a score shared by very many rows is a single row, and gets its
running totals from range partitions (see ``ranks``). ``by`` names grouping columns,
e.g. ``["model"]``, so that many models are measured in the same pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import ratio
from ..session import SMALL_ROWS, attach_small
from .ranks import running_totals

DEFAULT_THRESHOLD = 0.5
MIN_RECALL = 0.90


# ---- counts -------------------------------------------------------------------------

def _binary(value, what: str):
    """``value``, failing at the first row where it is neither 0 nor 1: no row may vanish from a count."""
    known = value.cast("double").isin(0.0, 1.0)
    return F.when(known, value).otherwise(F.raise_error(F.lit(f"a {what} is neither 0 nor 1")))


def _counts(label, predicted):
    label, predicted = _binary(label, "label"), _binary(predicted, "prediction")
    return [
        F.count_if((label == 1) & (predicted == 1)).alias("tp"), F.count_if((label == 0) & (predicted == 1)).alias("fp"),
        F.count_if((label == 1) & (predicted == 0)).alias("fn"), F.count_if((label == 0) & (predicted == 0)).alias("tn"),
    ]


def _rates():
    """precision, recall and F1 of the positive class; 0 where undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return [ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
            ratio(2 * tp, 2 * tp + fp + fn).alias("f1")]


def binary_metrics(df: DataFrame, label: str, prediction: str, score: str | None = None,
                   by: list[str] | None = None) -> DataFrame:
    """accuracy, precision, recall, F1 and - given a score - ROC-AUC (0 where undefined)."""
    by = list(by or [])
    counts = df.groupBy(*by).agg(*_counts(F.col(label), F.col(prediction)))
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    out = counts.select(*by, ratio(F.col("tp") + F.col("tn"), total).alias("accuracy"), *_rates())
    if score is None:
        return out
    auc = roc_auc(score_curve(df, label, score, by), by)
    return out.join(auc, by, "left") if by else out.withColumn("roc_auc", auc.scalar())


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """The four rows ``(actual, predicted, n)``."""
    row = df.agg(*_counts(F.col(label), F.col(prediction)))
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n")) for a, p, c in cells])))


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows ``(name, precision, recall, f1, support)``: every class, accuracy, macro and weighted averages.

    Works for any number of classes. In the accuracy row all three figures are the accuracy.
    """
    pairs = df.groupBy(F.col(label).cast("string").alias("actual"), F.col(prediction).cast("string").alias("given")).agg(
        F.count(F.lit(1)).alias("n"))
    # one row per class from the class-pair counts: as actual, as predicted, as both
    sides = pairs.select(F.inline(F.array(
        F.struct(F.col("actual").alias("name"), F.col("n").alias("support"), F.lit(0).cast("long").alias("given"),
                 F.when(F.col("actual") == F.col("given"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("given").alias("name"), F.lit(0).cast("long").alias("support"), F.col("n").alias("given"),
                 F.lit(0).cast("long").alias("hit")))))
    totals = sides.groupBy("name").agg(*[F.sum(c).alias(c) for c in ("support", "given", "hit")])
    classes = totals.select(
        "name", ratio(F.col("hit"), F.col("given")).alias("precision"), ratio(F.col("hit"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hit"), F.col("given") + F.col("support")).alias("f1"), "support", "hit")
    figures = ("precision", "recall", "f1")
    macro = classes.agg(F.lit("macro avg").alias("name"), *[F.avg(c).alias(c) for c in figures],
                        F.sum("support").alias("support"))
    weighted = classes.agg(
        F.lit("weighted avg").alias("name"),
        *[ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in figures],
        F.sum("support").alias("support"))
    accuracy = classes.agg(
        F.lit("accuracy").alias("name"), *[ratio(F.sum("hit"), F.sum("support")).alias(c) for c in figures],
        F.sum("support").alias("support"))
    return classes.drop("hit").unionByName(accuracy).unionByName(macro).unionByName(weighted)


def brier_score(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    gap = F.col(score) - F.col(label)
    return df.groupBy(*(by or [])).agg(F.avg(gap * gap).alias("brier_score"))


# ---- curves -------------------------------------------------------------------------

def score_groups(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Rows ``([by,] score, pos, neg)``: one per distinct score, combined before the shuffle.

    Labels other than 0 and 1, and scores that are NULL or NaN, are errors: they have no place on a curve.
    """
    placed = F.when(F.col(score).isNull() | F.isnan(F.col(score).cast("double")), F.raise_error(F.lit("a score is NULL or NaN")))
    actual = _binary(F.col(label), "label")
    return df.groupBy(*(by or []), placed.otherwise(F.col(score)).alias("score")).agg(
        F.count_if(actual == 1).alias("pos"), F.count_if(actual == 0).alias("neg"))


def score_curve(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Rows ``([by,] score, pos, neg, tp, fp, positives, negatives)``, score descending.

    ``tp`` and ``fp`` count the rows at or above the score. All ranking metrics are
    aggregates of this frame.
    """
    by = list(by or [])
    totals = running_totals(score_groups(df, label, score, by), "score", ["pos", "neg"], by, descending=True)
    return totals.select(*by, "score", "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                         F.col("all_pos").alias("positives"), F.col("all_neg").alias("negatives"))


def _curve_precision():
    return ratio(F.col("tp"), F.col("tp") + F.col("fp"))


def _curve_recall():
    """With no positives at all, recall is taken as 1."""
    return F.when(F.col("positives") == 0, F.lit(1.0)).otherwise(ratio(F.col("tp"), F.col("positives")))


def pr_curve(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows ``([by,] threshold, precision, recall)``, and the end point (NULL, 1, 0)."""
    by = list(by or [])
    points = curve.select(*by, F.col("score").alias("threshold"), _curve_precision().alias("precision"),
                          _curve_recall().alias("recall"))
    ends = curve.groupBy(*by).agg(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                                  F.lit(0.0).alias("recall"))
    return points.unionByName(ends)


def roc_curve(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows ``([by,] threshold, fpr, tpr)``, and the start (infinity, 0, 0)."""
    by = list(by or [])
    points = curve.select(*by, F.col("score").alias("threshold"), ratio(F.col("fp"), F.col("negatives")).alias("fpr"),
                          ratio(F.col("tp"), F.col("positives")).alias("tpr"))
    start = curve.groupBy(*by).agg(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                                   F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def average_precision(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sum over scores of recall gained times precision ("PR-AUC")."""
    gained = ratio(F.col("pos"), F.col("positives"))
    return curve.groupBy(*(by or [])).agg(F.coalesce(F.sum(gained * _curve_precision()), F.lit(0.0)).alias("pr_auc"))


def roc_auc(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Probability that a positive outranks a negative, ties counting half; 0 where undefined."""
    outranked = F.col("neg") * (F.col("tp") - F.col("pos") + F.col("pos") * 0.5)
    pairs = F.max("positives").cast("double") * F.max("negatives")
    return curve.groupBy(*(by or [])).agg(F.coalesce(ratio(F.sum(outranked), pairs), F.lit(0.0)).alias("roc_auc"))


def optimal_threshold(curve: DataFrame, min_recall: float = MIN_RECALL, by: list[str] | None = None) -> DataFrame:
    """Row ``([by,] threshold)``: most precise score that keeps the recall; smallest on a tie, else 0.5.

    The end point of the curve (recall 0) belongs to the candidates only if the recall
    asked for is 0; it has no threshold and therefore never wins.
    """
    reaches = _curve_recall() >= min_recall
    best = F.min(F.when(reaches, F.struct((-_curve_precision()).alias("p"), F.col("score").alias("threshold"))))
    return curve.groupBy(*(by or [])).agg(F.coalesce(best["threshold"], F.lit(DEFAULT_THRESHOLD)).alias("threshold"))


def precision_recall_at_k(df: DataFrame, key: str, label: str, score: str, shares=(0.10, 0.05),
                          curve: DataFrame | None = None) -> DataFrame:
    """Rows ``(k, rows, precision_at_k, recall_at_k)`` for the top ``int(n * k)`` rows by score, then key.

    Scores above the cut are taken from the curve as whole groups. Only the rows that share
    the score at the cut are ordered by key.
    """
    if curve is None:
        curve = score_curve(df, label, score)
    totals = curve.agg(F.max("positives").alias("p"), F.max("negatives").alias("n")).first()
    positives, n = totals["p"] or 0, (totals["p"] or 0) + (totals["n"] or 0)
    rows = []
    for share in shares:
        m = int(n * share)
        hits = _top_hits(df, key, label, score, curve, m) if m > 0 else 0
        rows.append((float(share), m, hits / m if m else 0.0, hits / positives if m and positives else 0.0))
    return df.sparkSession.createDataFrame(rows, "k double, rows long, precision_at_k double, recall_at_k double")


def _top_hits(df, key, label, score, curve, m: int) -> int:
    """Positives among the first ``m`` rows by score (descending) and key."""
    cut = curve.where(F.col("tp") + F.col("fp") >= m).orderBy(F.desc("score")).limit(1).first()
    hits_above, rows_above = cut["tp"] - cut["pos"], cut["tp"] + cut["fp"] - cut["pos"] - cut["neg"]
    wanted = m - rows_above
    if wanted == cut["pos"] + cut["neg"]:
        return hits_above + cut["pos"]
    tied = df.where(F.col(score) == F.lit(cut["score"]))
    hit = F.count_if(F.col(label) == 1).alias("hits")
    if wanted <= SMALL_ROWS:
        return hits_above + tied.orderBy(key).limit(wanted).agg(hit).first()["hits"]
    per_key = tied.groupBy(key).agg(hit, F.count(F.lit(1)).alias("n"))
    ordered = running_totals(per_key, key, ["n"]).where(F.col("cum_n") <= wanted)
    return hits_above + ordered.agg(F.sum("hits").alias("hits")).first()["hits"]


def metrics_at_threshold(df: DataFrame, label: str, score: str, thresholds: DataFrame,
                         by: list[str] | None = None) -> DataFrame:
    """Row ``([by,] threshold, tp, fp, fn, tn, precision, recall, f1)``; a row is positive if score >= threshold."""
    by = list(by or [])
    if by:
        marked = attach_small(df, thresholds, by)
    else:
        marked = df.withColumn("threshold", thresholds.select("threshold").scalar())
    decided = marked.withColumn("_p", (F.col(score) >= F.col("threshold")).cast("int"))
    counts = decided.groupBy(*by, "threshold").agg(*_counts(F.col(label), F.col("_p")))
    return counts.select(*by, "threshold", "tp", "fp", "fn", "tn", *_rates())


# ---- several models -------------------------------------------------------------------

def evaluate_models(df: DataFrame, label: str, score: str, min_recall: float = MIN_RECALL,
                    decide_at: float = DEFAULT_THRESHOLD, curve: DataFrame | None = None) -> DataFrame:
    """One row per ``model``: ranking metrics, metrics at ``decide_at``, chosen threshold and what it gives.

    Everything is read off the curve, so the scored rows are scanned once.
    """
    by = ["model"]
    if curve is None:
        curve = score_curve(df, label, score, by)
    chosen = optimal_threshold(curve, min_recall, by)
    with_threshold = attach_small(curve, chosen, by)

    def at(limit, suffix):
        """tp and fp at a threshold are those of the smallest score not below it."""
        kept = F.col("score") >= limit
        tp = F.coalesce(F.max(F.when(kept, F.col("tp"))), F.lit(0))
        fp = F.coalesce(F.max(F.when(kept, F.col("fp"))), F.lit(0))
        return [tp.alias(f"tp{suffix}"), fp.alias(f"fp{suffix}")]

    gained = ratio(F.col("pos"), F.col("positives"))
    outranked = F.col("neg") * (F.col("tp") - F.col("pos") + F.col("pos") * 0.5)
    squares = F.col("pos") * F.pow(F.col("score") - 1, F.lit(2)) + F.col("neg") * F.pow(F.col("score"), F.lit(2))
    summed = with_threshold.groupBy("model", "threshold").agg(
        F.max("positives").alias("positives"), F.max("negatives").alias("negatives"),
        F.coalesce(F.sum(gained * _curve_precision()), F.lit(0.0)).alias("pr_auc"),
        F.sum(outranked).alias("_outranked"), F.sum(squares).alias("_squares"), *at(F.lit(decide_at), "_d"), *at(F.col("threshold"), "_t"))

    def rates(s, prefix):
        tp, fp, positives = F.col(f"tp{s}"), F.col(f"fp{s}"), F.col("positives")
        return [ratio(tp, tp + fp).alias(f"{prefix}precision"), ratio(tp, positives).alias(f"{prefix}recall"),
                ratio(2 * tp, tp + fp + positives).alias(f"{prefix}f1")]

    return summed.select(
        "model", "pr_auc",
        ratio(F.col("_outranked"), F.col("positives").cast("double") * F.col("negatives")).alias("roc_auc"),
        *rates("_d", ""), "threshold", *rates("_t", "best_"),
        ratio(F.col("_squares"), F.col("positives") + F.col("negatives")).alias("brier_score"))


def leaderboard(results: DataFrame, by: str = "pr_auc") -> DataFrame:
    """``results`` with ``rank``, best first. One row per model, so the ranking is small."""
    return results.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(by), "model")))


def best_model(results: DataFrame, by: str = "pr_auc") -> DataFrame:
    """One row ``(best_model, <by>, runner_up)``."""
    ranked = leaderboard(results, by)
    return ranked.agg(
        F.max(F.when(F.col("rank") == 1, F.col("model"))).alias("best_model"),
        F.max(F.when(F.col("rank") == 1, F.col(by))).alias(by),
        F.max(F.when(F.col("rank") == 2, F.col("model"))).alias("runner_up"))


def long_metrics(results: DataFrame, key: str = "model") -> DataFrame:
    """Rows ``(model, metric, value)`` from a table with one column per metric."""
    names = [c for c in results.columns if c != key]
    return results.select(key, F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in names])))


def format_metrics(metrics: DataFrame, decimals: int = 4) -> DataFrame:
    """``value`` as text with a fixed number of decimals."""
    return metrics.withColumn("value", F.format_string(f"%.{decimals}f", F.col("value")))
