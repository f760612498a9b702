"""Quantiles: exact with linear interpolation, or approximate in one pass."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from .ranks import running_totals

ACCURACY = 10_000
ONE_TASK_ROWS = 2_000_000  # most rows of a bracket that are ranked in one task
QUARTILES = (0.25, 0.5, 0.75)


def _clean(column: str):
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def approx_quantiles(df: DataFrame, columns: list[str], probs=QUARTILES, accuracy: int = ACCURACY) -> DataFrame:
    """One pass, rows ``(feature, prob, value)``; rank error at most ``1/accuracy``."""
    probs = list(probs)
    row = df.agg(*[F.percentile_approx(_clean(c), probs, accuracy).alias(c) for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("q")) for c in columns])
    per_feature = row.select(F.inline(cells))
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), F.col("q").alias("value"))
    return per_feature.select("feature", F.inline_outer(pairs)).toDF("feature", "prob", "value")


def exact_quantiles(df: DataFrame, columns: list[str], probs=QUARTILES, sketch: Row | None = None) -> DataFrame:
    """Rows ``(feature, prob, value)``, linear interpolation between neighbouring ranks.

    Pass 1 takes a sketch and brackets every wanted rank between two values. Pass 2
    counts what lies below each bracket and keeps only the distinct values inside it,
    a sliver of the data, which are then ranked exactly. The sketch only chooses the
    brackets; the wanted ranks are checked to lie inside them, and a bracket that
    misses is opened to the whole column, so the answer never depends on the sketch.
    ``sketch`` is a row with the columns of ``sketched``, if another pass has made them.
    """
    probs = [float(p) for p in probs]
    spark = df.sparkSession
    known, spans = [], []
    for feature, prob, low, high, under, upto, total in _bracketed(df, columns, probs, sketch):
        if total == 0:
            continue
        first, last = _wanted(prob, total)
        if not (under <= first and last < upto):
            low, high, under, upto = -math.inf, math.inf, 0, total
        if low == high:  # both ranks hold the same value, as in columns with few distinct values
            known.append((feature, prob, low))
        else:
            spans.append((feature, prob, low, high, under, first, last, prob * (total - 1) - first, upto - under))
    done = spark.createDataFrame(known, "feature string, prob double, value double")
    if not spans:
        return done

    # one row per cell that falls in a bracket; brackets of one column may overlap
    cells = F.array(*[
        F.when(_clean(s[0]).between(F.lit(s[2]), F.lit(s[3])),
               F.struct(F.lit(i).alias("span"), _clean(s[0]).alias("value")))
        for i, s in enumerate(spans)])
    inside = df.select(F.inline(F.array_compact(cells)))
    counted = inside.groupBy("span", "value").agg(F.count(F.lit(1)).alias("n"))
    if max(s[8] for s in spans) <= ONE_TASK_ROWS:
        upto_here = Window.partitionBy("span").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        ranked = counted.withColumn("cum_n", F.sum("n").over(upto_here))
    else:
        ranked = running_totals(counted, "value", ["n"], by=["span"])

    lookup = F.broadcast(spark.createDataFrame(  # a row per column and probability
        [(i, s[0], s[1], s[4], s[5], s[6], s[7]) for i, s in enumerate(spans)],
        "span int, feature string, prob double, under long, first long, last long, frac double"))
    upto = F.col("under") + F.col("cum_n")
    hits = ranked.join(lookup, "span").where((upto - F.col("n") <= F.col("last")) & (F.col("first") < upto))
    ends = hits.groupBy("feature", "prob", "frac").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")
    return ends.select("feature", "prob", value.alias("value")).unionByName(done)


def _wanted(prob: float, total: int) -> tuple[int, int]:
    """Zero-based ranks whose values are interpolated."""
    position = prob * (total - 1)
    return math.floor(position), math.ceil(position)


def sketched(columns: list[str], probs=QUARTILES) -> list[Column]:
    """Aggregates whose values bracket the wanted quantiles of each column, to go into a pass that is made anyway."""
    slack = 3.0 / ACCURACY
    asked = [edge for p in probs for edge in (max(0.0, p - slack), min(1.0, p + slack))]
    return [F.percentile_approx(_clean(c), asked, ACCURACY).alias(f"_sketch{i}") for i, c in enumerate(columns)]


def _bracketed(df: DataFrame, columns: list[str], probs: list[float], sketch: Row | None = None) -> list[tuple]:
    """``(column, prob, low, high, values below low, values up to high, values)`` per wanted quantile.

    Two aggregates, or one beside a given sketch, whose results are bounded by the width of the table.
    """
    sketch = sketch or df.agg(*sketched(columns, probs)).first()
    brackets = []
    for i, c in enumerate(columns):
        edges = sketch[f"_sketch{i}"]
        for j, p in enumerate(probs):
            low, high = (edges[2 * j], edges[2 * j + 1]) if edges else (-math.inf, math.inf)
            brackets.append((c, p, low, high))
    counts = df.agg(
        *[F.count(_clean(c)).alias(f"t_{c}") for c in columns],
        *[F.count_if(_clean(c) < F.lit(low)).alias(f"u{i}") for i, (c, _, low, _) in enumerate(brackets)],
        *[F.count_if(_clean(c) <= F.lit(high)).alias(f"h{i}") for i, (c, _, _, high) in enumerate(brackets)]).first()
    return [(*b, counts[f"u{i}"], counts[f"h{i}"], counts[f"t_{b[0]}"]) for i, b in enumerate(brackets)]
