"""Pearson correlations. Each is over the rows where both columns have a value."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import numeric_columns, present

#: Columns up to which one aggregate sums all pairs; the pairs of wider tables are summed tile by tile.
MAX_PAIRWISE = 50
#: Columns of a block: the sums of two blocks are a tile.
TILE = 64
#: Columns whose tiles, with all columns behind them, one scan sums.
STRIPE = 1024
#: Values of a batch that are worked on at a time, and partitions over which the tasks' sums of a tile are added.
CELLS = 1 << 20
SPREAD = 32
#: What is left of a sum of squares after its mean, as a share, if a column is constant up to rounding.
ROUNDING = 1e-12

SUMS = ["n", "xy", "x", "y", "xx", "yy"]


def _r(x: Column, y: Column) -> Column:
    """Correlation, NULL where one column is constant (``corr`` would raise)."""
    return F.try_divide(F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x)))


def target_correlation(df: DataFrame, label: str, top_n: int = 15) -> DataFrame:
    """Rows ``(feature, abs_corr)``: the ``top_n`` features by absolute correlation with the label."""
    features = numeric_columns(df, exclude=[label])
    y = present(df, label).cast("double")
    row = df.agg(*[F.abs(_r(present(df, c).cast("double"), y)).alias(f"r{i}") for i, c in enumerate(features)])
    cells = row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"r{i}").alias("abs_corr")) for i, c in enumerate(features)])))
    return cells.orderBy(F.desc_nulls_last("abs_corr"), "feature").limit(top_n)


def column_moments(df: DataFrame, columns: list[str]) -> tuple[int, dict]:
    """``(rows, {column: (values, mean, population std)})``, bounded by the width of the table."""
    value = {c: present(df, c).cast("double") for c in columns}
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[
        F.struct(F.count(v), F.avg(v), F.stddev_pop(v)).alias(f"c{i}") for i, v in enumerate(value.values())]).first()
    return row["rows"], {c: tuple(row[f"c{i}"]) for i, c in enumerate(columns)}


def _pearson(n: Column, xy: Column, x: Column, y: Column, xx: Column, yy: Column) -> Column:
    """Correlation from sums over the rows that have both values; NULL where one of them does not vary there."""
    def spread(total: Column, squares: Column) -> Column:
        left = squares - F.try_divide(total * total, n)
        return F.when(left > squares * ROUNDING, left)
    return F.try_divide(xy - F.try_divide(x * y, n), F.sqrt(spread(x, xx)) * F.sqrt(spread(y, yy)))


def correlation_pairs(df: DataFrame, columns: list[str], moments: tuple[int, dict] | None = None) -> DataFrame:
    """Rows ``(a, b, r)`` for every pair in column order; NULL where a column is constant or holds an infinity.

    From ``column_moments`` (or those given), values are standardised, and the products of each pair are summed over the
    rows that have both. Up to ``MAX_PAIRWISE`` columns that is one aggregate; the same sums of wider tables come from tiles.
    """
    value = {c: present(df, c).cast("double") for c in columns}
    rows, facts = moments or column_moments(df, columns)
    useful = [c for c in columns if facts[c][0] and facts[c][2] and math.isfinite(facts[c][1]) and math.isfinite(facts[c][2])]
    z = {c: (value[c] - F.lit(facts[c][1])) / F.lit(facts[c][2]) for c in useful}
    if len(useful) > MAX_PAIRWISE:
        found = _tiled_pairs(df.select(F.array(*[F.coalesce(value[c], F.lit(float("nan"))) for c in useful]).alias("v")), useful, facts)
    else:
        found = _summed_pairs(df, list(combinations(useful, 2)), z, {c: facts[c][0] == rows for c in useful}, rows)
    constant = [(a, b, None) for a, b in combinations(columns, 2) if a not in z or b not in z]
    return found.unionByName(df.sparkSession.createDataFrame(constant, "a string, b string, r double"))


def _summed_pairs(df: DataFrame, pairs: list[tuple], z: dict[str, Column], full: dict[str, bool], rows: int) -> DataFrame:
    """Correlations of some pairs by one aggregate. Columns without gaps have known sums beside that of the products."""
    if not pairs:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    sums, result = [], []
    for i, (a, b) in enumerate(pairs):
        sums.append(F.sum(z[a] * z[b]).alias(f"xy{i}"))
        if full[a] and full[b]:
            result.append(F.col(f"xy{i}") / F.lit(float(rows)))
            continue
        x, y = F.when(z[b].isNotNull(), z[a]), F.when(z[a].isNotNull(), z[b])
        sums += [F.count(z[a] * z[b]).cast("double").alias(f"n{i}"), F.sum(x).alias(f"x{i}"), F.sum(y).alias(f"y{i}"),
                 F.sum(x * x).alias(f"xx{i}"), F.sum(y * y).alias(f"yy{i}")]
        result.append(_pearson(*[F.col(f"{s}{i}") for s in SUMS]))
    return df.agg(*sums).select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("r")) for (a, b), r in zip(pairs, result)])))


def _tiled_pairs(values: DataFrame, columns: list[str], facts: dict[str, tuple]) -> DataFrame:
    """Correlations of all pairs from ``values`` (``v``: a row's values, NaN where there is none).

    Every task multiplies its standardised batches block by block and hands on one row of sums per tile, whatever its rows.
    The tiles are the keys by which tasks' rows meet, ``SPREAD`` partitions each, where they are added again; what is
    left is a sum per pair. Tables beyond ``STRIPE`` columns are read once for each so many, which bounds a task's sums.
    """
    mean, std = (np.array([facts[c][k] for c in columns]) for k in (1, 2))
    width, tile, stripe, at_once = len(columns), TILE, STRIPE, max(1, CELLS // len(columns))

    def partial(first: int):
        last = min(first + stripe, width)

        def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(SUMS), last - first, width - first))
            for batch in batches:
                cells = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                for k in range(0, len(cells), at_once):
                    here = (cells[k:k + at_once] - mean) / std
                    known = ~np.isnan(here)
                    z, m = np.where(known, here, 0.0)[:, first:], known[:, first:].astype("float64")
                    zl, ml = z[:, :last - first].T, m[:, :last - first].T
                    for out, (left, right) in zip(total, ((ml, m), (zl, z), (zl, m), (ml, z), (zl * zl, m), (ml, z * z))):
                        out += left @ right
            for i in range(0, last - first, tile):
                for j in range(i, width - first, tile):
                    part = total[:, i:i + tile, j:j + tile]
                    if part[0].any():
                        yield pa.RecordBatch.from_arrays([pa.array([first + i], "int32"), pa.array([first + j], "int32"), pa.array([part.ravel().tolist()])],
                                                         names=["i", "j", "s"])
        return sums

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for i, j, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                part = s.values.to_numpy()
                tiles[i, j] = tiles[i, j] + part if (i, j) in tiles else part
        for (i, j), part in tiles.items():
            rows, cols = min(tile, width - i), min(tile, width - j)
            a, b = (x.ravel() for x in np.meshgrid(np.arange(i, i + rows), np.arange(j, j + cols), indexing="ij"))
            upper = a < b
            sums = part.reshape(len(SUMS), -1)[:, upper]
            yield pa.RecordBatch.from_arrays([pa.array(a[upper].astype("int32")), pa.array(b[upper].astype("int32")), *[pa.array(x) for x in sums]],
                                             names=["a", "b", *SUMS])

    scans = [values.mapInArrow(partial(k), "i int, j int, s array<double>") for k in range(0, width, stripe)]
    parts = reduce(DataFrame.unionByName, scans).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SPREAD)))
    met = parts.repartition("i", "j", "salt").select("i", "j", "s").mapInArrow(added, "a int, b int, " + ", ".join(f"{s} double" for s in SUMS))
    pairs = met.groupBy("a", "b").agg(*[F.sum(s).alias(s) for s in SUMS])
    every = values.sparkSession.range(width * width).select((F.col("id") / width).cast("int").alias("a"), (F.col("id") % width).cast("int").alias("b")).where("a < b")
    name = lambda k: F.get(F.lit(columns), F.col(k)).alias(k)
    return every.join(pairs, ["a", "b"], "left").select(name("a"), name("b"), _pearson(*[F.col(s) for s in SUMS]).alias("r"))


def correlation_matrix(df: DataFrame, label: str, top_n: int = 15) -> DataFrame:
    """Rows ``(a, b, r)``: the full matrix of the label and its ``top_n`` correlates."""
    top = [r["feature"] for r in target_correlation(df, label, top_n).collect()]
    columns = [label, *top]
    upper = correlation_pairs(df, columns)
    lower = upper.select(F.col("b").alias("a"), F.col("a").alias("b"), "r")
    ones = df.sparkSession.createDataFrame([(c, c, 1.0) for c in columns], "a string, b string, r double")
    return upper.unionByName(lower).unionByName(ones)


def perfect_correlations(df: DataFrame, columns: list[str] | None = None, tolerance: float = 1e-9) -> DataFrame:
    """Pairs whose correlation is one in size, up to rounding error."""
    pairs = correlation_pairs(df, columns or numeric_columns(df))
    return pairs.where(F.abs("r") >= 1 - tolerance).select("a", "b")


__all__ = ["correlation_matrix", "correlation_pairs", "perfect_correlations", "target_correlation"]
