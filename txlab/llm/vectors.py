"""Near-duplicates among embeddings: an exact range join over cells around pivots."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import freeze
from .components import components

#: Linked vectors have this cosine at least.
COSINE = 0.95
#: Vectors per pivot, on average; rows of a cell and visitors that one task compares; rows compared at a time.
CELL = 2048
HOME_BLOCK = 4096
VISITOR_BLOCK = 8192
TILE = 1024
#: Pivots are chosen from so many vectors, those with the smallest hashes.
PIVOT_SAMPLE = 4096
#: Margin for rounding when bounds rule a cell out; comparisons themselves have none.
SLACK = 1e-6


def _unit(lists: pa.Array | pd.Series, width: int) -> np.ndarray:
    """Rows of unit length in double precision; shorter vectors are filled with zeros."""
    out = np.zeros((len(lists), width))
    for k, x in enumerate(lists):
        out[k, :len(x)] = x
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows of ``sample`` that lie far from each other: each next one is the farthest from those chosen."""
    chosen = [0]
    far = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(count, len(sample)) and far.max() > SLACK:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def _compare(home: np.ndarray, other: np.ndarray, weights_home: np.ndarray, weights_other: np.ndarray, cosine: float, same: bool):
    """Links within a cell or from its visitors to it: what each row is linked to in sum, and a spanning forest.

    Positions of ``other`` follow those of ``home``; with ``same`` the two are one set.
    """
    n = len(home)
    count_home, count_other = np.zeros(n, np.int64), np.zeros(len(other), np.int64)
    parent = np.arange(n + (0 if same else len(other)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    forest = []
    for i in range(0, n, TILE):
        for j in range(i if same else 0, len(other), TILE):
            hit = home[i:i + TILE] @ other[j:j + TILE].T >= cosine
            if same and i == j:
                hit = np.triu(hit, 1)
            if not hit.any():
                continue
            count_home[i:i + TILE] += hit @ weights_other[j:j + TILE]
            count_other[j:j + TILE] += hit.T @ weights_home[i:i + TILE]
            for r, c in zip(*np.nonzero(hit)):
                a, b = root(i + r), root(j + c + (0 if same else n))
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    forest.append((i + r, j + c + (0 if same else n)))
    return (count_home + count_other if same else np.concatenate([count_home, count_other])), forest


def near_duplicates(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """``key, n_links, component, valid`` for every row of ``vectors``; ``component`` is the smallest key reachable.

    Two vectors of equal length are linked if their cosine, in double precision, is ``cosine`` or more. NULL vectors,
    zero vectors and those with NULL or non-finite components link with nothing and are components of their own; so
    are rows with a NULL key as far as names go. Equal vectors are one point that counts as many times as it occurs.

    Unit vectors at that cosine are within r = sqrt(2 - 2 cosine). A point's home is the cell of its nearest pivot; it
    visits the cell of another pivot p only if it can have a link there: by the triangle inequality its distance to p
    is at most that to its own pivot and 2 r, and at most the cell's radius and r. Of two cells the one with the larger number is
    visited. Cells join independently, in blocks of bounded size, and give sums and a spanning forest instead of pairs,
    so a group of thousands of near copies gives rows in proportion. Vectors without clusters in many
    dimensions lie about equally far from all pivots: then nearly every cell is visited and all pairs are compared.
    """
    every = vectors.select(F.col(key).alias("key"), F.col(embedding).cast("array<double>").alias("e"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    every = every.withColumn("ok", F.coalesce(F.col("e").isNotNull() & finite & F.exists("e", lambda x: x != 0), F.lit(False)))
    every = every.withColumn("h", F.when(F.col("ok"), F.sha2(F.array_join(F.col("e").cast("array<string>"), ",").cast("binary"), 256)))
    every = freeze(every, "vectors")
    points = every.where("ok").groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.first("e").alias("e"))
    points = freeze(points.withColumn("d", F.size("e")).withColumn("id", F.xxhash64("h")), "points")
    total, width = points.agg(F.count(F.lit(1)), F.coalesce(F.max("d"), F.lit(1))).first()
    sample = points.select("h", "e").orderBy("h").limit(PIVOT_SAMPLE).toPandas()  # at most PIVOT_SAMPLE rows
    cells = max(1, math.ceil(total / CELL))
    pivots = choose_pivots(_unit(sample["e"], width), cells) if total else np.zeros((1, width))
    r = math.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK
    shared = points.sparkSession.sparkContext.broadcast(pivots)  # one vector for CELL points, PIVOT_SAMPLE at most

    def distances(e: pd.Series) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2 - 2 * _unit(e, width) @ shared.value.T))

    def home(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            d = distances(f["e"])
            yield pd.DataFrame({"cell": d.argmin(axis=1), "far": d.min(axis=1)})

    radius = np.zeros(len(pivots))
    for row in points.select("e").mapInPandas(home, "cell int, far double").groupBy("cell").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect():  # one per pivot
        radius[row.cell] = row.far
    reach = points.sparkSession.sparkContext.broadcast(radius)

    def visits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for k in range(0, len(f), 256):
                g = f.iloc[k:k + 256]
                d = distances(g["e"])
                own, least = d.argmin(axis=1), d.min(axis=1)
                go = (d <= least[:, None] + 2 * r + SLACK) & (d <= reach.value[None, :] + r + SLACK) & (np.arange(d.shape[1])[None, :] > own[:, None])
                go[np.arange(len(g)), own] = True
                i, c = np.nonzero(go)
                out = g.iloc[i][["h", "d", "n", "e"]].reset_index(drop=True)
                out.insert(0, "cell", c.astype("int32"))
                out.insert(1, "at_home", c == own[i])
                yield out

    placed = freeze(points.select("h", "d", "n", "e").withColumn("e", F.col("e").cast("array<double>"))
                    .mapInPandas(visits, "cell int, at_home boolean, h string, d int, n bigint, e array<double>"), "cells")
    # Rows of a cell in blocks of bounded size: block numbers come from counts, and every pair of blocks is one group.
    sizes = placed.groupBy("cell", "d", "at_home").agg(F.count(F.lit(1)).alias("m"))
    blocks = (sizes.groupBy("cell", "d").agg(
        F.coalesce(F.max(F.when(F.col("at_home"), F.ceil(F.col("m") / HOME_BLOCK))), F.lit(0)).cast("int").alias("hb"),
        F.coalesce(F.max(F.when(~F.col("at_home"), F.ceil(F.col("m") / VISITOR_BLOCK))), F.lit(0)).cast("int").alias("vb")).where("hb > 0"))
    x = placed.join(blocks, ["cell", "d"])
    b = F.pmod(F.xxhash64("h"), F.when(F.col("at_home"), F.col("hb")).otherwise(F.col("vb"))).cast("int")
    x = x.withColumn("b", b)
    with_home = F.transform(F.sequence(F.lit(0), F.col("hb") - 1), lambda k: F.struct(F.least(k, F.col("b")).alias("p"), F.greatest(k, F.col("b")).alias("q")))
    with_visitors = F.when(F.col("vb") > 0, F.transform(F.sequence(F.lit(0), F.col("vb") - 1), lambda k: F.struct(F.col("b").alias("p"), (-1 - k).alias("q")))).otherwise(F.array().cast("array<struct<p:int,q:int>>"))
    as_visitor = F.transform(F.sequence(F.lit(0), F.col("hb") - 1), lambda k: F.struct(k.alias("p"), (-1 - F.col("b")).alias("q")))
    tasks = F.when(F.col("at_home"), F.concat(with_home, with_visitors)).otherwise(as_visitor)
    x = x.select("cell", "d", "at_home", "b", "h", "n", "e", F.inline(tasks))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        p, q = int(group["p"].iloc[0]), int(group["q"].iloc[0])
        left = group[group["at_home"] & (group["b"] == p)]
        right = left if p == q else group[group["at_home"] & (group["b"] == q)] if q >= 0 else group[~group["at_home"]]
        if not len(left) or not len(right):
            return pd.DataFrame({"h": [], "links": [], "to": []}).astype({"h": str, "links": "int64", "to": str})
        u, v = _unit(left["e"], width), _unit(right["e"], width)
        counts, forest = _compare(u, v, left["n"].to_numpy(), right["n"].to_numpy(), cosine, p == q)
        names = left["h"].to_numpy() if p == q else np.concatenate([left["h"].to_numpy(), right["h"].to_numpy()])
        hit = np.flatnonzero(counts)
        a = pd.DataFrame({"h": names[hit], "links": counts[hit], "to": None})
        z = pd.DataFrame({"h": [names[i] for i, _ in forest], "links": 0, "to": [names[j] for _, j in forest]})
        return pd.concat([a, z])

    found = freeze(x.groupBy("cell", "d", "p", "q").applyInPandas(compare, "h string, links bigint, to string"), "found")
    links = found.groupBy("h").agg(F.sum("links").alias("links"))
    groups = components(found.where("to IS NOT NULL"), "h", "to")
    placed_points = (points.select("h", "n", "low").join(links, "h", "left").join(groups.withColumnRenamed("node", "h"), "h", "left")
                     .select("h", "low", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "h").alias("group")))
    names = placed_points.groupBy("group").agg(F.min("low").alias("component"))
    known = placed_points.join(names, "group").select(F.col("h").alias("_h"), "n_links", "component")
    out = every.join(known, every["h"] == known["_h"], "left")
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.when(F.col("ok"), F.col("component")).otherwise(F.col("key")).alias("component"), F.col("ok").alias("valid"))
