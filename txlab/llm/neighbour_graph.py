"""Approximate nearest neighbours: NN-descent builds a graph by joins of neighbours of neighbours, queries search it greedily."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import freeze

#: Neighbours a node keeps, and nodes pointing to it that join in a round: the method's own sampling, chosen by hash.
DEGREE = 32
REVERSE = 32
#: The graph starts from points that lie together in the sorted order of their sides of random planes.
TREES = 4
PLANES = 24
LEAF = 512
#: Rounds end when fewer than this share of neighbours changed, or after so many.
SETTLED = 0.02
ROUNDS = 8
#: Nodes whose neighbours one task joins; small inputs are dealt to some tasks too.
CELL = 4096
CELLS = 16
#: Best points a search keeps, points it expands in a round, and what it returns for the exact comparison.
BEAM = 256
STEP = 96
FINAL = 16
#: Points by whose nearness a search enters the graph, those with the smallest hashes.
ENTRIES = 256
ENTER = 8
SEED = 7


def _unit(lists: list, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width))
    for k, x in enumerate(lists):
        out[k, :len(x)] = x
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _binary(a: np.ndarray) -> pa.Array:
    a = np.ascontiguousarray(a)
    return pa.array([r.tobytes() for r in a], pa.binary())


def points_of(vectors: DataFrame, embedding: str) -> DataFrame:
    """``vectors`` with ``_e`` (doubles), ``_ok`` (takes part) and ``_h`` (names equal vectors)."""
    v = vectors.withColumn("_e", F.col(embedding).cast("array<double>"))
    finite = F.forall("_e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.withColumn("_ok", F.coalesce(finite & F.exists("_e", lambda x: x != 0), F.lit(False)))
    # 0.0 and -0.0 are one number
    return v.withColumn("_h", F.when(F.col("_ok"), F.sha2(F.array_join(F.transform("_e", lambda x: (x + F.lit(0.0)).cast("string")), ",").cast("binary"), 256)))


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(flat, kind))


def _merged(limit: int, step: int = 0):
    """A function over batches whose columns end with ``us, ss, olds, new_us, new_ss``: the best ``limit`` of both lists, each node once.

    What was there is old afterwards; with ``step`` only the first so many that were not old yet become old.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list[np.ndarray]] = [[], [], []]
            keep = b.num_columns - 5
            for row in zip(*[b.column(keep + k).to_pylist() for k in range(5)]):
                u, s, old = np.array(row[0], np.int64), np.array(row[1], np.float32), np.array(row[2], bool)
                if step:
                    old[np.flatnonzero(~old)[:step]] = True
                else:
                    old[:] = True
                if row[3]:
                    u, s = np.concatenate([u, np.array(row[3], np.int64)]), np.concatenate([s, np.array(row[4], np.float32)])
                    old = np.concatenate([old, np.zeros(len(row[3]), bool)])
                    _, once = np.unique(u, return_index=True)  # the first of equals, so an old one stays old
                    u, s, old = u[once], s[once], old[once]
                order = np.lexsort((u, -s))[:limit]
                for k, x in enumerate((u, s, old)):
                    out[k].append(x[order])
            yield pa.RecordBatch.from_arrays([b.column(k) for k in range(keep)] + [_lists(out[0], pa.int64()), _lists(out[1], pa.float32()), _lists(out[2], pa.bool_())],
                                             [*b.schema.names[:keep], "us", "ss", "olds"])
    return run


_STATE = "us array<long>, ss array<float>, olds array<boolean>"
_NONE = ("CAST(array() AS array<bigint>) AS us", "CAST(array() AS array<float>) AS ss", "CAST(array() AS array<boolean>) AS olds")


def _added(state: DataFrame, new: DataFrame, by: str, limit: int, step: int = 0) -> DataFrame:
    """``state`` (one row per ``by``) with the best of what it has and of ``new`` (``by, u, s``, a bounded number per ``by``)."""
    lists = new.groupBy(F.col(by).alias("_by")).agg(F.collect_list(F.struct("u", "s")).alias("_n")).select("_by", F.col("_n.u").alias("new_us"), F.col("_n.s").alias("new_ss"))
    keep = [c for c in state.columns if c not in ("us", "ss", "olds")]
    both = state.join(lists, F.col(by) == F.col("_by"), "left").select(*keep, "us", "ss", "olds", "new_us", "new_ss")
    return both.mapInArrow(_merged(limit, step), ", ".join(f"{c} {dict(state.dtypes)[c]}" for c in keep) + ", " + _STATE)


def _top_rows(a: np.ndarray, b: np.ndarray, s: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs ``a, b``, the ``count`` with the largest ``s`` for each ``a``."""
    _, once = np.unique((a.astype(np.int64) << 32) + b, return_index=True)
    a, b, s = a[once], b[once], s[once]
    order = np.lexsort((-s, a))
    a, b, s = a[order], b[order], s[order]
    first = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else np.zeros(0, np.int64)
    place = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a))))
    return a[place < count], b[place < count], s[place < count]


def _first_graph(nodes: DataFrame, width: int, degree: int) -> DataFrame:
    """``v, u, s``: neighbours among those that follow each other in an order by sides of random planes, for several sets of planes."""
    planes = np.random.default_rng(SEED).normal(size=(TREES, PLANES, width)).astype(np.float32)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.frombuffer(b"".join(b.column(1).to_pylist()), np.float16).reshape(b.num_rows, width).astype(np.float32)
            for t in range(TREES):
                code = ((x @ planes[t].T > 0) << np.arange(PLANES)).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, t, np.int32)), pa.array(code.astype(np.int64)), b.column(0), b.column(1)],
                                                 ["tree", "code", "v", "x"])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def joined(t: pa.Table) -> pa.RecordBatch:
            v, x = t.column("v").to_numpy(), np.frombuffer(b"".join(t.column("x").to_pylist()), np.float16).reshape(len(t), width).astype(np.float32)
            s = x @ x.T
            same = v[:, None] == v[None, :]
            s[same] = -2
            count = min(degree, len(v))
            near = np.argpartition(-s, count - 1, axis=1)[:, :count]
            i, k = np.nonzero(np.take_along_axis(s, near, axis=1) > -2)
            return pa.RecordBatch.from_arrays([pa.array(v[i]), pa.array(v[near[i, k]]), pa.array(s[i, near[i, k]])], ["v", "u", "s"])

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= 2 * LEAF:
                t = pa.Table.from_batches(held)
                whole = len(t) // LEAF - 1
                for k in range(whole):
                    yield joined(t.slice(k * LEAF, LEAF))
                held = t.slice(whole * LEAF).to_batches()
        if held:
            t = pa.Table.from_batches(held)
            for k in range(0, len(t), LEAF):  # the last two leaves of a partition share what is left
                yield joined(t.slice(k, LEAF) if len(t) - k >= LEAF else t.slice(max(0, len(t) - LEAF), LEAF))

    placed = nodes.select("v", "x").mapInArrow(place, "tree int, code long, v long, x binary")
    ordered = placed.repartitionByRange("tree", "code", "v").sortWithinPartitions("tree", "code", "v")
    return ordered.mapInArrow(leaves, "v long, u long, s float")


def _join_neighbours(graph: DataFrame, cells: int, width: int, degree: int, reverse: int, turn: int) -> DataFrame:
    """``v, u, s`` better than what ``v`` has: pairs among the neighbours of a node, of which at least one is new to it.

    Nodes are dealt to ``cells``; a cell gets its light links and, once each, the vectors of the neighbours in it.
    """
    pairs = graph.select("v", F.inline(F.arrays_zip("us", "olds"))).toDF("v", "u", "old")
    into = Window.partitionBy("u").orderBy(F.xxhash64("v", "u", F.lit(turn)))
    back = pairs.withColumn("_r", F.row_number().over(into)).where(F.col("_r") <= reverse).select(F.col("u").alias("v"), F.col("v").alias("u"), "old")
    around = pairs.union(back).groupBy("v").agg(F.collect_list(F.struct("u", "old")).alias("_l")).where("exists(_l, x -> NOT x.old)")
    links = freeze(around.select(F.pmod(F.xxhash64("v"), F.lit(cells)).cast("int").alias("cell"), "v", F.inline("_l")), "links")
    full = F.when(F.size("us") >= degree, F.element_at("ss", -1)).otherwise(F.lit(-2.0)).cast("float")
    known = graph.select(F.col("v").alias("name"), "x", full.alias("least"))
    sent = links.select(F.col("cell").alias("_cell"), F.col("u").alias("name")).distinct().join(known, "name")

    def work(links: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        name = vectors["name"].to_numpy()
        order = np.argsort(name)
        name = name[order]
        x = np.frombuffer(b"".join(vectors["x"].to_numpy()[order]), np.float16).reshape(len(name), width).astype(np.float32)
        least = vectors["least"].to_numpy()[order]
        links = links.sort_values(["v", "u", "old"]).drop_duplicates(["v", "u"])
        u, old = np.searchsorted(name, links["u"].to_numpy()), links["old"].to_numpy()
        v = links["v"].to_numpy()
        first = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
        size = np.diff(np.append(first, len(v)))
        found: list[tuple] = []
        rows = 0
        for a in range(0, len(first), 256):
            f, n = first[a:a + 256], size[a:a + 256]
            at = f[:, None] + np.arange(n.max())[None, :]
            real = np.arange(n.max())[None, :] < n[:, None]
            at = np.where(real, at, 0)
            b, o = np.where(real, u[at], 0), old[at]
            y = x[b]
            g = y @ y.transpose(0, 2, 1)
            good = (g > least[b][:, :, None]) & real[:, :, None] & real[:, None, :] & ~(o[:, :, None] & o[:, None, :]) & (b[:, :, None] != b[:, None, :])
            i, j, k = np.nonzero(good)
            found.append((b[i, j], b[i, k], g[i, j, k]))
            rows += len(i)
            if rows > 3_000_000:
                found = [_top_rows(*map(np.concatenate, zip(*found)), degree)]
                rows = len(found[0][0])
        p, q, s = _top_rows(*map(np.concatenate, zip(*found)), degree)
        return pd.DataFrame({"v": name[p], "u": name[q], "s": s})

    return links.groupBy("cell").cogroup(sent.groupBy("_cell")).applyInPandas(work, "v long, u long, s float")


def build(nodes: DataFrame, width: int, count: int, degree: int = DEGREE, reverse: int = REVERSE, rounds: int = ROUNDS) -> DataFrame:
    """``v, us``: up to ``degree`` near nodes of every node, nearest first. ``nodes``: ``v`` (long, unique) and ``x`` (unit vector, half precision).

    NN-descent: neighbours of neighbours are likely neighbours. Each round joins, around every node, its neighbours with those that
    point to it, offers each pair to both ends, and keeps the best. Later rounds only look at pairs with a new member.
    """
    graph = freeze(_added(nodes.select("v", "x", *map(F.expr, _NONE)),
                          _first_graph(nodes, width, degree), "v", degree), "graph")
    cells = max(CELLS, math.ceil(count / CELL))
    for turn in range(rounds):
        graph = freeze(_added(graph, _join_neighbours(graph, cells, width, degree, reverse, turn), "v", degree), "graph")
        total, fresh = graph.agg(F.sum(F.size("us")), F.sum(F.size(F.filter("olds", lambda x: ~x)))).first()
        if not total or fresh <= SETTLED * total:
            break
    return graph.select("v", "us")


def search(graph: DataFrame, nodes: DataFrame, queries: DataFrame, width: int, count: int, beam: int = BEAM, step: int = STEP) -> DataFrame:
    """``q, us``: the best ``beam`` nodes that a greedy search finds for each query, nearest first.

    ``queries``: ``q`` (long, unique), ``y`` (unit vector, single precision), ``own`` (its node or NULL). A search starts at the query's own
    node, if it has one, and at the nearest of ``ENTRIES`` fixed nodes. Each round expands the best nodes
    of every beam that are not expanded yet; what their neighbours score is worked out where nodes of a cell and the queries that look
    at them meet, and only what improves a beam is returned. It ends when every node of every beam is expanded.
    """
    spark = graph.sparkSession
    entries = nodes.orderBy(F.xxhash64("v"), "v").limit(ENTRIES).select("v", "z").collect()  # ENTRIES rows at most
    names = np.array([e.v for e in entries], np.int64)
    shared = spark.sparkContext.broadcast(np.array([np.frombuffer(e.z, np.float32) for e in entries], np.float32).reshape(len(entries), width))
    cells = max(CELLS, math.ceil(count / CELL))

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = np.frombuffer(b"".join(b.column(1).to_pylist()), np.float32).reshape(b.num_rows, width)
            s = y @ shared.value.T
            us, ss = [], []
            for row, own in zip(s, b.column(2).to_pylist()):
                near = np.argsort(-row)[:ENTER]
                u, t = names[near], row[near]
                if own is not None:
                    u, t = np.append(u[u != own], own), np.append(t[u != own], np.float32(1))
                order = np.lexsort((u, -t))
                us.append(u[order])
                ss.append(t[order])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _lists(us, pa.int64()), _lists(ss, pa.float32()),
                                              _lists([np.zeros(len(u), bool) for u in us], pa.bool_())], ["q", "y", "us", "ss", "olds"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for q, y, u, s, at, c in zip(*[b.column(k).to_pylist() for k in range(6)]):
                least = s[-1] if len(u) >= beam else -2.0
                c, at = np.array(c, np.int64), np.array(at, np.int32)
                new = ~np.isin(c, np.array(u, np.int64))
                c, at = c[new], at[new]
                order = np.argsort(at, kind="stable")
                c, at = c[order], at[order]
                first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else np.zeros(0, np.int64)
                for a, z in zip(first, np.append(first[1:], len(at))):
                    for k, x in enumerate((int(at[a]), q, y, least, c[a:z])):
                        out[k].append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.float32()),
                                              _lists(out[4], pa.int64())], ["cell", "q", "y", "least", "us"])

    def score(asking: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        vectors = vectors.sort_values("u")
        name, z = vectors["u"].to_numpy(), np.frombuffer(b"".join(vectors["z"]), np.float32).reshape(len(vectors), width)
        found: list[tuple] = []
        for q, y, least, us in zip(asking["q"], asking["y"], asking["least"], asking["us"]):
            s = z[np.searchsorted(name, us)] @ np.frombuffer(y, np.float32)
            good = s > least
            found.append((np.full(good.sum(), q), us[good], s[good]))
        q, u, s = map(np.concatenate, zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))
        return pd.DataFrame({"q": q, "u": u, "s": s})

    cell = lambda c: F.pmod(F.xxhash64(c), F.lit(cells)).cast("int")
    beams = freeze(queries.select("q", "y", "own").mapInArrow(enter, "q long, y binary, " + _STATE), "beam")
    placed = nodes.select(cell(F.col("v")).alias("_cell"), F.col("v").alias("u"), "z")
    waiting = F.slice(F.transform(F.filter(F.arrays_zip("us", "olds"), lambda x: ~x["olds"]), lambda x: x["us"]), 1, step)
    while True:
        todo = beams.select("q", F.explode(waiting).alias("v"))
        if not todo.limit(1).count():
            return beams.select("q", "us")
        ahead = todo.join(graph, "v").groupBy("q").agg(F.array_distinct(F.flatten(F.collect_list("us"))).alias("_c")).select(F.col("q").alias("_q"), "_c")
        looking = beams.join(ahead, F.col("q") == F.col("_q")).select("q", "y", "us", "ss", F.transform("_c", cell).alias("_at"), "_c")
        asked = looking.mapInArrow(deal, "cell int, q long, y binary, least float, us array<long>")
        found = asked.groupBy("cell").cogroup(placed.groupBy("_cell")).applyInPandas(score, "q long, u long, s float")
        beams = freeze(_added(beams, found, "q", beam, step), "beam")


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two lists in double precision; a shorter one counts as filled with zeros."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: F.coalesce(p, F.lit(0.0)) * F.coalesce(q, F.lit(0.0))), F.lit(0.0), lambda t, z: t + z)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest(vectors: DataFrame, queries: Column, key: str = "vec_id", embedding: str = "embedding", count: int = 5, degree: int = DEGREE,
            beam: int = BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row for which ``queries`` holds, the ``count`` rows with the largest cosine that the search finds.

    Every valid row is in the index and is a candidate, except those with the query's own key. Equal vectors are one node of the graph with
    as many rows as it has, so a vector shared by a third of all rows costs one. Scores are recomputed in double precision on the
    original vectors; ties go to the smaller key. The search is approximate: README has its recall.

    NULL vectors, zero vectors and those with NULL or non-finite components neither ask nor answer, nor do rows with a NULL key. A shorter
    vector counts as filled with zeros. Repeated rows are candidates as often as they occur; a repeated query with one vector asks once. Fewer
    candidates than ``count`` give as many rows, an empty table none. Keys are integers; other columns are ignored.
    """
    rows = points_of(vectors.select(F.col(key).alias("vec_id"), F.col(embedding).alias("_v"), F.coalesce(queries, F.lit(False)).alias("_asks")), "_v")
    rows = freeze(rows.where("_ok AND vec_id IS NOT NULL").select("vec_id", "_asks", "_h", "_e", F.xxhash64("_h").alias("v")), "rows")
    distinct = rows.groupBy("_h").agg(F.first("_e").alias("_e"), F.first("v").alias("v"))
    total, names, width = distinct.agg(F.count(F.lit(1)), F.count_distinct("v"), F.coalesce(F.max(F.size("_e")), F.lit(1))).first()
    if names != total:
        raise RuntimeError("two vectors share a 64-bit name")

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u = _unit(b.column(1).to_pylist(), width) if b.num_rows else np.zeros((0, width))
            yield pa.RecordBatch.from_arrays([b.column(0), _binary(u.astype(np.float16)), _binary(u.astype(np.float32))], ["v", "x", "z"])

    nodes = freeze(distinct.select("v", "_e").mapInArrow(units, "v long, x binary, z binary"), "nodes")
    graph = build(nodes, width, total, degree)
    asked = rows.where("_asks").select("vec_id", "v").distinct()
    asked = freeze(asked.join(nodes.select("v", "z"), "v").select(F.xxhash64("vec_id", "v").alias("q"), F.col("vec_id").alias("query_id"), F.col("z").alias("y"), F.col("v").alias("own")), "asked")
    found = search(graph, nodes, asked.select("q", "y", "own"), width, total, beam)
    # Of a point only the rows with the smallest keys can be among the nearest: one more than wanted, for the query's own may be one.
    final = found.select("q", F.explode(F.slice("us", 1, max(FINAL, 2 * count + 1))).alias("u"))
    low = Window.partitionBy("v").orderBy("vec_id")
    rows_of = rows.groupBy("v", "vec_id").agg(F.count(F.lit(1)).alias("_times")).withColumn("_r", F.row_number().over(low)).where(F.col("_r") <= count + 1)
    shown = distinct.select("v", "_e")
    best = (final.join(asked.select("q", "query_id", F.col("own")), "q").join(shown.select(F.col("v").alias("u"), F.col("_e").alias("_b")), "u")
            .join(shown.select(F.col("v").alias("own"), F.col("_e").alias("_a")), "own").withColumn("score", cosine(F.col("_a"), F.col("_b"))).select("q", "query_id", "u", "score"))
    answers = best.join(rows_of.select(F.col("v").alias("u"), "vec_id", "_times"), "u").where(F.col("vec_id") != F.col("query_id"))
    answers = answers.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least("_times", F.lit(count)).cast("int"))))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "_copy"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= count).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
