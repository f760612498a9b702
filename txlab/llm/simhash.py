"""Near-duplicates by SimHash and multi-index hashing, or by the similarity of their shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import freeze
from .components import components
from .lines import banded_groups
from .text import key_text, keyed_back

#: Words in a shingle, and the most bits in which linked fingerprints differ.
SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Search by similarity: bands of so many min-hashes each. A pair at 0.8 shares no band in one case of 400.
BANDS, BAND = 20, 6


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle of a text in order; a text of fewer words is one shingle, and no words give none."""
    import xxhash

    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, "<u8")
    line, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    n, h = max(1, len(words) - shingle + 1), xxhash.xxh64_intdigest
    starts = [0] + [e + 1 for e in ends[:n - 1]]
    return np.array([h(line[a:b], SEED) for a, b in zip(starts, ends[min(shingle, len(words)) - 1:])], dtype="<u8")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a whole text; no words give zero.

    A bit is set if it is set in over half of the shingles' XXH64 values, repeats included. bytes.lower() changes A-Z
    only, and bytes.split() parts at space and the controls 9 to 13.
    """
    values = shingle_hashes(text, shingle)
    n = len(values)
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 65_536):  # bounds the memory of a very long text
        ones += np.unpackbits(values[k:k + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def _text_id(key: str, text: str) -> list[Column]:
    """Two hashes that tell rows apart by key and text."""
    body = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(F.col(key), body).alias("_t1"), F.crc32(body.cast("binary")).alias("_t2")]


def fingerprints(docs: DataFrame, key: str, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``key, _t1, _t2`` (hashes of key and text) and ``fp`` (long, the 64 bits) for every row; texts are read once and not shuffled."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            bits = np.array([fingerprint(t, shingle) for t in f["_text"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({key: f[key], "_t1": f["_t1"], "_t2": f["_t2"], "fp": bits})

    return keyed_back(docs.select(key_text(key), *_text_id(key, text), F.col(text).alias("_text"))
                      .mapInPandas(run, f"`{key}` string, _t1 bigint, _t2 bigint, fp bigint"), docs, key)


def _segments(count: int) -> list[tuple[int, int]]:
    """Start and width of each segment of 64 bits."""
    cuts = [64 * k // count for k in range(count + 1)]
    return list(zip(cuts, np.diff(cuts).tolist()))


def links(fps: DataFrame, distance: int = DISTANCE, segments: int = 2) -> DataFrame:
    """``a, b`` (a < b): all pairs of different fingerprints (column ``fp``, each once) at most ``distance`` bits apart.

    Of ``segments`` parts of a fingerprint one differs in at most ``distance // segments`` bits, and two values that
    close lie in a common ball of half that radius (rounded up). So each fingerprint is entered in the table of a
    segment under every value in that small ball around its own, and looked up under the same values; entries under
    one value are candidates, and the join compares complete fingerprints before it gives a row. Only ``distance`` up
    to ``3 * segments - 1`` is accepted, for which balls of radius 1 are enough. With two segments a table has 2^32
    values, so random candidates stay few; a pair met under several values is kept once.
    """
    if segments < 2 or not 0 <= distance < 3 * segments:
        raise ValueError("two segments at least, and a distance below three times their number")
    radius = (distance // segments + 1) // 2
    def entries(k: int, start: int, width: int) -> Column:
        own = F.shiftrightunsigned("fp", start).bitwiseAND(F.lit((1 << width) - 1))
        masks = [0] + ([1 << i for i in range(width)] if radius else [])
        return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: F.struct(
            F.lit(k).cast("byte").alias("k"), own.bitwiseXOR(m).alias("v"), m.alias("m")))

    balls = F.concat(*[entries(k, *s) for k, s in enumerate(_segments(segments))])
    table = fps.select("fp", F.inline(balls))
    a, b = table.alias("a"), table.alias("b")
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance
    # Equal segments meet under their own value and again under each changed one: only the first counts.
    once = (F.col("a.m") != F.col("b.m")) | (F.col("a.m") == 0)
    # Spark reckons with the bytes before the balls are taken apart and would send a table 66 times as long through the driver.
    return (a.join(b.hint("merge"), (F.col("a.k") == F.col("b.k")) & (F.col("a.v") == F.col("b.v")) & (F.col("a.fp") < F.col("b.fp")) & near & once)
            .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).distinct())


def near_duplicates(docs: DataFrame, key: str, text: str = "text", distance: int = DISTANCE, shingle: int = SHINGLE) -> DataFrame:
    """``key, _t1, _t2, fp, component``: ``component`` is the smallest key reachable over links, the row's own included.

    Equal fingerprints are one node of the search, so thousands of copies cost one. NULL and empty texts have
    fingerprint zero and link like others. Rows with a NULL key take part but never name a component, unless a
    component has no other. Repeated rows give repeated rows; an empty table gives none.
    """
    fps = freeze(fingerprints(docs, key, text, shingle), "fingerprints")
    nodes = freeze(fps.groupBy("fp").agg(F.min(key).alias("low")), "nodes")
    groups = components(links(nodes.select("fp"), distance), "a", "b")
    placed = nodes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lowest = placed.groupBy("component").agg(F.min("low").alias("lowest"))
    names = placed.join(lowest, "component").select("fp", "lowest")
    return fps.join(names, "fp").select(key, "_t1", "_t2", "fp", F.col("lowest").alias("component"))


def bands(values: np.ndarray) -> list[int]:
    """The bands of a set of hashes: a digest of each ``BAND`` min-hashes."""
    import xxhash

    r = np.random.default_rng(SEED)
    odd, more = (r.integers(0, 1 << 63, (BANDS * BAND, 1), dtype=np.uint64) for _ in range(2))
    low = np.full(BANDS * BAND, np.iinfo(np.uint64).max)
    for k in range(0, len(values), 4096):  # bounds the memory of a very long text
        x = values[k:k + 4096]
        low = np.minimum(low, ((x ^ (x >> np.uint64(31))) * (odd * np.uint64(2) + np.uint64(1)) + more).min(axis=1))
    return [int(np.int64(np.uint64(xxhash.xxh64_intdigest(low[k * BAND:(k + 1) * BAND].tobytes(), k)))) for k in range(BANDS)]


def similar(docs: DataFrame, key: str, text: str, shingle: int, similarity: float) -> DataFrame:
    """``key, _t1, _t2, fp, component`` as ``near_duplicates``, and ``group`` (not shared by groups that share a key), but linked are texts whose sets of shingles have a Jaccard
    similarity of at least ``similarity``. Min-hash bands propose pairs, the sets decide. ``fp`` names the set of shingles.
    """
    import xxhash

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sets = [np.unique(shingle_hashes(t, shingle)) for t in f["_text"]]
            yield pd.DataFrame({key: f[key], "_t1": f["_t1"], "_t2": f["_t2"], "fp": [xxhash.xxh128_hexdigest(s.tobytes()) for s in sets],
                                "n_chars": [len(s) for s in sets], "v": [bands(s) for s in sets]})

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"h": f["h"], "s": [np.unique(shingle_hashes(t, shingle)).view(np.int64) for t in f["_text"]]})

    texts = docs.select(F.col(key), *_text_id(key, text), F.col(text).alias("_text"))
    every = texts.withColumn(key, key_text(key)).mapInPandas(sketch, f"`{key}` string, _t1 bigint, _t2 bigint, fp string, n_chars int, v array<bigint>")
    every = freeze(keyed_back(every, docs, key), "sketches")
    nodes = every.groupBy(F.col("fp").alias("h")).agg(F.first("n_chars").alias("n_chars"), F.first("v").alias("v"), F.min(key).alias("low"),
                                                      F.min(F.struct("_t1", "_t2")).alias("t"))
    nodes = freeze(nodes, "nodes")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = freeze(pairs, "candidates")
        ends = pairs.selectExpr("ah AS h").union(pairs.selectExpr("bh AS h")).distinct().join(nodes, "h").selectExpr("h", "t._t1 AS _e1", "t._t2 AS _e2")
        found = texts.join(ends, (F.col("_t1") == F.col("_e1")) & (F.col("_t2") == F.col("_e2"))).select("h", "_text").dropDuplicates(["h"])
        sets = freeze(found.mapInPandas(whole, "h string, s array<bigint>"), "sets")
        both = (pairs.join(sets.selectExpr("h AS ah", "s AS a"), "ah").join(sets.selectExpr("h AS bh", "s AS b"), "bh")
                .select("ah", "bh", F.size(F.array_intersect("a", "b")).alias("same"), (F.size("a") + F.size("b")).alias("all")))
        return freeze(both.where(F.col("same") >= (F.col("all") - F.col("same")) * similarity - 1e-9).select("ah", "bh"), "alike")

    ids = nodes.select("h", F.xxhash64("h").alias("n"), "n_chars")
    rows = nodes.select(F.xxhash64("h").alias("n"), F.explode("v").alias("v"))
    groups = banded_groups(rows, ids, similarity, verified).withColumnRenamed("node", "h")
    placed = nodes.join(groups, "h", "left").select(F.col("h").alias("fp"), "low", F.coalesce("component", "h").alias("component"))
    lowest = placed.groupBy("component").agg(F.min("low").alias("lowest"))
    names = placed.join(lowest, "component").select("fp", "lowest", F.col("component").alias("group"))
    return every.join(names, "fp").select(every[key], "_t1", "_t2", "fp", F.col("lowest").alias("component"), "group")


def hex16(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame, key: str, text: str = "text", distance: int = DISTANCE,
               shingle: int = SHINGLE, similarity: float | None = None) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the smallest key.

    Without a ``similarity`` groups are those of ``near_duplicates``, with one those of ``similar``.

    Of rows that share this key the text with the smallest hash stays, and of rows that agree in both one. Groups whose
    keys are all NULL keep one row too.
    """
    by = "component" if similarity is None else "group"
    near = near_duplicates(docs, key, text, distance, shingle) if similarity is None else similar(docs, key, text, shingle, similarity)
    first = near.where(F.col(key).eqNullSafe(F.col("component"))).groupBy(by, "fp").agg(F.min(F.struct("_t1", "_t2")).alias("t"))
    first = first.groupBy(by).agg(F.min("t").alias("t")).select(F.col("t._t1").alias("_f1"), F.col("t._t2").alias("_f2"))
    d = docs.select("*", *_text_id(key, text))
    kept = d.join(first, (d["_t1"] == first["_f1"]) & (d["_t2"] == first["_f2"]))
    one = kept.withColumn("_n", F.row_number().over(Window.partitionBy("_t1", "_t2").orderBy("_t1"))).where("_n = 1")
    return one.select(*docs.columns)
