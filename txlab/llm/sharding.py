"""Shards of nearly equal size: cuts of an ordered row of atomic groups, with the smallest possible largest shard."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import freeze

#: Bytes that a row adds to its text.
ROW_BYTES = 16
#: Groups are ordered by a hash and split by so many of its first hex digits, into 16^PREFIX parts.
PREFIX = 3
#: Places at which the row of groups may be cut that the driver asks for at a time, for all parts together.
PLACES = 20_000
#: Groups above this part of a fair share are known from the start; there are at most LARGE * shards of them.
LARGE = 64


class Row:
    """An ordered row of groups of which only some ends are known, as bytes up to and including a group.

    Between two known ends there may be others (``open_``). ``largest`` is the size of the largest group.
    """

    def __init__(self, ends: list[int], open_: list[bool], largest: int):
        self.ends, self.open, self.largest = ends, open_, largest

    def jump(self, start: int, capacity: int, hopeful: bool) -> int:
        """How far a shard from ``start`` reaches; hopeful: as if every byte between unknown ends were an end."""
        k = bisect_right(self.ends, start + capacity)
        known = self.ends[k - 1] if k else 0
        return start + capacity if hopeful and k < len(self.ends) and self.open[k] else max(start, known)

    def fits(self, capacity: int, shards: int, hopeful: bool) -> bool:
        at, total = 0, self.ends[-1] if self.ends else 0
        for _ in range(shards):
            if at >= total:
                return True
            to = self.jump(at, capacity, hopeful)
            if to <= at:
                return False
            at = to
        return at >= total

    def capacity(self, shards: int, hopeful: bool) -> int:
        """The smallest feasible capacity, by binary search with a greedy check."""
        total = self.ends[-1] if self.ends else 0
        low, high = max(self.largest, -(-total // shards)), max(total, 1)
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if self.fits(mid, shards, hopeful) else (mid + 1, high)
        return low

    def windows(self, low: int, high: int, shards: int) -> set[int]:
        """Which unknown stretches the ends of shards may lie in, whatever the capacity from low to high."""
        near, far, hit = 0, 0, set()
        for _ in range(shards):
            # From the earliest place with the least capacity to the latest with the most.
            first = bisect_right(self.ends, near + low)
            near = min(self.jump(near, low, False), self.ends[-1])
            far = min(self.jump(far, high, True), self.ends[-1])
            last = min(bisect_right(self.ends, far), len(self.ends) - 1)
            hit.update(k for k in range(min(first, last), last + 1) if self.open[k])
            if near >= self.ends[-1]:
                break
        return hit


def find_cuts(row: Row, shards: int, refine: Callable[[Row, set[int]], Row]) -> tuple[int, list[int]]:
    """The smallest feasible capacity over all groups, and where to cut.

    ``refine`` returns the row with more ends known within given stretches. The capacity found with the known ends is
    enough, and the one found if all bytes were ends is needed; stretches are refined until the two agree.
    """
    if not row.ends:
        return 0, []
    while True:
        low, high = row.capacity(shards, True), row.capacity(shards, False)
        open_ = row.windows(low, high, shards)
        if not open_ or low == high and row.fits(high, shards, False):
            break
        finer = refine(row, open_)
        if len(finer.ends) <= len(row.ends):
            raise RuntimeError(f"{len(open_)} stretches with unknown ends were not refined")
        row = finer
    return high, even_cuts(row.ends, high, shards)


def even_cuts(ends: list[int], capacity: int, shards: int) -> list[int]:
    """Ends of the shards, none above ``capacity``. Where the capacity leaves a choice (one group may be far larger than
    a fair share), a shard ends as near as possible to its fair share of what is left."""
    total, last = ends[-1], [0] * (shards + 1)
    # From where the rest still fits into so many shards.
    for k in range(1, shards + 1):
        to = total if k == 1 else last[k - 1]
        need = to - capacity
        i = bisect_right(ends, need - 1)  # first end that is not below
        last[k] = 0 if need <= 0 else ends[min(i, len(ends) - 1)]
    cuts, at = [], 0
    for k in range(shards, 0, -1):
        fair = at + (total - at) / k
        i = bisect_right(ends, fair)
        options = [ends[j] for j in (i - 1, i) if 0 <= j < len(ends)]
        best = min(options, key=lambda e: abs(e - fair), default=at)
        least = at if k == 1 else max(at, last[k - 1])
        most = ends[max(0, bisect_right(ends, at + capacity) - 1)] if bisect_right(ends, at + capacity) else at
        at = total if k == 1 else min(max(best, least), max(most, at))
        cuts.append(at)
    return cuts


def shard(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, size, text_crc32, shard, slot`` for every row of ``docs``.

    ``size``: UTF-8 bytes of the text and ``ROW_BYTES``. Rows with equal texts are one group and stay together (NULL
    counts as empty). Groups are ordered by a hash of the text; shards are contiguous in this order, and no other cut
    of it has a smaller largest shard. ``slot`` numbers a shard's rows from 0 without gaps. An empty table gives no
    rows; with fewer groups than shards some shards are empty.

    The driver first learns the ends of 16^``PREFIX`` parts and of the groups above a ``LARGE``-th of a fair share, then asks
    for some ``PLACES`` ends at a time, only within stretches where a cut may fall. A stretch is cut by the number of its
    groups, into two pieces at least, so every round brings new ends, however unequal the groups. No group is gathered: its size is a combining sum, and slots are
    counted by hash of the key within a shard, so that a text with a third of all rows is split.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    light = freeze(docs.select(F.col(key).alias("_key"), (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
                               F.sha2(body.cast("binary"), 256).alias("_h")), "sizes")
    part = F.conv(F.substring("_h", 1, PREFIX), 16, 10).cast("int")
    groups = light.groupBy("_h").agg(F.sum("size").alias("bytes")).withColumn("part", part)
    order = Window.partitionBy("part").orderBy("_h").rowsBetween(Window.unboundedPreceding, 0)
    groups = freeze(groups.withColumn("end", F.sum("bytes").over(order)).withColumn("i", F.count(F.lit(1)).over(order)), "groups")
    parts = groups.groupBy("part").agg(F.max("end").alias("bytes"), F.count(F.lit(1)).alias("n"), F.max("bytes").alias("largest")).orderBy("part").collect()  # 16^PREFIX at most
    # Bytes and groups ahead of each part, and the number of the group at each known end.
    before, ahead = np.zeros(16 ** PREFIX, "int64"), np.zeros(16 ** PREFIX, "int64")
    number: dict[int, int] = {}
    total = count = 0
    for r in parts:
        before[r.part], ahead[r.part] = total, count
        total, count = total + r.bytes, count + r.n
        number[total] = count
    offsets = [(int(before[r.part]), r.part) for r in parts]
    starts = [b for b, _ in offsets]
    for r in groups.where(F.col("bytes") > total // (LARGE * shards)).collect():  # LARGE * shards at most
        at, i = int(before[r.part]) + r.end, int(ahead[r.part]) + r.i
        number[at] = i
        if i > 1:
            number[at - r.bytes] = i - 1

    def known() -> Row:
        ends = sorted(number)
        return Row(ends, [number[e] - number.get(b, 0) > 1 for b, e in zip([0] + ends, ends)], max((r.largest for r in parts), default=0))

    def refine(row: Row, stretches: set[int]) -> Row:
        each = max(2, PLACES // len(stretches))
        order = sorted(stretches)
        lows, highs = np.array([row.ends[k - 1] if k else 0 for k in order]), np.array([row.ends[k] for k in order])
        first = np.array([number.get(int(b), 0) for b in lows])
        step = np.array([-(-(number[int(e)] - n) // each) for e, n in zip(highs, first)])

        @F.pandas_udf("long")
        def piece(part: pd.Series, end: pd.Series, i: pd.Series) -> pd.Series:
            p = part.to_numpy()
            at, nth = before[p] + end.to_numpy(), ahead[p] + i.to_numpy()
            k = np.minimum(np.searchsorted(highs, at), len(highs) - 1)
            inside = (at > lows[k]) & (at <= highs[k])
            return pd.Series(np.where(inside, (k << 32) | (nth - first[k] - 1) // step[k], -1))

        # A stretch lies within one part; PLACES pieces, or two for each stretch.
        found = (groups.select("part", "end", "i", piece("part", "end", "i").alias("piece")).where("piece >= 0")
                 .groupBy("part", "piece").agg(F.max("end").alias("end"), F.max("i").alias("i")).collect())
        for r in found:
            number[int(before[r.part]) + r.end] = int(ahead[r.part]) + r.i
        return known()

    row = known()
    _, cuts = find_cuts(row, shards, refine)

    # A cut as the hash of the last group before it: a row's shard follows from its own hash.
    last = []
    for c in cuts:
        k = bisect_right(starts, c - 1) - 1 if c else -1
        last.append((c, offsets[k][1], c - offsets[k][0]) if k >= 0 else (c, -1, -1))
    spots = groups.sparkSession.createDataFrame(sorted(set(last)), "cut long, part int, end long")
    named = {r.cut: r._h for r in groups.join(F.broadcast(spots), ["part", "end"]).select("cut", "_h").collect()}  # one per shard
    bounds = np.array([named.get(c, "") for c in cuts], dtype="U64")

    @F.pandas_udf("int")
    def shard_of(h: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, h.to_numpy(dtype="U64"), side="left").astype("int32"))

    placed = light.withColumn("shard", shard_of("_h")).withColumn("_p", F.pmod(F.xxhash64(F.col("_key"), F.col("_h")), F.lit(256)).cast("int"))
    placed = freeze(placed, "placed")
    counts = placed.groupBy("shard", "_p").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_first", F.sum("_n").over(Window.partitionBy("shard").orderBy("_p")) - F.col("_n")).drop("_n")
    number = F.row_number().over(Window.partitionBy("shard", "_p").orderBy("_key", "_h")) - 1
    return (placed.withColumn("_i", number).join(counts, ["shard", "_p"])
            .select(F.col("_key").alias(key), "size", "text_crc32", "shard", (F.col("_first") + F.col("_i")).cast("long").alias("slot")))
