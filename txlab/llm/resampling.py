"""Importance resampling towards a target corpus: array-scored weights, and a cut found by bisection with exact counts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import freeze

BUCKETS = 10_000
#: Gains are whole thousandths of a natural logarithm.
UNIT = 1000
SEED = 2024
#: Documents with fewer words are never drawn; of the others this share is.
LEAST_WORDS = 20
PERCENT = 10
#: Thresholds that one count job tries: four halvings of the interval at a time.
PROBES = 15
#: Words whose buckets a Python worker remembers. It forgets all when full, which costs time and changes nothing.
REMEMBERED = 1_000_000

#: A-Z lowered, digits, a-z and all bytes beyond ASCII kept, everything else a gap.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class _Buckets(dict):
    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        b = self[feature] = zlib.crc32(feature) % BUCKETS
        return b


_buckets = _Buckets()


def feature_buckets(text: str | None, longest: int = 1) -> np.ndarray:
    """The bucket of every feature of a whole text, repeats included; NULL has none.

    Features are runs of 1 to ``longest`` words, joined by one space; words are runs of letters, digits and
    characters beyond ASCII, with A-Z lowered.
    """
    words = text.encode().translate(_WORD_BYTES).split(b" ") if text else []
    words = [w for w in words if w]
    runs = words if longest == 1 else [b" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return np.fromiter(map(_buckets.__getitem__, runs), np.int32, len(runs))


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = 1) -> np.ndarray:
    """Features per bucket over all rows: tasks add up arrays of fixed size, their sums meet per bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for t in b.column(0):
                total += np.bincount(feature_buckets(t.as_py(), longest), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    found = texts.select(text).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # one row a bucket at most
    out = np.zeros(BUCKETS, np.int64)
    for r in found:
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature in each bucket adds to a document's weight: the smoothed log ratio of the two corpora, floored."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    return np.floor(UNIT * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", longest: int = 1) -> DataFrame:
    """``key, n_features, weight`` of every document: its buckets look up one array of fixed size, and nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        for b in batches:
            found = [feature_buckets(t.as_py(), longest) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) for x in found], pa.int64()), pa.array([int(g[x].sum()) for x in found], pa.int64())],
                [key, "n_features", "weight"])

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, n_features long, weight long")


def gumbel(key: Column, seed: int = SEED) -> Column:
    """Floored Gumbel noise from the key alone; a NULL key counts as empty text."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-float(UNIT)) * F.log(-F.log(u))).cast("long")


def _least(rows: DataFrame, column: str, wanted: int) -> tuple[int, int]:
    """The smallest value v of an integer column with at least ``wanted`` rows at or below it, and the rows below v.

    Every job counts the rows at or below ``PROBES`` thresholds exactly, which is several halvings at once; the jobs read one column of a
    written table. At most 16 of them narrow a 64-bit range to one value.
    """
    low, high = rows.agg(F.min(column), F.max(column)).first()
    low, below = low - 1, 0  # rows at or below ``low``: ``below``, which is less than wanted
    while high - low > 1:
        step = max(1, -(-(high - low) // (PROBES + 1)))
        at = [x for x in range(low + step, high, step)]
        counts = rows.agg(*[F.count_if(F.col(column) <= F.lit(x).cast("long")).alias(f"c{i}") for i, x in enumerate(at)]).first()
        for x, n in zip(at, counts):
            if n >= wanted:
                high = x
                break
            low, below = x, n
    return high, below


def draw(scored: DataFrame, key: str, least: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``scored`` (a written table with integers ``n_features``, ``score``, ``key`` and unique ``_row``) with ``rank``: 1, 2, 3 ... for the rows drawn, NULL for others.

    Of the rows with ``least`` features or more the share ``percent`` with the highest scores is drawn; ties go to the smaller
    key, NULL keys last, and of rows that agree in both any come first, as they have equal places. The cut is
    found by counting: the score first, then the key among rows tied at that score, then the row among those tied in both.
    Selected rows are sorted by range partitions, whose sizes give each its first rank.
    """
    rows = scored.withColumn("_down", -F.col("score")).withColumn("_k", F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1)))
    pool = F.col("n_features") >= least
    wanted = rows.where(pool).count() * percent // 100
    order = ["_down", "_k", "_row"]
    inside = F.lit(False)
    if wanted:
        tied, left, inside, equal = rows.where(pool), wanted, F.lit(False), pool
        for c in order:
            cut, below = _least(tied, c, left)
            inside = inside | (equal & (F.col(c) < F.lit(cut).cast("long")))
            equal = equal & (F.col(c) == F.lit(cut).cast("long"))
            tied, left = rows.where(equal), left - below
        inside = inside | equal
    chosen = rows.where(inside).repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    chosen = freeze(chosen, "chosen")
    sizes = chosen.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row a partition
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", before.alias("_before"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    ranked = chosen.withColumn("_local", local).join(starts, "_part").withColumn("rank", (F.col("_before") + F.col("_local")).cast("long"))
    rest = rows.where(~inside).withColumn("rank", F.lit(None).cast("long"))
    columns = [c for c in scored.columns if c != "_row"] + ["rank"]
    return ranked.select(*columns).union(rest.select(*columns))


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", longest: int = 1,
             least: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """``key, n_features, weight, score, rank`` (all long but the key) for every row of ``docs``.

    Weights compare hashed bags of features of all documents with those of all ``target`` texts; Gumbel noise from the key turns the
    highest scores into a draw in proportion to them. Both corpora are counted whole. NULL and empty texts have no
    features, weight 0, and are never drawn; NULL keys share one noise and lose ties; repeated rows are rows of
    their own; very long texts are worked through in one task at a few bytes a word. Without documents there are no rows; without
    target texts all gains are smoothed ones. Other columns are ignored. Keys are integers.
    """
    gain = gains(bucket_counts(docs, text, longest), bucket_counts(target, text, longest))
    scored = (weigh(docs, gain, key, text, longest).withColumn("score", F.col("weight") + gumbel(F.col(key), seed))
              .withColumn("_row", F.monotonically_increasing_id()))
    return draw(freeze(scored, "scored"), key, least, percent)
