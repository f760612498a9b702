"""Mixing sources to target weights along a curriculum whose weights change with time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import freeze
from .text import words

#: Weights of the sources in order, repeating; the most often a source may be read; hash prefixes a source is split by.
WEIGHTS = (1, 2, 3)
MOST = 3
PREFIX = 3
#: How far a source's share drifts over the run: it starts at (1 - DRIFT) of its mean and ends at (1 + DRIFT), or the reverse.
DRIFT = 0.5


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``totals`` (``source, source_size``) with ``rank`` (from 0), ``weight`` and ``target``.

    Sources rank by code point, NULL last. Together the targets are all of the sizes; none is above ``most`` times its
    source, and what that cuts off is shared again by weight until none is above. The rank comes from counts per first
    code units and a window within them, so that no single task needs to hold all sources.
    """
    head = F.when(F.col("source").isNull(), F.lit("~")).otherwise(F.concat(F.lit("="), F.hex(F.substring("source", 1, 4))))
    t = freeze(totals.withColumn("_head", head), "sources")
    heads = t.groupBy("_head").agg(F.count(F.lit(1)).alias("_n"))
    heads = heads.withColumn("_before", F.sum("_n").over(Window.orderBy("_head")) - F.col("_n"))
    inside = F.row_number().over(Window.partitionBy("_head").orderBy("source")) - 1
    t = t.join(heads, "_head").withColumn("rank", (F.col("_before") + inside).cast("long"))
    t = t.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
    t = freeze(t.select("source", "source_size", "rank", "weight"), "sources")

    limit = F.col("source_size") * most
    total = t.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    left, share, open_ = total, None, None
    while True:
        # Sources at their limit stay there: the shares of the others only grow.
        full = F.lit(False) if share is None else F.col("weight") * F.lit(float(left)) / F.lit(float(share)) >= limit
        s = t.agg(F.sum(F.when(~full, F.col("weight"))), F.count(F.when(~full, 1)), F.sum(F.when(full, limit))).first()
        if (s[1] or 0) == open_ or not s[0]:
            break
        share, open_, left = s[0], s[1], total - (s[2] or 0)
    if share is None:
        return t.withColumn("target", F.lit(0.0))
    wanted = F.lit(float(left)) * F.col("weight") / F.lit(float(share))
    return t.withColumn("target", F.when(wanted >= limit, limit.cast("double")).otherwise(wanted))


def position(offset: Column, target: Column, slope: Column) -> Column:
    """When a source's cumulative demand reaches ``offset``: from 0 (start of the run) to 1.

    The source's weight at time t is ``target * (1 + slope * (2t - 1))``; its integral ``target * (t + slope * (t^2 - t))``
    is set equal to the offset and solved for t.
    """
    share = F.least(F.greatest(offset / target, F.lit(0.0)), F.lit(1.0))
    b = F.lit(1.0) - slope
    return F.when(slope == 0, share).otherwise((F.sqrt(b * b + F.lit(4.0) * slope * share) - b) / (F.lit(2.0) * slope))


def plan(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
         weights: tuple[int, ...] = WEIGHTS, most: int = MOST, drift: float = DRIFT) -> DataFrame:
    """One row per document: ``key, size, source, source_size, target, copies, offset`` and ``slope``.

    ``size``: words of the text (NULL: 0). A source is read in the order of a hash of the key, from its start again
    when it is used up, until its target is met: every document ``floor(target / source_size)`` times, and once more if
    the middle of the document lies within the remainder. ``offset``: words of the source before the document, from
    sums per hash prefix and a window within each prefix, so that a source with a third of all rows is split. Rows with
    equal keys are told apart by size and text. A source without words has target 0 and is not read.
    """
    light = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), F.size(words(F.col(text))).cast("long").alias("size"),
                        F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")).alias("_h"),
                        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("_c"))
    light = freeze(light.withColumn("_p", F.substring("_h", 1, PREFIX)), "sizes")
    by_source = targets(light.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    parts = light.groupBy("source", "_p").agg(F.sum("size").alias("_part"))
    parts = parts.withColumn("_first", F.sum("_part").over(Window.partitionBy("source").orderBy("_p")) - F.col("_part"))
    order = Window.partitionBy("source", "_p").orderBy("_h", "key", "size", "_c").rowsBetween(Window.unboundedPreceding, -1)
    placed = light.withColumn("_in", F.coalesce(F.sum("size").over(order), F.lit(0)))
    l, p, t = placed.alias("l"), parts.alias("p"), by_source.alias("t")
    every = (l.join(p, F.col("l.source").eqNullSafe(F.col("p.source")) & (F.col("l._p") == F.col("p._p")))
             .join(t, F.col("l.source").eqNullSafe(F.col("t.source")))
             .select("l.key", "l.size", "l.source", "t.source_size", "t.target", "t.rank", "l._h", "l._c",
                     (F.col("_first") + F.col("_in")).alias("offset")))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("_rounds") * F.col("source_size")
    more = (F.col("source_size") > 0) & (F.col("_rounds") < most) & (F.col("offset") * 2 + F.col("size") < rest * 2)
    return (every.withColumn("_rounds", rounds)
            .withColumn("copies", (F.col("_rounds") + F.when(more, 1).otherwise(0)).cast("int"))
            .withColumn("slope", F.when(F.col("rank") % 2 == 0, drift).otherwise(-drift))
            .select(F.col("key").alias(key), "size", "source", "source_size", "target", "copies", "offset", "slope", "_h", "_c"))


def first_position(p: DataFrame) -> Column:
    """Where in training a document of ``plan`` first appears; NULL if it is not taken."""
    middle = F.col("offset") + F.col("size") / F.lit(2.0)
    return F.when(F.col("copies") > 0, position(middle, F.col("target"), F.col("slope")))


def ranked(p: DataFrame, key: str = "doc_id") -> DataFrame:
    """``p`` (a plan) with ``position`` (``first_position``) and ``rank``: the place (from 0) of a document among those taken.

    A range sort by position; the sizes of the ranges give each its first rank. What is not taken has neither.
    """
    order = [F.col("position").asc_nulls_last(), key, "size", "_h", "_c"]
    s = p.withColumn("position", first_position(p)).repartitionByRange(*order).sortWithinPartitions(*order)
    s = freeze(s.withColumn("_id", F.monotonically_increasing_id()), "ranked")
    s = s.withColumn("_range", F.shiftright("_id", 33))
    ranges = s.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    ranges = ranges.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    place = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return s.join(F.broadcast(ranges), "_range").withColumn("rank", F.when(F.col("position").isNotNull(), place)).drop("_id", "_range", "_before")


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """``docs`` as the run reads them: every copy of a document is a row, sorted by its ``position`` in training.

    The plan is joined to the documents by key, size and text checksum; rows that agree in all of these are the same
    document, and the plan counts them together. Documents that are not taken are left out; columns named ``copy`` and
    ``position`` are replaced.
    """
    p = plan(docs, key, source, text, **options)
    # Rows alike in all three are interchangeable: their places are listed once, and dealt out by number.
    p = p.withColumn("_n", F.row_number().over(Window.partitionBy(key, "size", "_c").orderBy("offset"))).where("copies > 0")
    p = p.select(F.col(key).alias("_mix_key"), F.col("size").alias("_mix_size"), F.col("_c").alias("_mix_crc"), F.col("_n").alias("_mix_n"),
                 F.col("source_size").alias("_mix_all"), F.col("target").alias("_mix_target"), F.col("offset").alias("_mix_offset"),
                 F.col("slope").alias("_mix_slope"), F.col("copies").alias("_mix_copies"))
    columns = [c for c in docs.columns if c not in ("copy", "position")]
    d = docs.select(*columns, F.size(words(F.col(text))).cast("long").alias("_own_size"), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("_own_crc"))
    d = d.withColumn("_own_n", F.row_number().over(Window.partitionBy(key, "_own_size", "_own_crc").orderBy("_own_size")))
    on = (d[key].eqNullSafe(F.col("_mix_key")) & (F.col("_own_size") == F.col("_mix_size")) & (F.col("_own_crc") == F.col("_mix_crc")) & (F.col("_own_n") == F.col("_mix_n")))
    taken = d.join(p, on).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_mix_copies") - 1)))
    middle = F.col("_mix_offset") + F.col("_mix_size") / F.lit(2.0) + F.col("copy") * F.col("_mix_all")
    return (taken.withColumn("position", position(middle, F.col("_mix_target"), F.col("_mix_slope")))
            .select(*columns, "copy", "position").orderBy("position", key, "copy"))
