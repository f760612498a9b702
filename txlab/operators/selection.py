"""Exact per-class selection of rows in hash order, without sorting a class.

A class that holds almost every row must not be ranked in one task. Rows are counted
per (class, first digits of their order) - a table of bounded size - which tells in
which prefix the m-th row of a class lies. As long as that prefix holds many rows, only its
rows are counted by further digits; then the few left are ranked to find where to cut. Deciding on which side
of a cut a row lies is a plain comparison: the data itself is neither shuffled nor sorted.

The order is the hash of the key and then a digest of the whole row, so rows that share a key are told apart. Rows
that agree in every column cannot be; where a cut falls among them, so many of them are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import hash_hex
from ..session import SMALL_ROWS, attach_small, freeze, small_rows

STEP_DIGITS = 4  # 65,536 prefixes per class and level
DIGITS = 48  # 32 of the key's hash, 16 of the row's digest


def row_order(df: DataFrame, key: str, seed: int) -> Column:
    """The place of a row in hash order, as text of fixed length."""
    return F.concat(hash_hex(key, seed), F.lpad(F.hex(F.xxhash64(*df.columns)), 16, "0"))


def hash_cuts(df: DataFrame, key: str, label: str, wanted: dict[str, Column], seed: int = 42, balanced: bool = False,
              small: int = SMALL_ROWS) -> DataFrame:
    """One row per class and name with any row selected: ``<label>, name, cut, take, tied``.

    ``wanted`` maps a name to an expression over ``n`` (rows of the class) and, if ``balanced``,
    ``n_min`` and ``n_max`` (smallest and largest class). The first that many rows of the
    class are those before ``cut`` and ``take`` of the ``tied`` rows at it. A count below one
    has no row here (nothing is selected); one of ``n`` or more selects the whole class.
    """
    rows = df.select(F.col(label).alias("_label"), row_order(df, key, seed).alias("_order"))
    counts = rows.groupBy("_label", F.substring("_order", 1, STEP_DIGITS).alias("_prefix")).agg(F.count(F.lit(1)).alias("_c"))
    sizes = counts.groupBy("_label").agg(F.sum("_c").alias("n")).agg(
        F.struct(F.min("n").alias("n_min"), F.max("n").alias("n_max")).alias("s")).scalar()
    running = counts.withColumn("n", F.sum("_c").over(Window.partitionBy("_label")))
    if balanced:
        running = running.withColumn("_s", sizes).select("*", "_s.n_min", "_s.n_max")
    targets = F.array(*[
        F.struct(F.lit(name).alias("name"), F.least(expr.cast("long"), F.col("n")).alias("need"))
        for name, expr in wanted.items()])
    found = _reached(running.select("_label", "_prefix", "_c", F.inline(targets)))
    digits = STEP_DIGITS
    while digits < DIGITS and found.where(F.col("_c") > small).limit(1).count():
        digits += STEP_DIGITS
        inside = attach_small(rows.withColumn("_prefix", F.substring("_order", 1, digits - STEP_DIGITS)), found.drop("_c"), ["_label", "_prefix"], how="inner")
        finer = inside.groupBy("_label", "name", "need", F.substring("_order", 1, digits).alias("_prefix")).agg(F.count(F.lit(1)).alias("_c"))
        found = _reached(finer)
    if digits < DIGITS:
        inside = attach_small(rows.withColumn("_prefix", F.substring("_order", 1, digits)), found.drop("_c"), ["_label", "_prefix"], how="inner")
        found = _reached(inside.groupBy("_label", "name", "need", F.col("_order").alias("_prefix")).agg(F.count(F.lit(1)).alias("_c")))
    return found.select(F.col("_label").alias(label), "name", F.col("_prefix").alias("cut"), F.col("need").alias("take"), F.col("_c").alias("tied"))


def _reached(counts: DataFrame) -> DataFrame:
    """Of counts ``_label, name, need, _prefix, _c`` the prefix in which the ``need``-th row lies, and what is needed of it."""
    upto = Window.partitionBy("_label", "name").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    at = counts.withColumn("_cum", F.sum("_c").over(upto)).where((F.col("need") > F.col("_cum") - F.col("_c")) & (F.col("need") <= F.col("_cum")))
    at = at.select("_label", "name", "_prefix", "_c", (F.col("need") - F.col("_cum") + F.col("_c")).alias("need"))
    held = small_rows(at)  # a row per class and name
    return freeze(at, "cuts") if held is None else at.sparkSession.createDataFrame(held, at.schema)


def with_cuts(df: DataFrame, key: str, label: str, wanted: dict[str, Column], seed: int = 42,
              balanced: bool = False, small: int = SMALL_ROWS) -> DataFrame:
    """``df`` with a boolean column per wanted name: is the row among the first that many of its class?"""
    cuts = hash_cuts(df, key, label, wanted, seed, balanced, small)
    part = [F.max(F.when(F.col("name") == name, F.struct("cut", "take", "tied"))).alias(f"_at_{name}") for name in wanted]
    marked = attach_small(df.withColumn("_h", row_order(df, key, seed)), cuts.groupBy(label).agg(*part), [label])
    split = F.lit(False)  # rows among equals of which only some are taken
    for name in wanted:
        at = F.col(f"_at_{name}")
        split = split | ((F.col("_h") == at["cut"]) & (at["take"] < at["tied"]))
    columns = [c for c in df.columns]

    def flags(number: Column | None) -> list[Column]:
        out = []
        for name in wanted:
            at = F.col(f"_at_{name}")
            whole = at["take"] >= at["tied"] if number is None else number <= at["take"]
            out.append(F.coalesce((F.col("_h") < at["cut"]) | ((F.col("_h") == at["cut"]) & whole), F.lit(False)).alias(name))
        return out

    if not cuts.where("take < tied").limit(1).count():
        return marked.select(*columns, *flags(None))
    # Equal rows are numbered by the partition they are in; which of them gets which number makes no difference.
    equals = freeze(marked.where(F.coalesce(split, F.lit(False))).withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id()}), "equals")
    sizes = equals.groupBy("_h", "_p").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy("_h").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_h", "_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_h", "_p").orderBy("_i"))
    numbered = equals.withColumn("_local", local).join(offsets, ["_h", "_p"]).select("*", (F.col("_local") + F.col("_before")).alias("_number"))
    return (marked.where(~F.coalesce(split, F.lit(False))).select(*columns, *flags(None))
            .union(numbered.select(*columns, *flags(F.col("_number")))))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))

