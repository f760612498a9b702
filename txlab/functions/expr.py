"""Small expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

FRACTIONAL = (T.DoubleType, T.FloatType)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN where the type has one: both mean "no value"."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, FRACTIONAL):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into NULL, so that aggregates skip both."""
    if isinstance(df.schema[name].dataType, FRACTIONAL):
        return F.nanvl(F.col(name), F.lit(None).cast("double"))
    return F.col(name)


def ratio(top: Column, bottom: Column, otherwise: float | None = 0.0) -> Column:
    """``top / bottom`` as double; ``otherwise`` where the denominator is zero."""
    value = F.try_divide(top.cast("double"), bottom.cast("double"))
    return value if otherwise is None else F.coalesce(value, F.lit(float(otherwise)))


def rounded(col: Column, digits: int = 6) -> Column:
    return F.round(col.cast("double"), digits)


def hash_hex(key: Column | str, *salt) -> Column:
    """md5 of ``key:salt...`` in hex: the same order on every cluster and partitioning."""
    key = F.col(key) if isinstance(key, str) else key
    parts = [key.cast("string")]
    for s in salt:
        parts.append(s.cast("string") if isinstance(s, Column) else F.lit(str(s)))
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def uniform(hex_digest: Column, block: int = 0) -> Column:
    """A uniform number in [0,1) from eight hex digits (block 0..3) of a digest."""
    digits = F.substring(hex_digest, 1 + 8 * block, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def normal(hex_digest: Column, which: int = 0) -> Column:
    """One of four standard normal numbers in a digest (Box-Muller on its two pairs of blocks)."""
    pair, part = divmod(which, 2)
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(hex_digest, 2 * pair)))
    angle = F.lit(6.283185307179586) * uniform(hex_digest, 2 * pair + 1)
    return radius * (F.sin(angle) if part else F.cos(angle))


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
