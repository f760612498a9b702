"""Words of a text, as all operators of this subpackage count them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: What separates words: space and the controls 9 to 13.
GAPS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]"


def words(text: Column) -> Column:
    """The words of a text in order; none for NULL."""
    bare = F.coalesce(text, F.lit(""))
    for gap in GAPS[1:]:
        bare = F.replace(bare, F.lit(gap), F.lit(" "))
    return F.array_remove(F.split(bare, " "), "")


def key_text(key: str) -> Column:
    """A key as text: pandas would turn whole numbers beside a NULL into floats, which changes large ones."""
    return F.col(key).cast("string").alias(key)


def keyed_back(out: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``out`` with its key in the type that it has in ``source``."""
    return out.withColumn(key, F.col(key).cast(source.schema[key].dataType))
