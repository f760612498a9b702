"""Reading and writing tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.validate import FEATURES, LABEL, MALFORMED, REQUIRED, malformed_counts


def transaction_schema(with_label: bool = True) -> T.StructType:
    """Schema of a raw transaction file. Given explicitly, no pass is spent on inferring it."""
    fields = [T.StructField(c, T.DoubleType()) for c in ["Time", *FEATURES, "Amount"]]
    if with_label:
        fields.append(T.StructField(LABEL, T.IntegerType()))
    return T.StructType(fields)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which reads the file twice."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def read_checked_csv(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False, stream: bool = False) -> DataFrame:
    """CSV with a header in the given types, and ``malformed``: the columns whose cell has text that is not of its type.

    A plain reader turns such a cell into NULL, as if nothing had been there. Here cells are read as text and
    cast one by one, so an empty cell is missing and a wrong one is named; a row with too few or too many cells
    has ``*`` among its names. Every column is looked at, whichever are selected later. ``strict`` raises if any
    cell is wrong (which reads the file once); ``stream`` reads new files as they come.
    """
    broken = "_broken"
    text = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema], T.StructField(broken, T.StringType())])
    reader = (spark.readStream if stream else spark.read).option("header", True).option("columnNameOfCorruptRecord", broken)
    raw = reader.schema(text).csv(path)
    typed = {f.name: F.col(f"`{f.name}`") if isinstance(f.dataType, T.StringType) else F.trim(F.col(f"`{f.name}`")).try_cast(f.dataType) for f in schema}
    wrong = [F.when(F.length(F.trim(F.col(f"`{c}`"))).cast("boolean") & v.isNull(), F.lit(c)) for c, v in typed.items()]
    names = F.array_compact(F.array(*wrong, F.when(F.col(broken).isNotNull(), F.lit("*"))))
    checked = raw.select(*[v.alias(c) for c, v in typed.items()], names.alias(MALFORMED))
    if strict:
        if stream:
            raise ValueError("a stream cannot be read ahead: use the rule well_formed")
        found = {r["column"]: r["malformed"] for r in malformed_counts(checked, [f.name for f in schema]).where("malformed > 0").collect()}
        if found:
            raise ValueError(f"malformed cells: {found}")
    return checked


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_any(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV or Parquet by the suffix of ``path``; any other suffix is an error."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix == ".csv":
        return read_csv(spark, path, schema)
    if suffix == ".parquet":
        return read_parquet(spark, path)
    raise ValueError(f"unsupported file format {suffix!r}: use .csv or .parquet")


def write_parquet(df: DataFrame, path: str, partition_by: list[str] = (), force: bool = True) -> str:
    """Write Parquet. Without ``force`` an existing table is left as it is."""
    df.write.mode("overwrite" if force else "ignore").partitionBy(*partition_by).parquet(path)
    return path


def write_if_absent(df: DataFrame, path: str, force: bool = False) -> DataFrame:
    """Write unless the table is there (or ``force``), and read what is there."""
    write_parquet(df, path, force=force)
    return df.sparkSession.read.parquet(path)


def write_splits(df: DataFrame, path: str, force: bool = True) -> DataFrame:
    """One data set partitioned by ``split``: reading one split touches only its files."""
    write_parquet(df, path, ["split"], force)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str, single: bool = False) -> str:
    """CSV with a header; ``single`` for small reports that should be one file."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)
    return path


def csv_to_parquet(spark: SparkSession, source: str, target: str, schema: T.StructType | None = None,
                   force: bool = False) -> DataFrame:
    return write_if_absent(read_csv(spark, source, schema), target, force)


def empty_template(spark: SparkSession) -> DataFrame:
    """No rows, the columns a scoring file must have."""
    return spark.createDataFrame([], T.StructType([T.StructField(c, T.DoubleType()) for c in REQUIRED]))
