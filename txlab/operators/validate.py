"""Schema, type, missing-value and range checks, and quarantine of bad rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import is_missing, numeric_columns

# The columns a raw transaction must have.
FEATURES = [f"V{i}" for i in range(1, 29)]
REQUIRED = ["Time", "Amount", *FEATURES]
LABEL = "Class"
MALFORMED = "malformed"  # names of a row's columns whose cell could not be read; "*" for a row of the wrong length


def schema_check(df: DataFrame, required: list[str], label: str | None = None) -> DataFrame:
    """Rows ``(check, column, ok)``: presence and type per required column, and extra columns.

    Only the schema is looked at, so no data is read.
    """
    fields = {f.name: f.dataType for f in df.schema}
    rows = [("present", c, c in fields) for c in required]
    rows += [("numeric", c, isinstance(fields[c], T.NumericType)) for c in required if c in fields and c != label]
    if label is not None:
        rows.append(("integer_label", label, isinstance(fields.get(label), (T.IntegerType, T.LongType))))
    wanted = {*required, label}
    rows += [("expected", c, False) for c in df.columns if c not in wanted]
    return df.sparkSession.createDataFrame(rows, "check string, column string, ok boolean")


def require(df: DataFrame, required: list[str], label: str | None = None) -> DataFrame:
    """``df`` itself, or ValueError naming the missing or wrongly typed columns."""
    fields = {f.name: f.dataType for f in df.schema}
    wanted = [*required, *([label] if label else [])]
    missing = [c for c in wanted if c not in fields]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    wrong = [c for c in required if not isinstance(fields[c], T.NumericType)]
    if label and not isinstance(fields[label], (T.IntegerType, T.LongType)):
        wrong.append(label)
    if wrong:
        raise ValueError(f"columns of the wrong type: {wrong}")
    return df


def project_required(df: DataFrame, key: str, required: list[str]) -> DataFrame:
    """Only the key and the required columns; extra columns are dropped."""
    return require(df, required).select(key, *required)


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows ``(column, missing)`` from one aggregate over all columns."""
    columns = columns or df.columns
    row = df.agg(*[F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(columns)])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("missing"))
                      for i, c in enumerate(columns)])
    return row.select(F.inline(cells))


def non_negative(*columns: str) -> dict[str, Column]:
    """The range rules on amount and time; a missing value breaks a rule too."""
    return {f"{c}_non_negative": F.coalesce(F.col(c) >= 0, F.lit(False)) for c in columns}


def well_formed() -> dict[str, Column]:
    """The rule that no cell of the row was malformed when it was read."""
    return {"well_formed": F.size(MALFORMED) == 0}


def malformed_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows ``(column, malformed)`` for tables read with checks, and for rows of the wrong length (``*``)."""
    names = [*columns, "*"]
    row = df.agg(*[F.count_if(F.array_contains(MALFORMED, c)).alias(f"n{i}") for i, c in enumerate(names)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("malformed")) for i, c in enumerate(names)])))


def failed_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``df`` with ``failed``: the names of the rules the row breaks."""
    names = F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()])
    return df.withColumn("failed", F.array_compact(names))


def range_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows ``(rule, violations)``."""
    row = df.agg(*[F.count_if(~ok).alias(name) for name, ok in rules.items()])
    cells = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules])
    return row.select(F.inline(cells))


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)``; rejected rows keep the list of broken rules."""
    marked = failed_rules(df, rules)
    return marked.where(F.size("failed") == 0).drop("failed"), marked.where(F.size("failed") > 0)


def reject_all_on_violation(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Strict batch form: ``df`` itself, or ValueError if any row breaks any rule."""
    broken = [r["rule"] for r in range_violations(df, rules).where("violations > 0").collect()]
    if broken:
        raise ValueError(f"input breaks the rules {sorted(broken)}")
    return df


def validation_report(df: DataFrame, required: list[str], label: str) -> DataFrame:
    """Rows ``(metric, name, value)`` for the whole data set, from one scan.

    A table read with checks also gets its malformed cells, per column and as rows that have any; its ``malformed`` is not one of its columns.
    """
    present_columns = [c for c in required if c in df.columns]
    checked = [c for c in df.columns if c != MALFORMED] if MALFORMED in df.columns else []
    numeric = set(numeric_columns(df))
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(label) == 0).alias("class_0"),
        F.count_if(F.col(label) == 1).alias("class_1"),
        *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(present_columns)],
        *[F.count_if(F.array_contains(MALFORMED, c)).alias(f"w{i}") for i, c in enumerate([*checked, "*"] if checked else [])],
        *([F.count_if(F.size(MALFORMED) > 0).alias("wrong")] if checked else []))
    n = F.col("rows").cast("double")
    total_missing = sum((F.col(f"m{i}") for i in range(len(present_columns))), F.lit(0).cast("long"))

    def line(metric, name, value):
        return F.struct(F.lit(metric).alias("metric"), F.lit(name).alias("name"), value.cast("double").alias("value"))

    lines = [
        line("rows", "", n),
        line("columns", "", F.lit(len(checked or df.columns))),
        line("class_count", "0", F.col("class_0")),
        line("class_count", "1", F.col("class_1")),
        line("positive_rate", "", F.coalesce(F.try_divide(F.col("class_1").cast("double"), n), F.lit(0.0))),
        line("missing_columns", "", F.lit(len(required) - len(present_columns))),
        line("non_numeric_columns", "", F.lit(sum(c not in numeric for c in present_columns))),
        line("missing_values", "", total_missing),
        *[line("missing_values", c, F.col(f"m{i}")) for i, c in enumerate(present_columns)],
        *([line("malformed_rows", "", F.col("wrong"))] if checked else []),
        *[line("malformed_cells", c, F.col(f"w{i}")) for i, c in enumerate([*checked, "*"] if checked else [])],
    ]
    return row.select(F.inline(F.array(*lines)))
