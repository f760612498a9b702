"""Small results stored next to a model: metrics, threshold, runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

THRESHOLD_SCHEMA = "threshold double, model_name string, created_at string"
RUN_SCHEMA = ("run_id string, run_name string, created_at timestamp, params map<string,string>, "
              "metrics map<string,double>, artefact string")


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def save_threshold(thresholds: DataFrame, path: str) -> str:
    """``thresholds``: columns ``threshold, model_name`` (one row)."""
    stamped = thresholds.select(F.col("threshold").cast("double"), "model_name",
                                F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"))
    return write_json(stamped, path)


def load_threshold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(THRESHOLD_SCHEMA).json(path)


def resolve_threshold(saved: DataFrame | None, argument: float | None = None, default: float = 0.5) -> Column:
    """The threshold to use: an explicit argument, else the saved one, else the default."""
    given = F.lit(argument).cast("double")
    stored = saved.agg(F.max("threshold")).scalar() if saved is not None else F.lit(None).cast("double")
    return F.coalesce(given, stored, F.lit(float(default)))


def record_runs(results: DataFrame, path: str, name: str, metrics: list[str], params: dict[str, str] | None = None,
                artefact: str | None = None) -> str:
    """Append one run per row of ``results`` (column ``name`` is the run name) to the run table."""
    pairs = [F.lit(v) for kv in (params or {}).items() for v in map(str, kv)]
    packed = F.map_from_arrays(F.array(*[F.lit(m) for m in metrics]), F.array(*[F.col(m).cast("double") for m in metrics]))
    stated = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    results.select(
        F.expr("uuid()").alias("run_id"), F.col(name).cast("string").alias("run_name"),
        F.current_timestamp().alias("created_at"), stated.alias("params"), packed.alias("metrics"),
        F.lit(artefact).cast("string").alias("artefact")).write.mode("append").parquet(path)
    return path


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def run_metrics(runs: DataFrame) -> DataFrame:
    """Rows ``(run_name, metric, value)``."""
    return runs.select("run_name", F.explode("metrics").alias("metric", "value"))
