"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F

# Largest lookup table (rows) that is attached with a broadcast hint.
SMALL_ROWS = 10_000

#: Spark's setting that deletes the shuffle files of a query when it has ended, not when the driver's JVM next collects garbage.
SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_scratch: dict[str, str] = {}
#: Subfolder, ending with a slash, of the tables that ``freeze_only`` is making.
_within: ContextVar[str] = ContextVar("within", default="")


def pin(spark: SparkSession) -> SparkSession:
    """Fix the session time zone so that timestamps mean the same everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would be lost together with its machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = sc.applicationId
    if app not in _scratch:
        _scratch[app] = tempfile.mkdtemp(prefix="txlab-")
    return _scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below this application's part of the shared folder."""
    return f"{shared_dir(spark)}/txlab-{spark.sparkContext.applicationId}/{_within.get()}{name}-{uuid.uuid4().hex}"


def freeze(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Unlike a cached frame the result outlives lost executors, keeps columnar
    pruning, and has a known size that the optimizer can use.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def freeze_only(spark: SparkSession, work: Callable[[], DataFrame], name: str = "step") -> DataFrame:
    """``freeze`` of what ``work`` returns; the tables that it froze on the way are deleted, and so are the shuffle files of each step as it ends.

    For work whose intermediate tables take more than its result. Nothing but the result may be used afterwards. The setting for shuffle files is the
    session's and is put back, so two threads of a session must not do this at a time.
    """
    path = scratch_path(spark, "steps")
    outer = _within.get()
    token = _within.set(f"{outer}{path.rpartition('/')[2]}/")
    swept = spark.conf.get(SWEEP, None)
    spark.conf.set(SWEEP, "true")
    try:
        try:
            made = work()
        finally:
            _within.reset(token)
        result = freeze(made, name)
    finally:
        spark.conf.unset(SWEEP) if swept is None else spark.conf.set(SWEEP, swept)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return result


def drop_scratch(spark: SparkSession) -> bool:
    """Delete everything this application froze. Call when its results are stored."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(
        f"{shared_dir(spark)}/txlab-{spark.sparkContext.applicationId}")
    return path.getFileSystem(hadoop).delete(path, True)


def small_rows(small: DataFrame, limit: int = SMALL_ROWS) -> list | None:
    """The rows of ``small`` if there are at most ``limit`` of them, else None."""
    rows = small.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def attach_small(df: DataFrame, small: DataFrame, on: list[str], how: str = "left",
                 limit: int = SMALL_ROWS) -> DataFrame:
    """Join a lookup table to ``df``: broadcast if its size is checked, else shuffled.

    The lookup is computed once. Beyond ``limit`` rows it is written to the shared
    folder and joined without a hint, where adaptive execution splits skewed keys.
    NULL keys match each other, as they form one group in the lookup.
    """
    rows = small_rows(small, limit)
    if rows is not None:
        lookup = F.broadcast(df.sparkSession.createDataFrame(rows, small.schema))
    else:
        lookup = freeze(small, "lookup")
    renamed = lookup.select([F.col(c).alias(f"_on_{c}") if c in on else F.col(c) for c in lookup.columns])
    matches = [df[c].eqNullSafe(renamed[f"_on_{c}"]) for c in on]
    condition = matches[0]
    for m in matches[1:]:
        condition = condition & m
    return df.join(renamed, condition, how).drop(*[f"_on_{c}" for c in on])
