"""Which supplied table plays which part, in DataFrame form and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import rounded

FEATURES = [f"V{i}" for i in range(1, 29)]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ---- keyed transactions: events --------------------------------------------------------

def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """event_id, Time (seconds since the first event), Amount, User, Ticks, Hour, Class."""
    events = table(spark, folder, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first = events.agg(F.min(micros)).scalar()
    return events.select(
        "event_id", ((micros - first).cast("double") / 1e6).alias("Time"), F.col("value").alias("Amount"),
        F.col("user_id").cast("double").alias("User"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("Ticks"),
        F.hour("ts").cast("double").alias("Hour"), (F.col("event_type") == "error").cast("int").alias("Class"))


TX = """tx AS (
  SELECT event_id, (epoch_us(ts) - min(epoch_us(ts)) OVER ())::DOUBLE / 1e6 AS "Time", value AS "Amount",
         user_id::DOUBLE AS "User", regexp_extract(props, '([0-9]+)', 1)::DOUBLE AS "Ticks",
         hour(ts)::DOUBLE AS "Hour", (event_type = 'error')::INTEGER AS "Class"
  FROM events)"""


# ---- large profile table: lineitem ------------------------------------------------------

def lines(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem")
    return li.select(
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("Amount"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
        (F.col("l_returnflag") == "R").cast("int").alias("Class"))


LINES = """lines AS (
  SELECT l_quantity AS quantity, l_extendedprice AS "Amount", l_discount AS discount, l_tax AS tax,
         (l_returnflag = 'R')::INTEGER AS "Class"
  FROM lineitem)"""


def checks(spark: SparkSession, folder: str) -> DataFrame:
    """``lines`` with a scaled copy, a constant and a nearly constant column, for the leakage checks."""
    return lines(spark, folder).withColumns({
        "doubled": F.col("quantity") * 2, "constant": F.lit(7.0), "faint": F.col("discount") * F.lit(0.001)})


CHECKS = LINES + """, checks AS (
  SELECT *, quantity * 2 AS doubled, 7.0::DOUBLE AS constant, discount * 0.001::DOUBLE AS faint FROM lines)"""


def gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions in which small amounts are NULL and some users are NaN."""
    return transactions(spark, folder).withColumns({
        "Amount": F.when(F.col("Amount") >= 10, F.col("Amount")),
        "User": F.when(F.col("User") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("User"))})


GAPS = TX + """, gaps AS (
  SELECT event_id, "Time", CASE WHEN "Amount" >= 10 THEN "Amount" END AS "Amount",
         CASE WHEN "User" % 7 = 0 THEN 'NaN'::DOUBLE ELSE "User" END AS "User", "Ticks", "Hour", "Class"
  FROM tx)"""


# ---- V1..V28: embeddings ------------------------------------------------------------------

def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        "vec_id", *[F.col("embedding")[i].cast("double").alias(v) for i, v in enumerate(FEATURES)],
        (F.col("label") == 0).cast("int").alias("Class"))


VECTORS = "vectors AS (SELECT vec_id, " + ", ".join(
    f'embedding[{i}]::DOUBLE AS "V{i}"' for i in range(1, 29)) + ', (label = 0)::INTEGER AS "Class" FROM embeddings)'


# ---- scored rows: events with closed-form scorers ----------------------------------------------

def sigmoid(z):
    return rounded(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))


def amount_score():
    return sigmoid((F.col("Amount") - 50.0) / 40.0)


SIGMOID_AMOUNT = 'round(1e0 / (1e0 + exp(-(("Amount" - 50e0) / 40e0))), 6)'


def model_scores():
    """Three scorers: the amount, its opposite, and one that knows the label in part."""
    return {
        "amount": amount_score(),
        "inverse": sigmoid((F.lit(50.0) - F.col("Amount")) / 40.0),
        "partial": sigmoid(F.col("Class") * 2.0 + F.col("Ticks") / 50.0 - 1.5),
    }


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return transactions(spark, folder).select(
        F.col("event_id").alias("key"), F.col("Class").alias("label"), model_scores()["partial"].alias("score"))


PARTIAL = 'round(1e0 / (1e0 + exp(-("Class" * 2e0 + "Ticks" / 50e0 - 1.5e0))), 6)'
SCORED = TX + f""", scored AS (
  SELECT event_id AS key, "Class" AS label, {PARTIAL} AS score FROM tx)"""


def scored_models(spark: SparkSession, folder: str) -> DataFrame:
    """Rows ``(model, key, label, score)``; the table is read once for all models."""
    per_model = F.array(*[F.struct(F.lit(m).alias("model"), s.alias("score")) for m, s in model_scores().items()])
    return transactions(spark, folder).select(
        F.col("event_id").alias("key"), F.col("Class").alias("label"), F.inline(per_model)).select(
        "model", "key", "label", "score")


SCORED_MODELS = TX + f""", scored_models AS (
  SELECT 'amount' AS model, event_id AS key, "Class" AS label, {SIGMOID_AMOUNT} AS score FROM tx
  UNION ALL SELECT 'inverse', event_id, "Class", round(1e0 / (1e0 + exp(-((50e0 - "Amount") / 40e0))), 6) FROM tx
  UNION ALL SELECT 'partial', event_id, "Class", {PARTIAL} FROM tx)"""


# ---- drift pair: lineitem before and after a date ------------------------------------------------

DRIFT_FEATURES = ["quantity", "Amount", "discount", "tax", "margin"]


def drift_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Earlier and later lines. ``margin`` shifts between them, ``only_before`` exists on one side."""
    li = table(spark, folder, "lineitem")
    late = F.col("l_shipdate") >= F.lit("1998-06-01").cast("timestamp_ntz")
    columns = [F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("Amount"),
               F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax")]
    margin = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    before = li.where(~late).select(*columns, margin.alias("margin"), F.col("l_quantity").alias("only_before"))
    after = li.where(late).select(*columns, (margin * 1.1).alias("margin"))
    return before, after


DRIFT = """before AS (
  SELECT l_quantity AS quantity, l_extendedprice AS "Amount", l_discount AS discount, l_tax AS tax,
         l_extendedprice * (1e0 - l_discount) AS margin
  FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-06-01'),
after AS (
  SELECT l_quantity AS quantity, l_extendedprice AS "Amount", l_discount AS discount, l_tax AS tax,
         l_extendedprice * (1e0 - l_discount) * 1.1e0 AS margin
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-06-01')"""


def sql_long(source: str, columns: list[str], keep: str = "") -> str:
    """SQL for one row ``(feature, value)`` per cell."""
    return " UNION ALL ".join(
        f"""SELECT {keep}'{c}' AS feature, "{c}"::DOUBLE AS value FROM {source}""" for c in columns)


def sql_hash(key: str, *salt: str) -> str:
    return f"md5({key}::VARCHAR || ':{':'.join(salt)}')"


def sql_uniform(digest: str, block: int = 0) -> str:
    return f"(('0x' || substr({digest}, {1 + 8 * block}, 8))::BIGINT / 4294967296e0)"
