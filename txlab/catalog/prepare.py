"""Scaling, splitting and rebalancing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rounded
from ..operators import neighbours, prepare as p, resample as r
from ..plans.preparation import prepare_data
from ..session import freeze
from .registry import query
from .roles import FEATURES, TX, VECTORS, sql_hash, sql_uniform, table, transactions, vectors

SCALED = ["Amount", "Time", "User"]
HASH = sql_hash("event_id", "42")
RANKED = f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY "Class" ORDER BY {HASH}, event_id) AS rn, count(*) OVER (PARTITION BY "Class") AS n
  FROM tx)"""


def _round(df, columns):
    return df.withColumns({c: rounded(F.col(c)) for c in columns})


@query("scale_fit", f"WITH {TX} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(avg("{c}"), 6) AS mean, round(stddev_pop("{c}"), 6) AS std FROM tx""" for c in SCALED))
def scale_fit(spark, folder):
    """Mean and population standard deviation per feature."""
    return _round(p.scale_fit(transactions(spark, folder), SCALED), ["mean", "std"])


def sql_scaled(columns, source="tx", fit="tx"):
    return ", ".join(
        f"""round(("{c}" - (SELECT avg("{c}") FROM {fit})) / (SELECT stddev_pop("{c}") FROM {fit}), 6) AS "{c}" """ for c in columns)


@query("scale_transform", f"""WITH {TX} SELECT event_id, {sql_scaled(SCALED)} FROM tx""")
def scale_transform(spark, folder):
    """Scaled features of every row."""
    tx = transactions(spark, folder)
    return _round(p.scale_transform(tx, p.scale_fit(tx, SCALED), SCALED), SCALED).select("event_id", *SCALED)


@query("prepare_features", f"""
  WITH {TX}, s AS (SELECT event_id, "User", "Ticks", "Hour", "Class", {sql_scaled(["Amount", "Time"])} FROM tx)
  SELECT event_id, "User", "Ticks", "Hour", "Amount" AS "Amount_scaled", "Time" AS "Time_scaled", "Class" FROM s""")
def prepare_features(spark, folder):
    """Features with scaled amount and time, raw ones gone."""
    tx = transactions(spark, folder)
    out = p.prepare_features(tx, "event_id", p.scale_fit(tx, ["Amount", "Time"]), ["User", "Ticks", "Hour"])
    return _round(out, ["Amount_scaled", "Time_scaled"])


@query("stratified_split", f"""
  WITH {TX}, {RANKED}
  SELECT event_id, "Class", CASE WHEN rn <= round(n * 0.2e0) THEN 'test' ELSE 'train' END AS split FROM ranked""")
def stratified_split(spark, folder):
    """80/20 split, the same share of every class."""
    return p.stratified_split(transactions(spark, folder), "event_id", "Class").select("event_id", "Class", "split")


@query("approx_split", f"""
  WITH {TX} SELECT event_id, "Class", CASE WHEN {sql_uniform(HASH)} < 0.2e0 THEN 'test' ELSE 'train' END AS split FROM tx""")
def approx_split(spark, folder):
    """One-pass split by hash, without exact class shares."""
    return p.approx_split(transactions(spark, folder), "event_id").select("event_id", "Class", "split")


THREE_WAY = f"""{RANKED}, split AS (
  SELECT *, CASE WHEN rn <= round(n * 0.2e0) THEN 'test' WHEN rn <= round(n * 0.36e0) THEN 'val' ELSE 'train' END AS split
  FROM ranked)"""


@query("three_way_split", f"""WITH {TX}, {THREE_WAY} SELECT event_id, "Class", split FROM split""")
def three_way_split(spark, folder):
    """Test, then validation from the rest, both stratified."""
    return p.three_way_split(transactions(spark, folder), "event_id", "Class").select("event_id", "Class", "split")


@query("process_data", f"""
  WITH {TX}, {THREE_WAY}, fit AS (SELECT * FROM split WHERE split = 'train')
  SELECT event_id, "Class", split, {sql_scaled(SCALED, "split", "fit")} FROM split""")
def process_data(spark, folder):
    """Three-way split with a scaler fitted on the training part."""
    out = p.process_data(transactions(spark, folder), "event_id", "Class", SCALED)
    return _round(out, SCALED).select("event_id", "Class", "split", *SCALED)


@query("split_info", f"""
  WITH {TX}, {THREE_WAY}
  SELECT split, count(*)::BIGINT AS total, sum("Class")::BIGINT AS positive, sum(1 - "Class")::BIGINT AS negative,
         round(avg("Class") * 100, 6) AS positive_rate FROM split GROUP BY split""")
def split_info(spark, folder):
    """Sizes and positive rate of every split."""
    split = p.three_way_split(transactions(spark, folder), "event_id", "Class")
    return _round(p.split_info(split, "Class"), ["positive_rate"])


@query("fold_assign", f"""
  WITH {TX} SELECT event_id, "Class",
    (ntile(5) OVER (PARTITION BY "Class" ORDER BY {HASH}, event_id) - 1)::INTEGER AS fold FROM tx""")
def fold_assign(spark, folder):
    """Five stratified folds."""
    return p.fold_assign(transactions(spark, folder), "event_id", "Class").select("event_id", "Class", "fold")


@query("class_weights", """
  SELECT o_orderstatus, count(*)::BIGINT AS n,
         round((SELECT count(*) FROM orders) / (count(*) * (SELECT count(DISTINCT o_orderstatus) FROM orders))::DOUBLE, 6) AS weight
  FROM orders GROUP BY o_orderstatus""")
def class_weights(spark, folder):
    """Balanced weights of a label with three classes."""
    return _round(r.class_weights(table(spark, folder, "orders"), "o_orderstatus"), ["weight"])


@query("undersample", f"""
  WITH {TX}, {RANKED} SELECT event_id, "Class", 0 AS copy FROM ranked
  WHERE rn <= (SELECT min(n) FROM ranked)""")
def undersample(spark, folder):
    """Every class cut to the smallest."""
    return r.undersample(transactions(spark, folder), "event_id", "Class").select("event_id", "Class", "copy")


MADE = """made AS (
  SELECT *, ((m - n) // n + CASE WHEN rn <= (m - n) % n THEN 1 ELSE 0 END)::BIGINT AS made
  FROM (SELECT *, max(n) OVER () AS m FROM ranked))"""


@query("oversample", f"""
  WITH {TX}, {RANKED}, {MADE} SELECT event_id, "Class", unnest(range(made + 1))::INTEGER AS copy FROM made""")
def oversample(spark, folder):
    """Every class grown to the largest by repeating rows."""
    return r.oversample(transactions(spark, folder), "event_id", "Class").select("event_id", "Class", "copy")


VEC = "[" + ", ".join(f'"{v}"' for v in FEATURES) + "]"
NEAR = f"""minority AS (SELECT vec_id, {VEC} AS v FROM vectors WHERE "Class" = 1),
near AS (
  SELECT a.vec_id, b.vec_id AS neighbour, b.v AS nv, list_distance(a.v, b.v) AS distance,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rank
  FROM minority a JOIN minority b ON a.vec_id <> b.vec_id QUALIFY rank <= 5)"""


@query("knn_minority", f"""
  WITH {VECTORS}, {NEAR} SELECT vec_id AS key, rank::INTEGER AS rank, neighbour, round(distance, 6) AS distance FROM near""")
def knn_minority(spark, folder):
    """The five nearest minority rows of every minority row."""
    near = neighbours.nearest_rows(vectors(spark, folder).where("Class = 1"), "vec_id", FEATURES)
    return _round(near, ["distance"]).select("key", "rank", "neighbour", "distance")


DIGEST = "md5(vec_id::VARCHAR || ':42:' || copy::VARCHAR)"


@query("smote", f"""
  WITH {VECTORS}, {NEAR}, lists AS (SELECT vec_id, list(nv ORDER BY rank) AS nvs FROM near GROUP BY vec_id),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY "Class" ORDER BY {sql_hash("vec_id", "42")}, vec_id) AS rn,
                    count(*) OVER (PARTITION BY "Class") AS n FROM vectors), {MADE},
  copies AS (SELECT *, unnest(range(1, made + 1))::INTEGER AS copy FROM made WHERE "Class" = 1),
  drawn AS (SELECT c.*, {sql_uniform(DIGEST, 1)} AS u,
                   nvs[1 + floor({sql_uniform(DIGEST)} * len(nvs))::INTEGER] AS nb FROM copies c JOIN lists USING (vec_id))
  SELECT vec_id, "Class", 0 AS copy, {", ".join(f'round("{v}", 6) AS "{v}"' for v in FEATURES)} FROM vectors
  UNION ALL
  SELECT vec_id, "Class", copy, {", ".join(f'round("{v}" + u * (nb[{i}] - "{v}"), 6) AS "{v}"' for i, v in enumerate(FEATURES, 1))}
  FROM drawn""")
def smote(spark, folder):
    """The minority class grown with points between near neighbours."""
    return _round(r.smote(vectors(spark, folder), "vec_id", "Class", FEATURES), FEATURES)


@query("rebalance_strategies", f"""
  WITH {TX}, c AS (SELECT "Class", count(*) AS n FROM tx GROUP BY "Class"), b AS (SELECT min(n) AS lo, max(n) AS hi FROM c)
  SELECT strategy, "Class", CASE strategy WHEN 'under' THEN lo WHEN 'over' THEN hi ELSE n END::BIGINT AS rows
  FROM c, b, (VALUES ('none'), ('class_weight'), ('under'), ('over'), ('no such name')) AS s(strategy)""")
def rebalance_strategies(spark, folder):
    """Class sizes after each strategy; an unknown name changes nothing."""
    tx = freeze(transactions(spark, folder), "tx")
    out = None
    for s in ("none", "class_weight", "under", "over", "no such name"):
        rows = r.rebalance(tx, s, "event_id", "Class", ["Amount"]).groupBy("Class").agg(
            F.count(F.lit(1)).alias("rows")).withColumn("strategy", F.lit(s))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("rebalance_smote", f"""
  WITH {VECTORS}, c AS (SELECT "Class", count(*) AS n FROM vectors GROUP BY "Class")
  SELECT 'smote' AS strategy, "Class", (SELECT max(n) FROM c)::BIGINT AS rows FROM c""")
def rebalance_smote(spark, folder):
    """Class sizes after the strategy ``smote``, the one ``rebalance_strategies`` leaves out."""
    rows = r.rebalance(vectors(spark, folder), "smote", "vec_id", "Class", FEATURES)
    return rows.groupBy("Class").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("smote").alias("strategy"), "Class", "rows")


@query("prepare_end_to_end", f"""
  WITH {TX}, {RANKED}, split AS (SELECT *, CASE WHEN rn <= round(n * 0.2e0) THEN 'test' ELSE 'train' END AS split FROM ranked),
  fit AS (SELECT * FROM split WHERE split = 'train'),
  again AS (SELECT event_id, "User", "Ticks", "Class", split, {sql_scaled(["Amount", "Time"], "split", "fit")},
                   row_number() OVER (PARTITION BY split, "Class" ORDER BY {HASH}, event_id) AS place FROM split)
  SELECT event_id, "User", "Ticks", "Amount" AS "Amount_scaled", "Time" AS "Time_scaled", "Class", split, 0 AS copy FROM again
  WHERE split = 'test' OR place <= (SELECT min(n) FROM (SELECT count(*) AS n FROM fit GROUP BY "Class"))""")
def prepare_end_to_end(spark, folder):
    """Split, scale on the training part, undersample the training part, store by split, read back."""
    from ..session import scratch_path
    data, _, _ = prepare_data(transactions(spark, folder), "event_id", ["User", "Ticks"], strategy="under",
                              path=scratch_path(spark, "prepared"))
    return _round(data, ["Amount_scaled", "Time_scaled"])


# lineitem has no unique key: order keys repeat, and only whole rows are distinct.
FLAGS = "n AS (SELECT l_returnflag, count(*)::BIGINT AS n FROM lineitem GROUP BY l_returnflag)"


@query("split_repeated_keys", f"""
  WITH {FLAGS}, t AS (SELECT *, round(n * 0.2e0)::BIGINT AS test, round(n * 0.36e0)::BIGINT AS upto FROM n)
  SELECT l_returnflag, 'test' AS split, test AS n, test AS different FROM t UNION ALL SELECT l_returnflag, 'val', upto - test, upto - test FROM t
  UNION ALL SELECT l_returnflag, 'train', n - upto, n - upto FROM t""")
def split_repeated_keys(spark, folder):
    """Three-way split where keys repeat: sizes are exact and every row is in one part."""
    split = p.three_way_split(table(spark, folder, "lineitem"), "l_orderkey", "l_returnflag")
    whole = F.xxhash64(*[c for c in split.columns if c != "split"])
    return split.groupBy("l_returnflag", "split").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(whole).alias("different"))


@query("undersample_repeated_keys", f"""
  WITH {FLAGS} SELECT l_returnflag, (SELECT min(n) FROM n) AS n, (SELECT min(n) FROM n) AS different FROM n""")
def undersample_repeated_keys(spark, folder):
    """Every class cut to the smallest where keys repeat."""
    few = r.undersample(table(spark, folder, "lineitem"), "l_orderkey", "l_returnflag")
    whole = F.xxhash64(*[c for c in few.columns if c != "copy"])
    return few.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(whole).alias("different"))


@query("folds_equal_rows", f"""
  WITH c AS (SELECT l_returnflag, count(*)::BIGINT AS n FROM lineitem GROUP BY l_returnflag)
  SELECT l_returnflag, j::INTEGER AS fold, n // 5 + (j < n % 5)::BIGINT AS n FROM c, (SELECT unnest(range(5)) AS j)""")
def folds_equal_rows(spark, folder):
    """Five folds of rows of which most equal many others: a cut among equal rows takes as many as it needs."""
    few = table(spark, folder, "lineitem").select("l_returnflag", (F.col("l_linenumber") % 3).alias("line"))
    return p.fold_assign(few, "line", "l_returnflag").groupBy("l_returnflag", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("oversample_repeated_keys", f"""
  WITH {FLAGS}, e AS (SELECT (event_type = 'error')::INTEGER AS "Class", count(*)::BIGINT AS n FROM events GROUP BY 1)
  SELECT 'lineitem' AS source, l_returnflag AS label, (SELECT max(n) FROM n) AS n, n AS originals FROM n
  UNION ALL SELECT 'events', "Class"::VARCHAR, (SELECT max(n) FROM e), n FROM e""")
def oversample_repeated_keys(spark, folder):
    """Every class grown to the largest, with repeated and with unique keys."""
    def sizes(name, df, key, label):
        grown = r.oversample(df, key, label)
        return grown.groupBy(F.lit(name).alias("source"), F.col(label).cast("string").alias("label")).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("copy") == 0).alias("originals"))
    return sizes("lineitem", table(spark, folder, "lineitem"), "l_orderkey", "l_returnflag").union(
        sizes("events", transactions(spark, folder), "event_id", "Class"))
