"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rounded
from ..operators import correlation as c, histogram as h, profile as p
from ..plans.eda import eda_report
from .registry import query
from .roles import CHECKS, GAPS, LINES, TX, checks, gaps, lines, sql_long, table, transactions

NUMERIC = ["quantity", "Amount", "discount", "tax", "Class"]
CHECKED = [*NUMERIC, "doubled", "constant", "faint"]


@query("table_info", f"""
  WITH {TX}
  SELECT 'shape' AS section, 'rows' AS name, count(*)::VARCHAR AS value FROM tx
  UNION ALL SELECT 'shape', 'columns', '7'
  UNION ALL SELECT 'dtype', name, kind FROM (VALUES ('event_id', 'bigint'), ('Time', 'double'), ('Amount', 'double'),
    ('User', 'double'), ('Ticks', 'double'), ('Hour', 'double'), ('Class', 'int')) AS d(name, kind)
  UNION ALL SELECT 'missing', name, '0' FROM (VALUES ('event_id'), ('Time'), ('Amount'), ('User'), ('Ticks'), ('Hour'),
    ('Class')) AS d(name)
  UNION ALL SELECT 'label_count', "Class"::VARCHAR, count(*)::VARCHAR FROM tx GROUP BY "Class" """)
def table_info(spark, folder):
    """Shape, column types, missing values and label counts."""
    return p.table_info(transactions(spark, folder), "Class")


@query("table_summary", """
  SELECT count(*)::BIGINT AS total_rows, 5::BIGINT AS total_columns, 'c_custkey,c_nationkey,c_acctbal' AS numeric_columns,
         'c_name,c_mktsegment' AS text_columns,
         round(sum(20 + octet_length(c_name::BLOB) + octet_length(c_mktsegment::BLOB))::DOUBLE / 1048576e0, 6) AS size_mb
  FROM customer""")
def table_summary(spark, folder):
    """Counts, numeric and text columns, data size."""
    return p.table_summary(table(spark, folder, "customer")).withColumn("size_mb", rounded(F.col("size_mb")))


def _round_all(df, names):
    return df.select(*[rounded(F.col(x)).alias(x) if x in names else F.col(x) for x in df.columns])


STATS = ["mean", "std", "min", "p25", "p50", "p75", "max"]


def sql_describe(source: str, columns: list[str]) -> str:
    return f"""
  SELECT feature, count(value)::BIGINT AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
         round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25,
         round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS max
  FROM (SELECT * FROM ({sql_long(source, columns)}) WHERE value IS NOT NULL AND NOT isnan(value)) GROUP BY feature"""


@query("describe", f"WITH {LINES} " + sql_describe("lines", NUMERIC))
def describe(spark, folder):
    """count, mean, std, extremes and exact quartiles of every numeric column."""
    return _round_all(p.describe(lines(spark, folder), NUMERIC), STATS)


@query("describe_missing", f"WITH {GAPS} " + sql_describe("gaps", ["Amount", "User"]))
def describe_missing(spark, folder):
    """describe over columns with NULL and NaN, both skipped."""
    return _round_all(p.describe(gaps(spark, folder), ["Amount", "User"]), STATS)


@query("describe_approx")
def describe_approx(spark, folder):
    """describe with quartiles from a sketch: one pass, no shuffle of the data."""
    return _round_all(p.describe(lines(spark, folder), NUMERIC, exact=False), STATS)


@query("class_distribution", f"""
  WITH {TX} SELECT "Class", count(*)::BIGINT AS n, round(count(*) * 100e0 / sum(count(*)) OVER (), 6) AS pct
  FROM tx GROUP BY "Class" """)
def class_distribution(spark, folder):
    """Rows and percentage per class."""
    return _round_all(p.class_distribution(transactions(spark, folder), "Class"), ["pct"])


@query("imbalance", """
  SELECT count(*)::BIGINT AS total_rows, count(*) FILTER (WHERE toxic = 0)::BIGINT AS negatives,
         count(*) FILTER (WHERE toxic = 1)::BIGINT AS positives, round(avg(toxic) * 100, 6) AS positive_rate,
         round(count(*) FILTER (WHERE toxic = 0)::DOUBLE / count(*) FILTER (WHERE toxic = 1), 6) AS imbalance_ratio
  FROM labels""")
def imbalance(spark, folder):
    """Positive rate and imbalance ratio."""
    return _round_all(p.imbalance(table(spark, folder, "labels"), "toxic"), ["positive_rate", "imbalance_ratio"])


@query("target_correlation_topn", f"WITH {CHECKS} SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{x}' AS feature, CASE WHEN stddev_pop({x}) > 0 THEN round(abs(corr({x}, "Class")), 6) END AS abs_corr FROM checks"""
    for x in CHECKED if x != "Class") + ") ORDER BY abs_corr DESC NULLS LAST, feature LIMIT 15")
def target_correlation_topn(spark, folder):
    """Features by absolute correlation with the label; a constant one has none."""
    return _round_all(c.target_correlation(checks(spark, folder), "Class", 15), ["abs_corr"])


@query("correlation_matrix", f"WITH {LINES} " + " UNION ALL ".join(
    f"""SELECT '{a}' AS a, '{b}' AS b, round(corr("{a}", "{b}"), 6) AS r FROM lines""" for a in NUMERIC for b in NUMERIC))
def correlation_matrix(spark, folder):
    """The full matrix of the label and its strongest correlates."""
    return _round_all(c.correlation_matrix(lines(spark, folder), "Class", 15), ["r"])


def sql_histogram(source: str, column: str, bins: int, by: str = "") -> str:
    on = f'"{by}", ' if by else ""
    using = f'USING ("{by}")' if by else "ON true"
    return f"""
  s AS (SELECT {on}min("{column}") AS mn, max("{column}") AS mx FROM {source} {f'GROUP BY "{by}"' if by else ''}),
  b AS (SELECT {on}least(floor(("{column}" - mn) / ((mx - mn) / {bins}e0)), {bins - 1})::INTEGER AS bin, count(*)::BIGINT AS n
        FROM {source} JOIN s {using} GROUP BY ALL),
  f AS (SELECT {on}mn, mx, unnest(range({bins}))::INTEGER AS bin FROM s)
  SELECT {on}bin, round(mn + bin * ((mx - mn) / {bins}e0), 6) AS lo, round(mn + (bin + 1) * ((mx - mn) / {bins}e0), 6) AS hi,
         coalesce(n, 0)::BIGINT AS n FROM f LEFT JOIN b USING ({on}bin)"""


@query("histogram", f"WITH {LINES}, " + sql_histogram("lines", "Amount", 50))
def histogram(spark, folder):
    """50 equal-width bins of the amount."""
    return _round_all(h.histogram(lines(spark, folder), "Amount", 50), ["lo", "hi"])


@query("histogram_by_class", f"WITH {TX}, " + sql_histogram("tx", "Time", 30, "Class"))
def histogram_by_class(spark, folder):
    """30 bins of the time per class, over that class's own range."""
    return _round_all(h.histogram(transactions(spark, folder), "Time", 30, by="Class"), ["lo", "hi"])


@query("density_histogram", f"""WITH {LINES}, d AS (SELECT * FROM (WITH {sql_histogram("lines", "Amount", 50).strip()}))
  SELECT bin, lo, hi, round(n / ((SELECT count(*) FROM lines) * (SELECT (max("Amount") - min("Amount")) / 50e0 FROM lines)), 9) AS density
  FROM d""")
def density_histogram(spark, folder):
    """50 bins whose area is one."""
    out = _round_all(h.density_histogram(lines(spark, folder), "Amount", 50), ["lo", "hi"])
    return out.withColumn("density", rounded(F.col("density"), 9))


@query("duplicate_rows", """
  WITH g AS (SELECT o_orderstatus, o_orderpriority, o_orderdate, count(*) AS n FROM orders GROUP BY ALL)
  SELECT sum(n)::BIGINT AS total_rows, sum(n - 1)::BIGINT AS duplicates, round(sum(n - 1) * 100e0 / sum(n), 6) AS duplicate_pct
  FROM g""")
def duplicate_rows(spark, folder):
    """Rows beyond the first of each group alike in three columns; ``duplicate_whole_rows`` compares all."""
    rows = table(spark, folder, "orders").select("o_orderstatus", "o_orderpriority", "o_orderdate")
    return _round_all(p.duplicate_rows(rows), ["duplicate_pct"])


@query("duplicate_whole_rows", """
  WITH g AS (SELECT *, count(*) AS n FROM orders GROUP BY ALL)
  SELECT sum(n)::BIGINT AS total_rows, sum(n - 1)::BIGINT AS duplicates, round(sum(n - 1) * 100e0 / sum(n), 6) AS duplicate_pct
  FROM g""")
def duplicate_whole_rows(spark, folder):
    """Rows of which every column is as in an earlier one."""
    return _round_all(p.duplicate_rows(table(spark, folder, "orders")), ["duplicate_pct"])


@query("duplicate_rows_missing", f"""
  WITH {GAPS}, g AS (SELECT CASE WHEN NOT isnan("User") THEN "User" END AS u, "Ticks", "Hour", "Class", count(*) AS n
                     FROM gaps GROUP BY ALL)
  SELECT sum(n)::BIGINT AS total_rows, sum(n - 1)::BIGINT AS duplicates, round(sum(n - 1) * 100e0 / sum(n), 6) AS duplicate_pct
  FROM g""")
def duplicate_rows_missing(spark, folder):
    """Duplicates where missing values equal each other."""
    return _round_all(p.duplicate_rows(gaps(spark, folder).select("User", "Ticks", "Hour", "Class")), ["duplicate_pct"])


PERFECT = " UNION ALL ".join(
    f"""SELECT '{a}' AS a, '{b}' AS b FROM checks HAVING abs(CASE WHEN stddev_pop("{a}") > 0 AND stddev_pop("{b}") > 0
        THEN corr("{a}", "{b}") END) >= 1 - 1e-9""" for i, a in enumerate(CHECKED) for b in CHECKED[i + 1:])
VARIANCE = f"SELECT feature, var_samp(value) AS v FROM ({sql_long('checks', CHECKED)}) GROUP BY feature"


@query("perfect_correlations", f"WITH {CHECKS} SELECT * FROM ({PERFECT})")
def perfect_correlations(spark, folder):
    """Pairs of columns that determine each other linearly."""
    return c.perfect_correlations(checks(spark, folder), CHECKED)


WIDE, GAP = 64, -0.1  # components of the vectors as columns, with a gap at and below this value


@query("correlation_wide", f"""
  WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range({WIDE})) AS k FROM embeddings WHERE len(embedding) = {WIDE}),
  w AS (SELECT * FROM v WHERE x > {GAP} AND x <= 1)
  SELECT 'e' || p.k AS a, 'e' || q.k AS b, round(corr(p.x, q.x), 6) AS r FROM w p JOIN w q ON p.vec_id = q.vec_id AND p.k < q.k GROUP BY ALL""")
def correlation_wide(spark, folder):
    """All pairs of 64 columns with gaps, tile by tile."""
    x = [F.get("embedding", F.lit(k)).cast("double") for k in range(WIDE)]
    vectors = table(spark, folder, "embeddings").where(F.size("embedding") == WIDE)
    wide = vectors.select(*[F.when((x[k] > GAP) & (x[k] <= 1), x[k]).alias(f"e{k}") for k in range(WIDE)])
    return _round_all(c.correlation_pairs(wide, wide.columns), ["r"])


@query("zero_variance", f"WITH {CHECKS} SELECT feature, var_samp(value) AS variance FROM ({sql_long('checks', CHECKED)}) "
       "GROUP BY feature HAVING var_samp(value) = 0")
def zero_variance(spark, folder):
    """Constant columns."""
    return p.zero_variance(checks(spark, folder))


@query("low_variance", f"WITH {CHECKS} SELECT feature, round(var_samp(value), 12) AS variance FROM ("
       + sql_long("checks", [x for x in CHECKED if x != "Class"]) + ") GROUP BY feature HAVING var_samp(value) < 1e-6")
def low_variance(spark, folder):
    """Constant or nearly constant features."""
    return p.low_variance(checks(spark, folder), "Class").withColumn("variance", rounded(F.col("variance"), 12))


def sql_report() -> str:
    figures = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    described = " UNION ALL ".join(
        f"SELECT 'describe' AS section, feature AS name, '{f}' AS metric, {f}::DOUBLE AS value FROM d" for f in figures)
    hist = " UNION ALL ".join(
        f"SELECT 'histogram_Amount', bin::VARCHAR, '{f}', {f}::DOUBLE FROM h" for f in ("lo", "hi", "n"))
    correlations = " UNION ALL ".join(
        f"SELECT 'target_correlation', '{x}', 'abs_corr', CASE WHEN stddev_pop({x}) > 0 THEN abs(corr({x}, \"Class\")) END FROM checks"
        for x in CHECKED if x != "Class")
    missing = " UNION ALL ".join(
        f"SELECT 'missing', '', '{x}', count(*) FILTER (WHERE \"{x}\" IS NULL)::DOUBLE FROM checks" for x in CHECKED)
    duplicates = """(SELECT sum(n - 1)::DOUBLE AS dup, sum(n)::DOUBLE AS tot FROM
      (SELECT quantity, "Amount", discount, tax, "Class", count(*) AS n FROM checks GROUP BY ALL))"""
    return f"""
  WITH {CHECKS}, d AS ({sql_describe("checks", CHECKED)}), h AS (WITH {sql_histogram("checks", "Amount", 50).strip()}),
  dd AS {duplicates}
  SELECT section, name, metric, round(value, 6) AS value FROM (
    {described}
    UNION ALL SELECT 'summary', '', 'total_rows', count(*)::DOUBLE FROM checks
    UNION ALL SELECT 'summary', '', 'total_columns', 8e0
    UNION ALL SELECT 'summary', '', 'size_mb', count(*) * 60e0 / 1048576e0 FROM checks
    UNION ALL {missing}
    UNION ALL SELECT 'class', '', 'positive_rate', avg("Class") * 100 FROM checks
    UNION ALL SELECT 'class', '', 'imbalance_ratio', sum(1 - "Class")::DOUBLE / sum("Class")::DOUBLE FROM checks
    UNION ALL SELECT 'class', "Class"::VARCHAR, 'n', count(*)::DOUBLE FROM checks GROUP BY "Class"
    UNION ALL SELECT 'class', "Class"::VARCHAR, 'pct', count(*) * 100e0 / (SELECT count(*) FROM checks) FROM checks GROUP BY "Class"
    UNION ALL SELECT 'duplicates', '', 'duplicates', dup FROM dd
    UNION ALL SELECT 'duplicates', '', 'duplicate_pct', dup * 100 / tot FROM dd
    UNION ALL SELECT 'perfect_correlation', a || '~' || b, 'found', 1e0 FROM ({PERFECT})
    UNION ALL SELECT 'zero_variance', feature, 'found', 1e0 FROM ({VARIANCE}) WHERE v = 0
    UNION ALL SELECT 'low_variance', feature, 'found', 1e0 FROM ({VARIANCE}) WHERE v < 1e-6 AND feature <> 'Class'
    UNION ALL {correlations}
    UNION ALL {hist})"""


@query("eda_report", sql_report())
def eda_report_query(spark, folder):
    """The whole exploratory report."""
    return _round_all(eda_report(checks(spark, folder), "Class", ["Amount"]), ["value"])


def sql_report_by_class() -> str:
    pairs = " UNION ALL ".join(
        f"""SELECT 'correlation' AS section, '{a}~{b}' AS name, 'r' AS metric,
          CASE WHEN stddev_pop("{a}") > 0 AND stddev_pop("{b}") > 0 THEN round(corr("{a}", "{b}"), 6) END AS value FROM checks"""
        for i, a in enumerate(CHECKED) for b in CHECKED[i + 1:])
    bins = " UNION ALL ".join(
        f"""SELECT 'class_histogram_Amount', "Class"::VARCHAR || ':' || bin::VARCHAR, '{f}', {f}::DOUBLE FROM hc""" for f in ("lo", "hi", "n"))
    return f"""
  WITH {CHECKS}, hc AS (WITH {sql_histogram("checks", "Amount", 50, "Class").strip()})
  SELECT * FROM ({sql_report()}) UNION ALL ({pairs}) UNION ALL ({bins})"""


@query("eda_report_by_class", sql_report_by_class())
def eda_report_by_class(spark, folder):
    """The exploratory report with the histograms of each class and the whole correlation matrix."""
    return _round_all(eda_report(checks(spark, folder), "Class", ["Amount"], by_class=True, matrix=True), ["value"])
