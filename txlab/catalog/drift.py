"""Drift queries: earlier against later lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rounded
from ..functions.ks import HART_BOTTOM, HART_TOP
from ..operators import drift as d
from ..plans.monitoring import ADVICE, advice, monitor_report
from ..session import freeze
from .profile import STATS, sql_describe
from .registry import query
from .roles import DRIFT, DRIFT_FEATURES, drift_sides, sql_long, table


def _round(df, columns):
    return df.select(*[rounded(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns])


@query("reference_stats", f"""
  WITH {DRIFT}, s AS ({sql_describe("before", DRIFT_FEATURES)}) SELECT * EXCLUDE count FROM s""")
def reference_stats(spark, folder):
    """Statistics to keep for later drift checks."""
    return _round(d.reference_stats(drift_sides(spark, folder)[0], DRIFT_FEATURES), STATS)


KS = f"""{DRIFT}, cells AS (
  SELECT feature, value, count(*) FILTER (WHERE side = 'r') AS r, count(*) FILTER (WHERE side = 'w') AS w
  FROM ({sql_long("before", DRIFT_FEATURES, "'r' AS side, ")} UNION ALL {sql_long("after", DRIFT_FEATURES, "'w' AS side, ")})
  GROUP BY feature, value),
gaps AS (
  SELECT feature, sum(r) OVER a AS nr, sum(w) OVER a AS nw,
         abs(sum(r) OVER o / (sum(r) OVER a)::DOUBLE - sum(w) OVER o / (sum(w) OVER a)::DOUBLE) AS gap
  FROM cells WINDOW o AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY feature)),
ks AS (SELECT feature, max(nr)::BIGINT AS n_ref, max(nw)::BIGINT AS n_new, max(gap) AS ks_statistic FROM gaps GROUP BY feature)"""


def sql_tail(size: str) -> str:
    """p-value of ks_statistic as a scalar subquery."""
    lam2 = f"(ks_statistic * ks_statistic * ({size}))"
    return f"""CASE WHEN sqrt({lam2}) < 0.04 THEN 1e0 ELSE greatest(0e0, least(1e0, 2 * list_sum(list_transform(range(1, 101),
      lambda k: (CASE WHEN k % 2 = 1 THEN 1e0 ELSE -1e0 END) * exp(-2e0 * k * k * {lam2}))))) END"""


TESTED = f"""{KS}, tested AS (
  SELECT *, {sql_tail("n_ref::DOUBLE * n_new / (n_ref + n_new)")} AS p_value FROM ks),
flags AS (SELECT *, p_value < 0.05 AS drift FROM tested)"""


@query("ks_two_sample", f"WITH {KS} SELECT feature, n_ref, n_new, round(ks_statistic, 6) AS ks_statistic FROM ks")
def ks_two_sample(spark, folder):
    """Largest gap between the earlier and the later distribution of each feature."""
    return _round(d.ks_two_sample(*drift_sides(spark, folder)), ["ks_statistic"])


@query("ks_pvalue", f"""
  WITH {TESTED} SELECT feature, round(ks_statistic, 6) AS ks_statistic, round(p_value, 6) AS p_value FROM tested""")
def ks_pvalue(spark, folder):
    """Asymptotic p-value of each statistic."""
    tested = d.ks_pvalue(d.ks_two_sample(*drift_sides(spark, folder)))
    return _round(tested, ["ks_statistic", "p_value"]).select("feature", "ks_statistic", "p_value")


def sql_polynomial(x: str, coefficients: list[float]) -> str:
    value = f"{coefficients[0]!r}::DOUBLE"
    for c in coefficients[1:]:
        value = f"({value} * {x} + {c!r}::DOUBLE)"
    return value


TAIL_AT = "exp(-0.5e0 * z * z) * " + sql_polynomial("abs(z)", HART_TOP) + " / " + sql_polynomial("abs(z)", HART_BOTTOM)


@query("ks_normal", f"""
  WITH {DRIFT}, s AS (SELECT feature, avg(value) AS m, stddev_samp(value) AS sd FROM ({sql_long("before", DRIFT_FEATURES)}) GROUP BY feature),
  cells AS (SELECT feature, value, count(*) AS w FROM ({sql_long("after", DRIFT_FEATURES)}) GROUP BY feature, value),
  z AS (SELECT feature, (value - m) / sd AS z, w, sum(w) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS upto,
               sum(w) OVER (PARTITION BY feature) AS n FROM cells JOIN s USING (feature)),
  e AS (SELECT *, CASE WHEN z > 0 THEN 1e0 - tail ELSE tail END AS f
        FROM (SELECT *, CASE WHEN abs(z) > 7 THEN 0e0 ELSE {TAIL_AT} END AS tail FROM z)),
  ks AS (SELECT feature, max(n)::BIGINT AS n_new, max(greatest(abs(upto / n::DOUBLE - f), abs(f - (upto - w) / n::DOUBLE))) AS ks_statistic
         FROM e GROUP BY feature)
  SELECT feature, n_new, round(ks_statistic, 6) AS ks_statistic, round({sql_tail("n_new::DOUBLE")}, 6) AS p_value FROM ks""")
def ks_normal(spark, folder):
    """Later lines against the normal distribution with the earlier mean and deviation."""
    before, after = drift_sides(spark, folder)
    stats = freeze(d.reference_stats(before, DRIFT_FEATURES, exact=False), "stats")
    return _round(d.ks_normal(after, stats), ["ks_statistic", "p_value"])


@query("drift_flags", f"WITH {TESTED} SELECT feature, drift FROM flags")
def drift_flags(spark, folder):
    """Which features drifted; a feature missing on one side is skipped."""
    return d.detect_drift(*drift_sides(spark, folder)).select("feature", "drift")


SUMMARY = f"""{TESTED}, summary AS (
  SELECT count(*)::BIGINT AS total_features, count(*) FILTER (WHERE drift)::BIGINT AS features_with_drift,
         avg(ks_statistic) AS avg_ks_statistic, avg(p_value) AS avg_p_value,
         count(*) FILTER (WHERE drift) * 100e0 / count(*) AS drift_percentage FROM flags),
severe AS (SELECT *, CASE WHEN drift_percentage > 20 THEN 'high' WHEN drift_percentage > 10 THEN 'moderate' ELSE 'low' END AS severity
           FROM summary)"""


@query("drift_summary", f"""
  WITH {SUMMARY} SELECT total_features, features_with_drift, round(avg_ks_statistic, 6) AS avg_ks_statistic,
         round(avg_p_value, 6) AS avg_p_value, round(drift_percentage, 6) AS drift_percentage FROM summary""")
def drift_summary(spark, folder):
    """How many features drifted, mean statistic and p-value."""
    out = d.drift_summary(d.detect_drift(*drift_sides(spark, folder)))
    return _round(out, ["avg_ks_statistic", "avg_p_value", "drift_percentage"])


@query("drift_severity", f"""
  WITH {SUMMARY} SELECT features_with_drift, severity, CASE severity """
       + " ".join(f"WHEN '{s}' THEN '{text}'" for s, text in ADVICE.items()) + " END AS recommendation FROM severe")
def drift_severity(spark, folder):
    """Severity and what to do."""
    out = advice(d.drift_severity(d.drift_summary(d.detect_drift(*drift_sides(spark, folder)))))
    return out.select("features_with_drift", "severity", "recommendation")


@query("drift_plot_data", f"""
  WITH {TESTED}, kb AS (SELECT min(ks_statistic) AS mn, max(ks_statistic) AS mx FROM flags),
  kh AS (SELECT b.bin, mn + b.bin * ((mx - mn) / 20e0) AS x,
                count(f.feature) FILTER (WHERE least(floor((ks_statistic - mn) / ((mx - mn) / 20e0)), 19) = b.bin)::DOUBLE AS y
         FROM kb, (SELECT unnest(range(20)) AS bin) b, flags f GROUP BY b.bin, mn, mx),
  top AS (SELECT feature FROM flags WHERE drift ORDER BY ks_statistic DESC, feature LIMIT 5),
  v AS (SELECT * FROM ({sql_long("after", DRIFT_FEATURES)}) WHERE feature IN (SELECT feature FROM top)),
  vb AS (SELECT feature, min(value) AS mn, max(value) AS mx, count(*) AS t FROM v GROUP BY feature),
  vc AS (SELECT feature, least(floor((value - mn) / ((mx - mn) / 50e0)), 49) AS bin, count(*) AS n FROM v JOIN vb USING (feature) GROUP BY ALL),
  vf AS (SELECT feature, mn, mx, t, unnest(range(50))::DOUBLE AS bin FROM vb),
  s AS (SELECT feature, avg(value) AS m, stddev_samp(value) AS sd FROM ({sql_long("before", DRIFT_FEATURES)}) GROUP BY feature)
  SELECT plot, series, round(x, 6) AS x, round(y, 6) AS y FROM (
    SELECT 'ks_histogram' AS plot, 'ks_statistic' AS series, x, y FROM kh
    UNION ALL SELECT 'density', feature, mn + bin * ((mx - mn) / 50e0), coalesce(n, 0) / (t * ((mx - mn) / 50e0))
    FROM vf LEFT JOIN vc USING (feature, bin)
    UNION ALL SELECT 'normal', feature, m + (i * 6e0 / 99e0 - 3e0) * sd,
      exp(-0.5e0 * (i * 6e0 / 99e0 - 3e0) * (i * 6e0 / 99e0 - 3e0)) / (sd * sqrt(2 * pi()))
    FROM s, (SELECT unnest(range(100))::DOUBLE AS i) WHERE feature IN (SELECT feature FROM top))""")
def drift_plot_data(spark, folder):
    """Numbers behind the drift plots."""
    before, after = drift_sides(spark, folder)
    flags = freeze(d.detect_drift(before, after), "flags")
    return _round(d.drift_plot_data(flags, after, d.reference_stats(before, DRIFT_FEATURES, exact=False)), ["x", "y"])


@query("monitor_report", f"""
  WITH {SUMMARY} SELECT section, name, metric, round(value, 6) AS value FROM (
    SELECT 'data' AS section, '' AS name, 'rows' AS metric, count(*)::DOUBLE AS value FROM after
    UNION ALL VALUES ('data', '', 'columns', 5e0), ('feature', 'only_before', 'skipped', 1e0), ('data', '', 'missing_values', 0e0)
    UNION ALL SELECT 'feature', feature, 'ks_statistic', ks_statistic FROM flags
    UNION ALL SELECT 'feature', feature, 'p_value', p_value FROM flags
    UNION ALL SELECT 'feature', feature, 'drift', drift::INTEGER FROM flags
    UNION ALL SELECT 'summary', '', 'total_features', total_features FROM summary
    UNION ALL SELECT 'summary', '', 'features_with_drift', features_with_drift FROM summary
    UNION ALL SELECT 'summary', '', 'drift_percentage', drift_percentage FROM summary
    UNION ALL SELECT 'summary', '', 'avg_ks_statistic', avg_ks_statistic FROM summary
    UNION ALL SELECT 'summary', '', 'avg_p_value', avg_p_value FROM summary
    UNION ALL SELECT 'severity', severity, 'given', 1e0 FROM severe)""")
def monitor_report_query(spark, folder):
    """The whole drift report."""
    before, after = drift_sides(spark, folder)
    return _round(monitor_report(before, after), ["value"])


# Walks are counted row by row here, and divided by the number of all walks at the end. With more than 100,000 cells, or
# more walks than a double holds, the asymptotic tail is taken by both.
@query("ks_exact", f"""
  WITH RECURSIVE c AS (SELECT c_nationkey, c_acctbal AS v, count(*) FILTER (WHERE c_mktsegment <> 'BUILDING') AS r, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS w
    FROM customer GROUP BY ALL),
  f AS (SELECT *, sum(r) OVER u AS cr, sum(w) OVER u AS cw, sum(r) OVER g AS nr, sum(w) OVER g AS nw FROM c
    WINDOW u AS (PARTITION BY c_nationkey ORDER BY v ROWS UNBOUNDED PRECEDING), g AS (PARTITION BY c_nationkey)),
  k AS (SELECT c_nationkey, max(nr)::BIGINT AS n, max(nw)::BIGINT AS m, max(abs(cr / nr::DOUBLE - cw / nw::DOUBLE)) AS d FROM f WHERE nr > 0 AND nw > 0 GROUP BY c_nationkey),
  s AS (SELECT *, round(d * n * m)::BIGINT AS reach FROM k WHERE n * m <= {d.EXACT_CELLS}),
  walk AS (
    SELECT c_nationkey, n, m, reach, 0 AS x, list_transform(range(0, m + 1), lambda y: CASE WHEN y * n < reach THEN 1e0 ELSE 0e0 END) AS paths FROM s
    UNION ALL
    SELECT c_nationkey, n, m, reach, x + 1, list_transform(range(0, m + 1), lambda y: CASE WHEN abs((x + 1) * m - y * n) < reach THEN
      list_sum(list_transform(range(0, y + 1), lambda z: CASE WHEN abs((x + 1) * m - z * n) < reach THEN paths[z + 1] ELSE 0e0 END)) ELSE 0e0 END) FROM walk WHERE x < n),
  exact AS (SELECT c_nationkey, 1 - paths[m + 1] / exp(lgamma(n + m + 1) - lgamma(n + 1) - lgamma(m + 1)) AS p FROM walk WHERE x = n),
  tail AS (SELECT c_nationkey, CASE WHEN d * sqrt(n * m / (n + m)::DOUBLE) < 0.04 THEN 1e0 ELSE 2e0 * list_sum(list_transform(range(1, 101),
    lambda j: CASE WHEN j % 2 = 1 THEN 1e0 ELSE -1e0 END * exp(-2e0 * j * j * d * d * n * m / (n + m)::DOUBLE))) END AS p FROM k)
  SELECT c_nationkey, n AS n_ref, m AS n_new, round(d, 6) AS ks_statistic, round(greatest(0e0, least(1e0, coalesce(exact.p, tail.p))), 6) AS p_value
  FROM k LEFT JOIN exact USING (c_nationkey) LEFT JOIN tail USING (c_nationkey)""")
def ks_exact(spark, folder):
    """Balances of one market segment against the others, nation by nation: small samples, exact p-values."""
    found = d.ks_groups(table(spark, folder, "customer"), "c_nationkey", "c_acctbal", F.col("c_mktsegment") == "BUILDING")
    return _round(found, ["ks_statistic", "p_value"])
