"""Queries for numeric statistics, association and data quality (F7–F11, F15, G, I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import correlation as C
from ..operators import phik as P
from ..operators import stats as S
from . import inputs as I
from .catalog import register
from .profile_queries import (LABELLED_SQL, RAW_CARDS_SQL, _raw_cards, _union, labelled_applications)

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "tax_gap"]


def _r(c, d=6):
    return F.round(c, d).alias(c)


# --------------------------------------------------------------------------- F7

def _summary_sql() -> str:
    parts = []
    for c in NUM:
        parts.append(f"""SELECT '{c}' AS "column", avg({c}) AS mean, quantile_cont({c}, 0.5) AS median,
  quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.75) AS p75, quantile_cont({c}, 0.99) AS p99,
  (SELECT avg(power(x - m, 3)) / power(avg(power(x - m, 2)), 1.5)
     FROM (SELECT {c} AS x, avg({c}) OVER () AS m FROM loan_table WHERE {c} IS NOT NULL)) AS skew,
  kurtosis_pop({c}) AS kurtosis, count(DISTINCT {c}) AS nd
FROM loan_table""")
    return I.with_ctes(I.LOAN_TABLE_SQL) + f"""
SELECT "column", round(mean, 9) AS mean, round(median, 9) AS median, round(p25, 9) AS p25, round(p75, 9) AS p75,
       round(p99, 9) AS p99, round(skew, 9) AS skew, round(kurtosis, 9) AS kurtosis,
       '[' || CAST(round(p25, 9) AS VARCHAR) || ', ' || CAST(round(p75, 9) AS VARCHAR) || ']' AS iqr,
       CASE WHEN skew BETWEEN -0.5 AND 0.5 THEN 'normal' WHEN skew > 0.5 THEN 'right-skewed' ELSE 'left-skewed' END AS shape
FROM ({_union(parts)}) WHERE nd > 1"""


@register("numeric_summary_lines", _summary_sql())
def numeric_summary_lines(spark, sf_dir):
    return S.numeric_summary(I.loan_table(spark, sf_dir), NUM, digits=9)


# --------------------------------------------------------------------------- F9

HIST = ["l_quantity", "l_extendedprice", "l_discount"]


def _hist_sql() -> str:
    vals = _union([f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM loan_table WHERE {c} IS NOT NULL" for c in HIST])
    return I.with_ctes(I.LOAN_TABLE_SQL) + f"""
, vals AS ({vals}),
b AS (SELECT col, min(v) AS lo, max(v) AS hi, avg(v) AS mean, stddev_pop(v) AS std, count(*) AS n FROM vals GROUP BY col),
c AS (SELECT vals.col, CAST(CASE WHEN hi - lo = 0 THEN 1 ELSE least(floor((v - lo) / (hi - lo) * 30) + 1, 30) END AS INTEGER) AS bin,
             count(*) AS count FROM vals JOIN b ON vals.col = b.col GROUP BY ALL)
SELECT c.col AS "column", bin, round(lo + (bin - 1) * (hi - lo) / 30, 6) AS lower,
       round(lo + (bin - 1) * (hi - lo) / 30 + (hi - lo) / 30, 6) AS upper, count,
       round(CASE WHEN std > 0 THEN exp(-0.5 * power(((lo + (bin - 1) * (hi - lo) / 30 + (hi - lo) / 30 / 2) - mean) / std, 2))
             / (std * sqrt(2 * pi())) * n * (hi - lo) / 30 END, 6) AS normal_expected
FROM c JOIN b ON c.col = b.col"""


@register("histogram_lines", _hist_sql())
def histogram_lines(spark, sf_dir):
    h = S.histogram(I.loan_table(spark, sf_dir), HIST, bins=30)
    return h.select("column", "bin", _r("lower"), _r("upper"), "count", _r("normal_expected"))


# --------------------------------------------------------------------------- F10 / F11

@register("outliers_iqr_events", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT 'value' AS "column", value, round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper
FROM events, q WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def outliers_iqr_events(spark, sf_dir):
    o = S.outliers_iqr(I.table(spark, sf_dir, "events"), ["value"])
    return o.select("column", "value", _r("lower"), _r("upper"))


@register("outliers_zscore_events", """
WITH m AS (SELECT avg(value) AS mean, stddev_pop(value) AS std FROM events)
SELECT 'value' AS "column", value, round((value - mean) / std, 6) AS z
FROM events, m WHERE std > 0 AND abs((value - mean) / std) > 3""")
def outliers_zscore_events(spark, sf_dir):
    o = S.outliers_zscore(I.table(spark, sf_dir, "events"), ["value"])
    return o.select("column", "value", _r("z"))


# --------------------------------------------------------------------------- F15

PAIRS = ["l_quantity", "l_discount", "l_tax"]


def _pair_sql() -> str:
    def b(c):
        return (f"CAST(least(floor(({c} - (SELECT min({c}) FROM loan_table)) / "
                f"((SELECT max({c}) FROM loan_table) - (SELECT min({c}) FROM loan_table)) * 10) + 1, 10) AS INTEGER)")
    parts = [f"SELECT '{x}' AS var1, '{y}' AS var2, {b(x)} AS bin1, {b(y)} AS bin2, count(*) AS count "
             f"FROM loan_table WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY ALL"
             for i, x in enumerate(PAIRS) for y in PAIRS[i + 1:]]
    return I.with_ctes(I.LOAN_TABLE_SQL) + _union(parts)


@register("pair_density_lines", _pair_sql())
def pair_density_lines(spark, sf_dir):
    return S.pair_density(I.loan_table(spark, sf_dir), PAIRS, bins=10)


# --------------------------------------------------------------------------- G1 / G2 / G8

#: every numeric column of the loan table
CORR = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "tax_gap", "net_price", "target"]


def _corr_sql() -> str:
    ranks = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r_{c}" for c in CORR)
    parts = [f"SELECT '{a}' AS var1, '{b}' AS var2, abs(corr({a}, {b})) AS p, abs(corr(r_{a}, r_{b})) AS s FROM ranked"
             for i, a in enumerate(CORR) for b in CORR[i + 1:]]

    def lab(x):
        return (f"CASE WHEN {x} < 0.1 THEN 'very weak' WHEN {x} < 0.3 THEN 'weak' WHEN {x} < 0.5 THEN 'moderate' "
                f"WHEN {x} < 0.7 THEN 'noticeable' WHEN {x} < 0.9 THEN 'high' WHEN {x} < 1.0 THEN 'very high' ELSE 'perfect' END")
    return I.with_ctes(I.LOAN_TABLE_SQL) + f"""
, cc AS (SELECT {', '.join(CORR)} FROM loan_table WHERE {' AND '.join(c + ' IS NOT NULL' for c in CORR)}),
ranked AS (SELECT *, {ranks} FROM cc)
SELECT var1, var2, round(p, 2) AS pearson, {lab('round(p, 12)')} AS pearson_label, round(s, 2) AS spearman, {lab('round(s, 12)')} AS spearman_label
FROM ({_union(parts)}) WHERE round(p, 2) >= 0.5 OR round(s, 2) >= 0.5"""


@register("correlations_lines", _corr_sql())
def correlations_lines(spark, sf_dir):
    return S.correlations(I.loan_table(spark, sf_dir), methods=("pearson", "spearman"), threshold=0.5)


@register("high_correlation_pairs_lines", I.with_ctes(I.LOAN_TABLE_SQL) + _union([
    f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 6) AS r FROM loan_table HAVING abs(corr({a}, {b})) > 0.95"
    for i, a in enumerate(CORR) for b in CORR[i + 1:]]))
def high_correlation_pairs_lines(spark, sf_dir):
    h = S.high_correlation_pairs(I.loan_table(spark, sf_dir), threshold=0.95)
    return h.select("var1", "var2", _r("r"))


def _kendall_frame(spark, sf_dir):
    """Orders' totals in thousands, priority and week as numbers: many ties."""
    o = I.table(spark, sf_dir, "orders")
    return o.select(F.floor(F.col("o_totalprice") / 1000).alias("total"), F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
                    F.floor(F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")) / 7).alias("week"))


@register("kendall_orders", """
WITH o AS (SELECT CAST(floor(o_totalprice / 1000) AS BIGINT) AS total, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority,
                  CAST(floor(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) / 7.0) AS BIGINT) AS week FROM orders),
l AS (""" + _union([f"SELECT '{x}' AS var1, 'total' AS var2, {x} AS x, total AS y FROM o" for x in ("priority", "week")]) + """),
c AS (SELECT var1, var2, x, y, count(*) AS n FROM l GROUP BY ALL),
p AS (SELECT a.var1, a.var2, sum(a.n * b.n) FILTER (WHERE a.x < b.x AND a.y < b.y) AS concordant,
             sum(a.n * b.n) FILTER (WHERE a.x < b.x AND a.y > b.y) AS discordant FROM c a JOIN c b ON a.var1 = b.var1 GROUP BY ALL),
tx AS (SELECT var1, sum(n * (n - 1) / 2) AS t FROM (SELECT var1, x, sum(n) AS n FROM c GROUP BY ALL) GROUP BY 1),
ty AS (SELECT var1, sum(n * (n - 1) / 2) AS t FROM (SELECT var1, y, sum(n) AS n FROM c GROUP BY ALL) GROUP BY 1),
s AS (SELECT var1, sum(n) AS n FROM c GROUP BY 1)
SELECT p.var1, p.var2, round((concordant - discordant) / sqrt((n * (n - 1) / 2.0 - tx.t) * (n * (n - 1) / 2.0 - ty.t)), 6) AS tau_b,
       CAST(n AS BIGINT) AS n, CAST(concordant AS BIGINT) AS concordant, CAST(discordant AS BIGINT) AS discordant
FROM p JOIN tx ON p.var1 = tx.var1 JOIN ty ON p.var1 = ty.var1 JOIN s ON p.var1 = s.var1""")
def kendall_orders(spark, sf_dir):
    """G3 of priority and week against the total of an order."""
    o = _kendall_frame(spark, sf_dir)
    both = [C.kendall_tau_b(o, x, "total", 6).select(F.lit(x).alias("var1"), F.lit("total").alias("var2"), "tau_b", "n",
                                                     F.col("concordant").cast("long").alias("concordant"), F.col("discordant").cast("long").alias("discordant"))
            for x in ("priority", "week")]
    return both[0].unionByName(both[1])


# --------------------------------------------------------------------------- G4 / G5

CHI_PAIRS = [("segment", "purpose"), ("short_term", "target_text"), ("home_ownership", "term")]


def _chi_frame(spark, sf_dir):
    a = labelled_applications(spark, sf_dir)
    return a.withColumns({"short_term": F.when(F.col("term") == "36 months", "yes").otherwise("no"),
                          "target_text": F.col("target").cast("string")})


def _chi_sql() -> str:
    parts = [f"SELECT '{a}' AS var1, '{b}' AS var2, CAST({a} AS VARCHAR) AS cat1, CAST({b} AS VARCHAR) AS cat2, count(*) AS o "
             f"FROM chi WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL" for a, b in CHI_PAIRS]
    return I.with_ctes(I.APPLICATIONS_SQL, LABELLED_SQL) + f"""
, chi AS (SELECT *, CASE WHEN term = '36 months' THEN 'yes' ELSE 'no' END AS short_term,
                 CAST(target AS VARCHAR) AS target_text FROM labelled),
cnt AS ({_union(parts)}),
rm AS (SELECT var1, var2, cat1, sum(o) AS r FROM cnt GROUP BY ALL),
cm AS (SELECT var1, var2, cat2, sum(o) AS c FROM cnt GROUP BY ALL),
dims AS (SELECT var1, var2, sum(o) AS n, count(DISTINCT cat1) AS rows, count(DISTINCT cat2) AS cols FROM cnt GROUP BY ALL),
grid AS (SELECT rm.var1, rm.var2, rm.cat1, cm.cat2, r * c * 1.0 / n AS e, coalesce(o, 0) AS o, rows, cols, n
         FROM rm JOIN cm ON rm.var1 = cm.var1 AND rm.var2 = cm.var2 JOIN dims ON rm.var1 = dims.var1 AND rm.var2 = dims.var2
         LEFT JOIN cnt ON cnt.var1 = rm.var1 AND cnt.var2 = rm.var2 AND cnt.cat1 = rm.cat1 AND cnt.cat2 = cm.cat2),
chi2 AS (SELECT var1, var2, any_value(n) AS n, any_value(rows) AS rows, any_value(cols) AS cols,
                CASE WHEN any_value(rows) = 2 AND any_value(cols) = 2
                     THEN sum(power(abs(o - e) - least(0.5, abs(o - e)), 2) / e)
                     ELSE sum(power(o - e, 2) / e) END AS chi2
         FROM grid GROUP BY var1, var2)
SELECT var1, var2, round(chi2, 6) AS chi2, CAST(n AS BIGINT) AS n, rows, cols,
       round(CASE WHEN rows = 2 AND cols = 2 THEN sqrt(chi2 / n) END, 6) AS phi,
       round(CASE WHEN least(rows, cols) - 1 > 0 THEN sqrt(chi2 / (n * (least(rows, cols) - 1))) END, 6) AS cramers_v
FROM chi2"""


@register("chi2_applications", _chi_sql())
def chi2_applications(spark, sf_dir):
    t = S.chi2_tables(S.contingency(_chi_frame(spark, sf_dir), CHI_PAIRS))
    return t.select("var1", "var2", _r("chi2"), "n", "rows", "cols", _r("phi"), _r("cramers_v"))


# --------------------------------------------------------------------------- G6

ANOVA_COLS = ["loan_amnt", "dti", "annual_inc"]


@register("anova_f_applications", I.with_ctes(I.APPLICATIONS_SQL) + f"""
, long AS ({_union([f"SELECT '{c}' AS col, segment AS g, {c} AS v FROM applications WHERE {c} IS NOT NULL AND segment IS NOT NULL" for c in ANOVA_COLS])}),
grp AS (SELECT col, g, count(*) AS n, avg(v) AS m, var_pop(v) AS vv FROM long GROUP BY col, g),
gm AS (SELECT col, avg(v) AS gm FROM long GROUP BY col)
SELECT grp.col AS "column",
       round((sum(n * power(m - gm, 2)) / (count(*) - 1)) / (sum(n * vv) / (sum(n) - count(*))), 6) AS f_statistic
FROM grp JOIN gm ON grp.col = gm.col GROUP BY grp.col HAVING count(*) > 1""")
def anova_f_applications(spark, sf_dir):
    """G6 F statistic of loan amount / dti / income across market segments."""
    a = S.anova(I.applications(spark, sf_dir), "segment", ANOVA_COLS)
    return a.select("column", _r("f_statistic"))


@register("anova_applications")
def anova_applications(spark, sf_dir):
    """G6 with p-values (F distribution tail; no SQL counterpart)."""
    return S.anova(I.applications(spark, sf_dir), "segment", ANOVA_COLS, digits=2)


# --------------------------------------------------------------------------- I1–I9

QCOLS = ["app_id", "annual_inc", "loan_amnt", "dti", "revol_util", "inq_last_6mths", "pub_rec", "emp_length", "segment"]


@register("check_missing_applications", I.with_ctes(I.APPLICATIONS_SQL) + _union([
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS missing,
  round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 2) AS missing_pct,
  count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) > 10 AS critical FROM applications""" for c in QCOLS]))
def check_missing_applications(spark, sf_dir):
    return Q.check_missing(I.applications(spark, sf_dir).select(*QCOLS))


EV_NUM = ["value", "user_id"]


@register("check_outliers_events", "WITH m AS (" + _union([
    f"SELECT '{c}' AS col, avg({c}) AS mean, stddev_pop({c}) AS std FROM events" for c in EV_NUM]) + "), long AS (" + _union([
    f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM events WHERE {c} IS NOT NULL" for c in EV_NUM]) + """)
SELECT long.col AS "column", count(*) FILTER (WHERE abs((v - mean) / std) > 3) AS outliers,
       round(count(*) FILTER (WHERE abs((v - mean) / std) > 3) * 100.0 / count(*), 2) AS outlier_pct,
       round(avg(abs((v - mean) / std)), 2) AS mean_abs_z, round(max(abs((v - mean) / std)), 2) AS max_abs_z,
       count(*) FILTER (WHERE abs((v - mean) / std) > 3) * 100.0 / count(*) > 5 AS critical
FROM long JOIN m ON long.col = m.col GROUP BY long.col""")
def check_outliers_events(spark, sf_dir):
    return Q.check_outliers(I.table(spark, sf_dir, "events"), EV_NUM)


def _dist_sql() -> str:
    parts = [f"""SELECT '{c}' AS col, count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS mn, max({c}) AS mx,
  (SELECT avg(power(x - m, 3)) / power(avg(power(x - m, 2)), 1.5) FROM (SELECT {c} AS x, avg({c}) OVER () AS m FROM loan_table WHERE {c} IS NOT NULL)) AS skew,
  kurtosis_pop({c}) AS kurt, var_samp({c}) AS var FROM loan_table""" for c in NUM]
    return I.with_ctes(I.LOAN_TABLE_SQL) + f"""
SELECT col AS "column", round(mean, 4) AS mean, round(std, 4) AS std, round(mn, 4) AS min, round(mx, 4) AS max,
       round(skew, 4) AS skewness, round(kurt, 4) AS kurtosis, round(var, 4) AS variance,
       coalesce(abs(round(skew, 4)) > 2, false) AS high_skew, coalesce(abs(round(kurt, 4)) > 3, false) AS high_kurtosis,
       coalesce(round(var, 4) < 0.01, false) AS low_variance
FROM ({_union(parts)}) WHERE n > 10"""


@register("check_distribution_lines", _dist_sql())
def check_distribution_lines(spark, sf_dir):
    return Q.check_distribution(I.loan_table(spark, sf_dir), NUM)


CAT = ["segment", "emp_length", "home_ownership", "term", "loan_status"]


@register("check_categorical_applications", I.with_ctes(I.APPLICATIONS_SQL) + _union([
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct, round(count(DISTINCT {c}) * 1.0 / count(*), 4) AS unique_ratio,
  (SELECT {c} FROM applications WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS most_common,
  (SELECT count(*) FROM applications WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS most_common_count,
  count(DISTINCT {c}) * 1.0 / count(*) > 0.5 AS high_cardinality, count(DISTINCT {c}) * 1.0 / count(*) < 0.1 AS low_cardinality
FROM applications""" for c in CAT]))
def check_categorical_applications(spark, sf_dir):
    return Q.check_categorical(I.applications(spark, sf_dir), CAT)


@register("constant_columns_cards", I.with_ctes(I.CARD_APPLICATIONS_SQL) + """
, c AS (SELECT *, 1 AS one, CAST(NULL AS VARCHAR) AS nothing FROM card_applications)
""" + _union([f"""SELECT '{c}' AS "column" FROM c HAVING count(DISTINCT {c}) <= 1"""
              for c in ["app_id", "limit_bal", "sex", "age", "target", "one", "nothing"]]))
def constant_columns_cards(spark, sf_dir):
    c = I.card_applications(spark, sf_dir).select("app_id", "limit_bal", "sex", "age", "target").withColumns(
        {"one": F.lit(1), "nothing": F.lit(None).cast("string")})
    return Q.constant_columns(c)


@register("quality_report_cards")
def quality_report_cards(spark, sf_dir):
    """I6 report row over the card table (score, criticals, duplicates, constants)."""
    return Q.quality_report(I.card_applications(spark, sf_dir))


@register("integrity_cards")
def integrity_cards(spark, sf_dir):
    """I4 summary row over the card table."""
    return Q.check_integrity(I.card_applications(spark, sf_dir))


SUITE_SQL_ROWS = [
    (0, "expect_column_to_exist", "LIMIT_BAL", None),
    (1, "expect_column_to_exist", "AGE", None),
    (2, "expect_column_to_exist", "target", None),
    (3, "expect_column_values_to_not_be_null", "LIMIT_BAL", '"LIMIT_BAL" IS NULL'),
    (4, "expect_column_values_to_not_be_null", "target", "target IS NULL"),
    (5, "expect_column_values_to_be_between", "AGE", '"AGE" IS NOT NULL AND ("AGE" < 18 OR "AGE" > 100)'),
    (6, "expect_column_values_to_be_between", "LIMIT_BAL", '"LIMIT_BAL" IS NOT NULL AND ("LIMIT_BAL" < 0 OR "LIMIT_BAL" > 1000000)'),
    (7, "expect_column_values_to_be_in_set", "target", "target IS NOT NULL AND target NOT IN (0, 1)"),
    (8, "expect_column_values_to_be_in_set", "SEX", '"SEX" IS NOT NULL AND "SEX" NOT IN (1, 2)'),
]


def _suite_union() -> str:
    parts = []
    for i, t, c, cond in SUITE_SQL_ROWS:
        if cond is None:
            parts.append(f"SELECT {i} AS idx, '{t}' AS expectation_type, '{c}' AS \"column\", true AS success, "
                         f"CAST(0 AS BIGINT) AS unexpected_count, CAST(NULL AS VARCHAR) AS message")
        else:
            n = f"(SELECT count(*) FROM cards WHERE {cond})"
            parts.append(f"SELECT {i}, '{t}', '{c}', {n} = 0, {n}, CASE WHEN {n} = 0 THEN NULL ELSE "
                         f"'{t} failed for {c}: ' || CAST({n} AS VARCHAR) || ' unexpected values' END")
    return _union(parts)


CARDS_SUITE_SQL = I.with_ctes(I.CARD_APPLICATIONS_SQL, RAW_CARDS_SQL) + \
    ', cards AS (SELECT *, "default.payment.next.month" AS target FROM raw_cards)\n'


def _suite_sql() -> str:
    return CARDS_SUITE_SQL + "SELECT CAST(idx AS INTEGER) AS idx, expectation_type, \"column\", success, " \
        "unexpected_count, message FROM (" + _suite_union() + ")"


def _cards_for_suite(spark, sf_dir):
    raw = _raw_cards(spark, sf_dir)
    return raw.withColumn("target", F.col("`default.payment.next.month`"))


@register("expectations_cards", _suite_sql())
def expectations_cards(spark, sf_dir):
    """The reference's card expectation suite, all value checks in one aggregate."""
    return Q.run_expectations(_cards_for_suite(spark, sf_dir))


@register("expectation_report_cards", CARDS_SUITE_SQL + """
SELECT bool_and(success) AS success, count(*) AS evaluated, count(*) FILTER (WHERE success) AS successful,
       count(*) FILTER (WHERE NOT success) AS unsuccessful
FROM (""" + _suite_union() + ") t(idx, expectation_type, col, success, unexpected_count, message)")
def expectation_report_cards(spark, sf_dir):
    """I8 summary (the failed list is checked by the unit tests)."""
    return Q.expectation_report(Q.run_expectations(_cards_for_suite(spark, sf_dir))).drop("failed")


# --------------------------------------------------------------------------- F8

KDE_COLS = ["l_quantity", "l_discount"]


@register("kde_peak_lines", I.with_ctes(I.LOAN_TABLE_SQL) + f"""
, v AS ({_union([f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS x FROM loan_table WHERE {c} IS NOT NULL" for c in KDE_COLS])}),
st AS (SELECT col, count(*) AS n, stddev_samp(x) AS sd, min(x) AS lo, max(x) AS hi FROM v GROUP BY col),
c AS (SELECT col, x, count(*) AS cnt FROM v GROUP BY ALL),
g AS (SELECT st.*, lo + i * (hi - lo) / 999 AS gx, sd * pow(n, -0.2) AS h FROM st, range(0, 1000) r(i)
      WHERE n > 1 AND sd > 0 AND hi > lo),
d AS (SELECT g.col, g.gx, sum(cnt * exp(-0.5 * pow((g.gx - c.x) / g.h, 2))) / (g.n * g.h * sqrt(2 * pi())) AS dens
      FROM g JOIN c ON g.col = c.col WHERE abs(g.gx - c.x) <= 8 * g.h GROUP BY g.col, g.gx, g.n, g.h)
SELECT col AS "column", round(arg_max(gx, dens), 6) AS peak, round(max(dens), 6) AS peak_density FROM d GROUP BY col""")
def kde_peak_lines(spark, sf_dir):
    """F8: KDE mode of quantity and discount (exact: values compressed to counts)."""
    k = S.kde_peak(I.loan_table(spark, sf_dir), KDE_COLS, bins=None)
    return k.select("column", _r("peak"), _r("peak_density"))


# --------------------------------------------------------------------------- G7

@register("phik_lines")
def phik_lines(spark, sf_dir):
    """phi_K of all column pairs of the loan table."""
    return P.phik_matrix(I.loan_table(spark, sf_dir)).select("var1", "var2", "rows", "levels1", "levels2", _r("phi_k", 4))


@register("phik_applications")
def phik_applications(spark, sf_dir):
    """Pairs of application columns with phi_K of 0.5 or more, with their label."""
    return P.phik(labelled_applications(spark, sf_dir))
