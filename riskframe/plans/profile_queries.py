"""Queries for schema, cleaning, sampling and profiling operators (B, C, D, E, F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import applications as A
from ..functions import labels as L
from ..operators import cleaning as C
from ..operators import profile as P
from ..operators import sampling as D
from ..operators import schema_ops as B
from . import inputs as I
from .catalog import register

APP_COLUMNS = ["app_id", "cust_id", "segment", "nation_key", "applied_at", "annual_inc", "loan_amnt",
               "emp_length", "home_ownership", "term", "purpose", "fico_range_low", "fico_range_high",
               "dti", "revol_util", "inq_last_6mths", "delinq_2yrs", "pub_rec", "loan_status"]
APP_TYPES = {"app_id": "bigint", "cust_id": "bigint", "segment": "string", "nation_key": "int",
             "applied_at": "timestamp_ntz", "annual_inc": "double", "loan_amnt": "double",
             "emp_length": "string", "home_ownership": "string", "term": "string", "purpose": "string",
             "fico_range_low": "int", "fico_range_high": "int", "dti": "double", "revol_util": "double",
             "inq_last_6mths": "int", "delinq_2yrs": "int", "pub_rec": "int", "loan_status": "string"}
APP_CATEGORICAL = ["segment", "emp_length", "home_ownership", "term", "purpose", "loan_status"]


def _q(c: str) -> str:
    return '"' + c.replace('"', '""') + '"'


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# --------------------------------------------------------------------------- F1

def _profile_sql() -> str:
    parts = []
    for c in APP_COLUMNS:
        parts.append(f"""SELECT '{c}' AS "column", '{APP_TYPES[c]}' AS dtype,
  count(*) FILTER (WHERE {c} IS NULL) AS nulls,
  round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 2) AS null_pct,
  count(DISTINCT {c}) AS n_distinct,
  CASE WHEN count(DISTINCT {c}) = 1 THEN 'drop_constant'
       WHEN count(DISTINCT {c}) = count(*) THEN 'drop_identifier' ELSE 'keep' END AS recommendation
FROM applications""")
    return I.with_ctes(I.APPLICATIONS_SQL) + _union(parts)


@register("profile_applications", _profile_sql())
def profile_applications(spark, sf_dir):
    return P.profile(I.applications(spark, sf_dir)).withColumnRenamed("distinct", "n_distinct")


# --------------------------------------------------------------------------- B7 missing shares

@register("missing_shares_applications", I.with_ctes(I.APPLICATIONS_SQL) + _union([
    f"""SELECT '{c}' AS "column", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_share,
  avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) >= 0.05 AS dropped FROM applications""" for c in APP_COLUMNS]))
def missing_shares_applications(spark, sf_dir):
    """B7 decision table: null share per column and whether drop_high_missing(0.05) drops it."""
    apps = I.applications(spark, sf_dir)
    kept, dropped = B.drop_high_missing(apps, threshold=0.05)
    shares = B.missing_shares(apps)
    return shares.select("column", F.round("null_share", 6).alias("null_share"),
                         F.col("column").isin(dropped).alias("dropped"))


# --------------------------------------------------------------------------- F2 / C6

DUP_COLS = ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity"]


@register("duplicate_stats_lines", I.with_ctes(I.LOAN_TABLE_SQL) + f"""
SELECT count(*) AS rows, CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(DUP_COLS)} FROM loan_table)) AS BIGINT) AS duplicate_rows,
       round((count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(DUP_COLS)} FROM loan_table))) * 100.0 / count(*), 2) AS duplicate_pct
FROM loan_table""")
def duplicate_stats_lines(spark, sf_dir):
    return P.duplicate_stats(I.loan_table(spark, sf_dir).select(*DUP_COLS))


@register("duplicate_rows_lines", I.with_ctes(I.LOAN_TABLE_SQL) + f"""
SELECT {', '.join(DUP_COLS)} FROM (
  SELECT {', '.join(DUP_COLS)}, row_number() OVER (PARTITION BY {', '.join(DUP_COLS)}) AS rn FROM loan_table)
WHERE rn > 1""")
def duplicate_rows_lines(spark, sf_dir):
    return C.duplicate_rows(I.loan_table(spark, sf_dir).select(*DUP_COLS))


# --------------------------------------------------------------------------- F3

CARD_DUP_EXTRA = {"limit_copy": "limit_bal", "sex_copy": "sex"}


def _cards_with_copies(spark, sf_dir):
    c = I.card_applications(spark, sf_dir)
    return c.withColumns({
        "limit_copy": F.col("limit_bal"),
        "sex_copy": F.col("sex"),
        "sex_long": F.col("sex").cast("long"),  # equal values, different dtype: not a duplicate
        "age_gap": F.when(F.col("app_id") % 97 == 0, F.lit(None)).otherwise(F.col("age")),
    })


CARDS_COPIES_SQL = """
cards AS (
  SELECT *, limit_bal AS limit_copy, sex AS sex_copy, CAST(sex AS BIGINT) AS sex_long,
         CASE WHEN app_id % 97 = 0 THEN NULL ELSE age END AS age_gap
  FROM card_applications
)"""
CARD_COLS = [("app_id", "bigint"), ("limit_bal", "double"), ("sex", "int"), ("marriage_new", "int"),
             ("age", "int"), ("pay_new", "int"), ("education_new", "int"), ("target", "int"),
             ("limit_copy", "double"), ("sex_copy", "int"), ("sex_long", "bigint"), ("age_gap", "int")]


def _dup_cols_sql() -> str:
    parts = []
    for i, (a, ta) in enumerate(CARD_COLS):
        for b, tb in CARD_COLS[i + 1:]:
            if ta == tb:
                parts.append(f"""SELECT '{a}' AS "left", '{b}' AS "right" FROM cards
HAVING bool_and({a} IS NOT DISTINCT FROM {b})""")
    return I.with_ctes(I.CARD_APPLICATIONS_SQL, CARDS_COPIES_SQL) + _union(parts)


@register("duplicate_columns_cards", _dup_cols_sql())
def duplicate_columns_cards(spark, sf_dir):
    return P.duplicate_columns(_cards_with_copies(spark, sf_dir))


# --------------------------------------------------------------------------- F5 / F6 / F13

@register("categorical_distribution_applications", I.with_ctes(I.APPLICATIONS_SQL) + _union([
    f"SELECT '{c}' AS feature, {c} AS value, count(*) AS count FROM applications WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in APP_CATEGORICAL]))
def categorical_distribution_applications(spark, sf_dir):
    return P.categorical_distribution(I.applications(spark, sf_dir), APP_CATEGORICAL)


LOAN_TARGET_SQL = """
CASE WHEN loan_status IS NULL THEN 1
     WHEN lower(trim(loan_status)) LIKE '%fully paid%' OR lower(trim(loan_status)) LIKE '%current%'
       OR lower(trim(loan_status)) LIKE '%good loan%' OR lower(trim(loan_status)) LIKE '%no default%'
       OR lower(trim(loan_status)) LIKE '%paid%' OR lower(trim(loan_status)) LIKE '%completed%' THEN 0
     WHEN lower(trim(loan_status)) LIKE '%charged off%' OR lower(trim(loan_status)) LIKE '%default%'
       OR lower(trim(loan_status)) LIKE '%late%' OR lower(trim(loan_status)) LIKE '%bad loan%'
       OR lower(trim(loan_status)) LIKE '%delinquent%' OR lower(trim(loan_status)) LIKE '%chargedoff%'
       OR lower(trim(loan_status)) LIKE '%defaulted%' THEN 1
     WHEN lower(trim(loan_status)) IN ('0', '0.0') THEN 0
     ELSE 1 END"""

LABELLED_SQL = f"""
labelled AS (
  SELECT *, CAST({LOAN_TARGET_SQL} AS INTEGER) AS target FROM applications
)"""


def labelled_applications(spark, sf_dir):
    apps = I.applications(spark, sf_dir)
    return apps.withColumn("target", L.loan_status_target(F.col("loan_status")))


VS_TARGET = ["segment", "home_ownership", "term", "purpose"]


@register("categorical_vs_target_applications", I.with_ctes(I.APPLICATIONS_SQL, LABELLED_SQL) + _union([
    f"SELECT '{c}' AS feature, {c} AS value, target, count(*) AS count FROM labelled "
    f"WHERE {c} IS NOT NULL GROUP BY {c}, target" for c in VS_TARGET]))
def categorical_vs_target_applications(spark, sf_dir):
    return P.categorical_vs_target(labelled_applications(spark, sf_dir), "target", VS_TARGET)


def _dist_sql(cols) -> str:
    return _union([f"SELECT '{c}' AS feature, {c} AS value, count(*) AS count FROM applications "
                   f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in cols])


@register("rare_categories_applications", I.with_ctes(I.APPLICATIONS_SQL) + f"""
SELECT feature, value, count, round(share, 6) AS share FROM (
  SELECT feature, value, count, count / sum(count) OVER (PARTITION BY feature) AS share
  FROM ({_dist_sql(APP_CATEGORICAL)}))
WHERE share < 0.05""")
def rare_categories_applications(spark, sf_dir):
    r = P.rare_categories(I.applications(spark, sf_dir), APP_CATEGORICAL, threshold=0.05)
    return r.withColumn("share", F.round("share", 6))


# --------------------------------------------------------------------------- F12

CROSS = ["segment", "home_ownership", "term"]


def _cross_sql() -> str:
    parts = [f"SELECT '{a}' AS var1, {a} AS cat1, '{b}' AS var2, {b} AS cat2, count(*) AS count FROM applications "
             f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY {a}, {b}"
             for i, a in enumerate(CROSS) for b in CROSS[i + 1:]]
    return I.with_ctes(I.APPLICATIONS_SQL) + _union(parts)


@register("crosstabs_applications", _cross_sql())
def crosstabs_applications(spark, sf_dir):
    return P.crosstabs(I.applications(spark, sf_dir), CROSS)


@register("crosstab_conclusions_applications", I.with_ctes(I.APPLICATIONS_SQL, "tabs AS (" + _union([
    f"SELECT '{a}' AS var1, {a} AS cat1, '{b}' AS var2, {b} AS cat2, count(*) AS count FROM applications "
    f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY {a}, {b}"
    for i, a in enumerate(CROSS) for b in CROSS[i + 1:]]) + ")") + """
SELECT var1, var2, CASE WHEN max(rm) = 1 AND max(cm) = 1 THEN '1:1' ELSE 'ambiguous' END AS conclusion
FROM (SELECT var1, var2, sum(count) OVER (PARTITION BY var1, var2, cat1) AS rm,
             sum(count) OVER (PARTITION BY var1, var2, cat2) AS cm FROM tabs)
GROUP BY var1, var2""")
def crosstab_conclusions_applications(spark, sf_dir):
    return P.crosstab_conclusions(P.crosstabs(I.applications(spark, sf_dir), CROSS))


# --------------------------------------------------------------------------- F14

DATES_SQL = """
dated AS (
  SELECT strftime(applied_at, '%d.%m.%Y') AS applied_text,
         CASE WHEN app_id % 3 = 0 THEN 'unknown' ELSE strftime(applied_at, '%-d.%-m.%Y') END AS mixed_text,
         segment
  FROM applications
)"""


@register("date_like_applications", I.with_ctes(I.APPLICATIONS_SQL, DATES_SQL) + _union([
    f"""SELECT '{c}' AS "column", avg(CASE WHEN {c} IS NOT NULL THEN
  CASE WHEN try_strptime({c}, '%d.%m.%Y') IS NOT NULL THEN 1.0 ELSE 0.0 END END) AS parse_share,
  coalesce(avg(CASE WHEN {c} IS NOT NULL THEN CASE WHEN try_strptime({c}, '%d.%m.%Y') IS NOT NULL THEN 1.0 ELSE 0.0 END END) > 0.8, false) AS is_date_like
FROM dated""" for c in ["applied_text", "mixed_text", "segment"]]))
def date_like_applications(spark, sf_dir):
    apps = I.applications(spark, sf_dir)
    dated = apps.select(
        F.date_format("applied_at", "dd.MM.yyyy").alias("applied_text"),
        F.when(F.col("app_id") % 3 == 0, "unknown").otherwise(F.date_format("applied_at", "d.M.yyyy")).alias("mixed_text"),
        "segment")
    return P.date_like_shares(dated, ["applied_text", "mixed_text", "segment"])


# --------------------------------------------------------------------------- D1–D5

SAMPLE_SQL = """
sampled AS (
  SELECT * EXCLUDE (rn, n) FROM (
    SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', CAST(app_id AS VARCHAR), '42'))) AS rn,
           count(*) OVER () AS n FROM applications)
  WHERE rn <= round_even(0.2 * n, 0)
)"""


@register("sample_exact_applications", I.with_ctes(I.APPLICATIONS_SQL, SAMPLE_SQL) +
          "SELECT app_id, segment, loan_amnt, loan_status FROM sampled")
def sample_exact_applications(spark, sf_dir):
    s = D.sample_exact(I.applications(spark, sf_dir), ["app_id"], 0.2, seed=42)
    return s.select("app_id", "segment", "loan_amnt", "loan_status")


SPLIT_SQL = """
split AS (
  SELECT *, CASE WHEN rn <= round_even(0.2 * n, 0) THEN 'test' ELSE 'train' END AS split FROM (
    SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5(concat_ws('|', CAST(app_id AS VARCHAR), '42'))) AS rn,
           count(*) OVER (PARTITION BY target) AS n FROM labelled)
)"""


@register("stratified_split_shares", I.with_ctes(I.APPLICATIONS_SQL, LABELLED_SQL, SPLIT_SQL) + """
SELECT split, count(*) AS rows, count(*) FILTER (WHERE target = 0) AS good, count(*) FILTER (WHERE target = 1) AS bad,
       round(count(*) FILTER (WHERE target = 0) * 100.0 / count(*), 4) AS good_pct,
       round(count(*) FILTER (WHERE target = 1) * 100.0 / count(*), 4) AS bad_pct
FROM split GROUP BY split""")
def stratified_split_shares(spark, sf_dir):
    s = D.stratified_split(labelled_applications(spark, sf_dir), ["app_id"], "target", 0.2, seed=42)
    return D.split_class_shares(s, "target")


@register("stratified_folds_sizes", I.with_ctes(I.APPLICATIONS_SQL, LABELLED_SQL) + """
SELECT CAST((rn - 1) % 5 AS INTEGER) AS fold, target, count(*) AS rows, sum(loan_amnt) > 0 AS nonempty FROM (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5(concat_ws('|', CAST(app_id AS VARCHAR), '7'))) AS rn
  FROM labelled)
GROUP BY ALL""")
def stratified_folds_sizes(spark, sf_dir):
    f = D.stratified_folds(labelled_applications(spark, sf_dir), ["app_id"], "target", k=5, seed=7)
    return f.groupBy("fold", "target").agg(F.count(F.lit(1)).alias("rows"),
                                           (F.sum("loan_amnt") > 0).alias("nonempty"))


# --------------------------------------------------------------------------- F16

REP_NUM = ["annual_inc", "loan_amnt", "dti", "revol_util", "fico_range_low"]
REP_CAT = ["segment", "home_ownership", "term", "purpose", "emp_length"]


def _rep_num_sql() -> str:
    parts = [f"""SELECT '{c}' AS "column", (SELECT avg({c}) FROM sampled) AS ma, (SELECT avg({c}) FROM applications) AS mb"""
             for c in REP_NUM]
    return I.with_ctes(I.APPLICATIONS_SQL, SAMPLE_SQL) + f"""
SELECT "column", round(ma, 4) AS mean_sample, round(mb, 4) AS mean_full, round(abs(ma - mb), 4) AS abs_diff,
       round(CASE WHEN ma <> 0 THEN abs(ma - mb) / abs(ma) * 100 END, 4) AS rel_diff_pct,
       CASE WHEN ma IS NULL OR ma = 0 THEN 'n/a'
            WHEN abs(ma - mb) / abs(ma) * 100 < 2 THEN 'good'
            WHEN abs(ma - mb) / abs(ma) * 100 < 5 THEN 'fair' ELSE 'alarming' END AS status
FROM ({_union(parts)})"""


@register("representativeness_numeric_applications", _rep_num_sql())
def representativeness_numeric_applications(spark, sf_dir):
    apps = I.applications(spark, sf_dir)
    sample = D.sample_exact(apps, ["app_id"], 0.2, seed=42)
    return P.representativeness_numeric(sample, apps, REP_NUM)


def _rep_cat_sql() -> str:
    sa = _union([f"SELECT '{c}' AS col, {c} AS value FROM sampled WHERE {c} IS NOT NULL" for c in REP_CAT])
    fb = _union([f"SELECT '{c}' AS col, {c} AS value FROM applications WHERE {c} IS NOT NULL" for c in REP_CAT])
    return I.with_ctes(I.APPLICATIONS_SQL, SAMPLE_SQL) + f"""
, a AS (SELECT col, value, count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY col) AS sa FROM ({sa}) GROUP BY col, value),
b AS (SELECT col, value, count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY col) AS sb FROM ({fb}) GROUP BY col, value),
j AS (SELECT coalesce(a.col, b.col) AS col, coalesce(sa, 0) AS sa, coalesce(sb, 0) AS sb
      FROM a FULL OUTER JOIN b ON a.col = b.col AND a.value = b.value)
SELECT col AS "column", round(avg(abs(sb - sa) * 100), 4) AS mean_diff_pct, count(*) AS categories,
       CASE WHEN avg(abs(sb - sa) * 100) < 1 THEN 'good' WHEN avg(abs(sb - sa) * 100) < 3 THEN 'fair'
            ELSE 'alarming' END AS status
FROM j GROUP BY col"""


@register("representativeness_categorical_applications", _rep_cat_sql())
def representativeness_categorical_applications(spark, sf_dir):
    apps = I.applications(spark, sf_dir)
    sample = D.sample_exact(apps, ["app_id"], 0.2, seed=42)
    return P.representativeness_categorical(sample, apps, REP_CAT)


# --------------------------------------------------------------------------- F17 / E9

@register("target_analysis_applications", I.with_ctes(I.APPLICATIONS_SQL, LABELLED_SQL) + """
SELECT count(*) AS total, count(*) FILTER (WHERE target = 0) AS good, count(*) FILTER (WHERE target = 1) AS bad,
       round(count(*) FILTER (WHERE target = 0) * 100.0 / count(*), 2) AS good_pct,
       round(count(*) FILTER (WHERE target = 1) * 100.0 / count(*), 2) AS bad_pct,
       CASE WHEN count(*) FILTER (WHERE target = 0) = 0 OR count(*) FILTER (WHERE target = 1) = 0
            THEN 'one class missing' END AS warning
FROM labelled""")
def target_analysis_applications(spark, sf_dir):
    return P.target_analysis(labelled_applications(spark, sf_dir), "target")


@register("loan_status_targets", I.with_ctes(I.APPLICATIONS_SQL) + f"""
SELECT loan_status, CAST({LOAN_TARGET_SQL} AS INTEGER) AS target,
       CAST(CASE WHEN lower(trim(loan_status)) LIKE '%fully paid%' OR lower(trim(loan_status)) LIKE '%current%'
                   OR lower(trim(loan_status)) LIKE '%good loan%' THEN 0 ELSE 1 END AS INTEGER) AS target_short,
       count(*) AS n
FROM applications GROUP BY ALL""")
def loan_status_targets(spark, sf_dir):
    apps = I.applications(spark, sf_dir)
    return apps.groupBy("loan_status",
                        L.loan_status_target(F.col("loan_status")).alias("target"),
                        L.loan_status_target_short(F.col("loan_status")).alias("target_short")).agg(
        F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------- E1 / E3 / E11

@register("imputed_applications", I.with_ctes(I.APPLICATIONS_SQL) + """
, stats AS (SELECT median(revol_util) AS m_revol, median(inq_last_6mths) AS m_inq, median(pub_rec) AS m_pub,
                   mode() WITHIN GROUP (ORDER BY emp_length) AS mode_emp, mode() WITHIN GROUP (ORDER BY loan_status) AS mode_status
            FROM applications)
SELECT app_id, coalesce(CAST(revol_util AS DOUBLE), m_revol) AS revol_util,
       coalesce(CAST(inq_last_6mths AS DOUBLE), m_inq) AS inq_last_6mths,
       coalesce(CAST(pub_rec AS DOUBLE), m_pub) AS pub_rec,
       coalesce(emp_length, mode_emp) AS emp_length, coalesce(loan_status, mode_status) AS loan_status
FROM applications, stats""")
def imputed_applications(spark, sf_dir):
    apps = I.applications(spark, sf_dir).select("app_id", "revol_util", "inq_last_6mths", "pub_rec",
                                                "emp_length", "loan_status")
    return C.impute(apps, ["revol_util", "inq_last_6mths", "pub_rec"], ["emp_length", "loan_status"])


@register("engineered_applications", I.with_ctes(I.APPLICATIONS_SQL) + """
SELECT app_id, (fico_range_low + fico_range_high) / 2 AS fico_avg,
       CASE WHEN annual_inc > 0 THEN round(loan_amnt / annual_inc, 9) ELSE 0.0 END AS loan_to_income_ratio,
       CAST(CASE WHEN coalesce(emp_length, 'n/a') = 'n/a' THEN 0
            WHEN contains(coalesce(emp_length, 'n/a'), '< 1 year') THEN 0
            WHEN contains(coalesce(emp_length, 'n/a'), '10+ years') THEN 10
            ELSE coalesce(TRY_CAST(regexp_extract(trim(coalesce(emp_length, 'n/a')), '^(\\S+)', 1) AS INTEGER), 0)
       END AS INTEGER) AS emp_length_numeric,
       coalesce(revol_util, 0.0) AS revol_util, coalesce(inq_last_6mths, 0) AS inq_last_6mths,
       coalesce(delinq_2yrs, 0) AS delinq_2yrs, coalesce(pub_rec, 0) AS pub_rec
FROM applications""")
def engineered_applications(spark, sf_dir):
    apps = A.fill_defaults(I.applications(spark, sf_dir))
    e = A.engineered_features()
    return apps.select("app_id", e["fico_avg"].alias("fico_avg"),
                       F.round(e["loan_to_income_ratio"], 9).alias("loan_to_income_ratio"),
                       e["emp_length_numeric"].alias("emp_length_numeric"),
                       "revol_util", "inq_last_6mths", "delinq_2yrs", "pub_rec")


# --------------------------------------------------------------------------- C4b / E7 / E8 / B10 / B4 / B5

CARD_RULES_SQL = """
CASE WHEN NOT coalesce(limit_bal BETWEEN 10000 AND 1000000, false) THEN 'limit_bal must be between 10000 and 1000000'
     WHEN NOT coalesce(sex IN (1, 2), false) THEN 'sex must be 1 or 2'
     WHEN NOT coalesce(marriage_new IN (0, 1, 2, 3), false) THEN 'marriage_new must be between 0 and 3'
     WHEN NOT coalesce(age BETWEEN 21 AND 79, false) THEN 'age must be between 21 and 79'
     WHEN NOT coalesce(pay_new IN (-1, 0, 1), false) THEN 'pay_new must be -1, 0 or 1'
     WHEN NOT coalesce(education_new IN (1, 2, 3, 4), false) THEN 'education_new must be between 1 and 4'
END"""


@register("card_validation_counts", I.with_ctes(I.CARD_APPLICATIONS_SQL) + f"""
SELECT {CARD_RULES_SQL} AS rejection, count(*) AS n FROM card_applications GROUP BY 1""")
def card_validation_counts(spark, sf_dir):
    from ..operators.scoring import validate_card_applications
    v = validate_card_applications(I.card_applications(spark, sf_dir))
    return v.groupBy("rejection").agg(F.count(F.lit(1)).alias("n"))


RAW_CARDS_SQL = """
raw_cards AS (
  SELECT app_id AS "ID", limit_bal AS "LIMIT_BAL", sex AS "SEX", education_new + 2 AS "EDUCATION",
         marriage_new AS "MARRIAGE", age AS "AGE", pay_new AS "PAY_0",
         CAST(app_id % 5 - 2 AS INTEGER) AS "PAY_2", CASE WHEN app_id % 7 = 0 THEN NULL ELSE CAST(app_id % 4 - 2 AS INTEGER) END AS "PAY_3",
         target AS "default.payment.next.month"
  FROM card_applications
)"""


def _raw_cards(spark, sf_dir):
    c = I.card_applications(spark, sf_dir)
    return c.select(F.col("app_id").alias("ID"), F.col("limit_bal").alias("LIMIT_BAL"), F.col("sex").alias("SEX"),
                    (F.col("education_new") + 2).alias("EDUCATION"), F.col("marriage_new").alias("MARRIAGE"),
                    F.col("age").alias("AGE"), F.col("pay_new").alias("PAY_0"),
                    (F.col("app_id") % 5 - 2).cast("int").alias("PAY_2"),
                    F.when(F.col("app_id") % 7 == 0, F.lit(None)).otherwise((F.col("app_id") % 4 - 2).cast("int")).alias("PAY_3"),
                    F.col("target").alias("default.payment.next.month"))


@register("card_model_frame", I.with_ctes(I.CARD_APPLICATIONS_SQL, RAW_CARDS_SQL) + """
SELECT "LIMIT_BAL" AS limit_bal, CAST(CAST("SEX" AS INTEGER) AS VARCHAR) AS sex,
       CAST(CAST(CASE WHEN "MARRIAGE" >= 3 THEN 3 ELSE "MARRIAGE" END AS INTEGER) AS VARCHAR) AS marriage_new,
       "AGE" AS age,
       CAST(CASE WHEN coalesce("PAY_0" > 0, false) OR coalesce("PAY_2" > 0, false) OR coalesce("PAY_3" > 0, false) THEN 1
                 WHEN coalesce("PAY_0" = 0, false) OR coalesce("PAY_2" = 0, false) OR coalesce("PAY_3" = 0, false) THEN 0
                 ELSE -1 END AS VARCHAR) AS pay_new,
       CAST(CAST(CASE WHEN "EDUCATION" >= 4 THEN 4 ELSE "EDUCATION" END AS INTEGER) AS VARCHAR) AS education_new,
       CAST(CASE WHEN "EDUCATION" IN (1, 2, 3, 4) THEN "EDUCATION" ELSE 0 END AS INTEGER) AS education_code,
       CAST(CASE WHEN "MARRIAGE" IN (0, 1, 2, 3) THEN "MARRIAGE" ELSE 0 END AS INTEGER) AS marriage_code,
       "default.payment.next.month" AS target
FROM raw_cards""")
def card_model_frame(spark, sf_dir):
    """Raw card table → normalised names → recodes (E7a caps, E7b maps, E8a pay
    status) → six application features (B4) → text codes (B10)."""
    raw = _raw_cards(spark, sf_dir)
    df = B.normalize_column_names(raw)          # default.payment.next.month -> default_payment_next_month
    pay = [c for c in L.PAY_COLUMNS if c in df.columns]
    df = df.withColumns({
        "education_new": L.cap(F.col("education"), 4),
        "marriage_new": L.cap(F.col("marriage"), 3),
        "pay_new": L.pay_status(pay),
        "education_code": L.education_code(F.col("education")),
        "marriage_code": L.marriage_code(F.col("marriage")),
        "target": F.col("default_payment_next_month"),
    })
    feats = B.select_features(df, B.APPLICATION_FEATURES + ["education_code", "marriage_code"], "target")
    return B.categoricals_to_string(feats)


# --------------------------------------------------------------------------- E4 / E5 / E14

SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "tax_gap"]


@register("standard_scaled_lines", I.with_ctes(I.LOAN_TABLE_SQL) + """
, s AS (SELECT """ + ", ".join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}" for c in SCALE_COLS) + """ FROM loan_table)
SELECT l_orderkey, l_linenumber, l_partkey, """ + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in SCALE_COLS) + """
FROM loan_table, s""")
def standard_scaled_lines(spark, sf_dir):
    lt = I.loan_table(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", *SCALE_COLS)
    s = C.standard_scale(lt, SCALE_COLS)
    return s.select("l_orderkey", "l_linenumber", "l_partkey", *[F.round(c, 6).alias(c) for c in SCALE_COLS])


@register("one_hot_applications", I.with_ctes(I.APPLICATIONS_SQL) + """
SELECT app_id, """ + ", ".join(
    [f"CASE WHEN term = '{v}' THEN 1.0 ELSE 0.0 END AS \"term_{v}\"" for v in ["36 months", "60 months"]]
    + [f"CASE WHEN home_ownership = '{v}' THEN 1.0 ELSE 0.0 END AS \"home_ownership_{v}\""
       for v in ["MORTGAGE", "OTHER", "OWN", "RENT"]]) + " FROM applications")
def one_hot_applications(spark, sf_dir):
    apps = I.applications(spark, sf_dir).select("app_id", "term", "home_ownership")
    return C.one_hot_drop_first(apps, ["term", "home_ownership"]).drop("term", "home_ownership")


@register("class_weights_cards", I.with_ctes(I.CARD_APPLICATIONS_SQL) + """
SELECT target, count(*) AS n, round((SELECT count(*) FROM card_applications) / (2.0 * count(*)), 9) AS weight,
       round((SELECT count(*) FILTER (WHERE target = 0) FROM card_applications) * 1.0 /
             (SELECT count(*) FILTER (WHERE target = 1) FROM card_applications), 9) AS ratio
FROM card_applications GROUP BY target""")
def class_weights_cards(spark, sf_dir):
    w = C.class_weights(I.card_applications(spark, sf_dir), "target")
    return w.select("target", "n", F.round("weight", 9).alias("weight"), F.round("ratio", 9).alias("ratio"))
