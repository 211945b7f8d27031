"""Column expressions for loan / card applications (no Spark job by themselves).

Rules, defaults, engineered features and score labels for the 13-field
loan application and the 6-field card application.  Every function
returns ``Column`` objects, so callers compose them into one projection
that stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.core import col

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
EMP_LENGTH_VALUES = ["< 1 year", "1 year", "2 years", "3 years", "4 years", "5 years",
                     "6 years", "7 years", "8 years", "9 years", "10+ years", "n/a"]
HOME_OWNERSHIP_VALUES = ["RENT", "OWN", "MORTGAGE", "OTHER"]
TERM_VALUES = ["36 months", "60 months"]
# missing-value defaults applied before scoring
APPLICATION_DEFAULTS = {"revol_util": 0.0, "inq_last_6mths": 0, "delinq_2yrs": 0,
                        "pub_rec": 0, "emp_length": "n/a"}
# column order the model expects; absent ones are added as 0
MODEL_COLUMNS = ["annual_inc", "loan_amnt", "fico_range_low", "fico_range_high", "dti",
                 "revol_util", "inq_last_6mths", "delinq_2yrs", "pub_rec"]
# scorecard points
SCORECARD_HOME_POINTS = {"OWN": 10, "MORTGAGE": 8, "RENT": 5, "OTHER": 3}
SCORECARD_IMPORTANCE = {"fico_score": 0.3, "dti": 0.2, "revol_util": 0.15, "emp_length": 0.15,
                        "home_ownership": 0.1, "inq_last_6mths": 0.05, "delinq_2yrs": 0.05}
CARD_IMPORTANCE = {"limit_bal": 0.25, "age": 0.20, "pay_new": 0.20, "education_new": 0.15,
                   "marriage_new": 0.10, "sex": 0.10}
# card-application rule messages, in the order they are checked
CARD_RULES = [
    ("limit_bal", "limit_bal must be between 10000 and 1000000"),
    ("sex", "sex must be 1 or 2"),
    ("marriage_new", "marriage_new must be between 0 and 3"),
    ("age", "age must be between 21 and 79"),
    ("pay_new", "pay_new must be -1, 0 or 1"),
    ("education_new", "education_new must be between 1 and 4"),
]


def _ok(cond: Column) -> Column:
    """A rule passes only when its condition is true (null fails)."""
    return F.coalesce(cond, F.lit(False))


def _ok_or_null(c: Column, cond: Column) -> Column:
    return c.isNull() | _ok(cond)


def application_rules() -> list[tuple[str, Column]]:
    """(reason, passes) for every 13-field application rule, in a fixed order."""
    return [
        ("annual_inc_not_positive", _ok(col("annual_inc") > 0)),
        ("loan_amnt_not_positive", _ok(col("loan_amnt") > 0)),
        ("fico_range_low_out_of_range", _ok(col("fico_range_low").between(300, 850))),
        ("fico_range_high_out_of_range", _ok(col("fico_range_high").between(300, 850))),
        ("fico_range_high_not_above_low", _ok(col("fico_range_high") > col("fico_range_low"))),
        ("dti_out_of_range", _ok(col("dti").between(0, 100))),
        ("revol_util_out_of_range", _ok_or_null(col("revol_util"), col("revol_util").between(0, 100))),
        ("inq_last_6mths_negative", _ok_or_null(col("inq_last_6mths"), col("inq_last_6mths") >= 0)),
        ("delinq_2yrs_negative", _ok_or_null(col("delinq_2yrs"), col("delinq_2yrs") >= 0)),
        ("pub_rec_negative", _ok_or_null(col("pub_rec"), col("pub_rec") >= 0)),
        ("emp_length_unknown", _ok_or_null(col("emp_length"), col("emp_length").isin(EMP_LENGTH_VALUES))),
        ("home_ownership_unknown", _ok(col("home_ownership").isin(HOME_OWNERSHIP_VALUES))),
        ("term_unknown", _ok(col("term").isin(TERM_VALUES))),
        ("purpose_missing", col("purpose").isNotNull()),
    ]


def rejection_reasons() -> Column:
    """Array of failed-rule names (empty when the application is valid)."""
    return F.array_compact(F.array(*[F.when(~ok, F.lit(reason)) for reason, ok in application_rules()]))


def card_rejection() -> Column:
    """First failing card rule message, null when valid (rules checked in order)."""
    checks = {
        "limit_bal": col("limit_bal").between(10000, 1000000),
        "sex": col("sex").isin(1, 2),
        "marriage_new": col("marriage_new").isin(0, 1, 2, 3),
        "age": col("age").between(21, 79),
        "pay_new": col("pay_new").isin(-1, 0, 1),
        "education_new": col("education_new").isin(1, 2, 3, 4),
    }
    return F.coalesce(*[F.when(~_ok(checks[name]), F.lit(msg)) for name, msg in CARD_RULES],
                      F.lit(None).cast("string"))


def fill_defaults(df: DataFrame) -> DataFrame:
    """Fill the missing optional application fields with fixed defaults."""
    present = {k: v for k, v in APPLICATION_DEFAULTS.items() if k in df.columns}
    return df.na.fill(present) if present else df


def tenure_years(c: Column) -> Column:
    """emp_length text -> whole years: n/a, null, '< 1 year' -> 0; '10+ years' -> 10;
    otherwise the leading integer token, else 0."""
    first = F.regexp_extract(F.trim(c), r"^(\S+)", 1)
    return (F.when(c.isNull() | (c == "n/a"), 0)
            .when(c.contains("< 1 year"), 0)
            .when(c.contains("10+ years"), 10)
            .otherwise(F.coalesce(first.try_cast("int"), F.lit(0)))).cast("int")


def engineered_features() -> dict[str, Column]:
    """fico_avg, loan_to_income_ratio (0 when income <= 0 or absent), emp_length_numeric."""
    return {
        "fico_avg": (col("fico_range_low") + col("fico_range_high")) / 2,
        "loan_to_income_ratio": F.when(col("annual_inc") > 0,
                                       F.try_divide(col("loan_amnt"), col("annual_inc"))).otherwise(F.lit(0.0)),
        "emp_length_numeric": tenure_years(col("emp_length")),
    }


def align_columns(df: DataFrame, expected: list[str] = MODEL_COLUMNS) -> DataFrame:
    """Keep ``expected`` in order, adding absent ones as 0."""
    return df.select(*[col(c) if c in df.columns else F.lit(0).alias(c) for c in expected])


# ---------------------------------------------------------------------------
# scorecard (L1) and score labelling (L2/L3)
# ---------------------------------------------------------------------------

def _points_ladder(x: Column, steps: list[tuple[str, float, int]], default: int) -> Column:
    expr = None
    for op, bound, pts in steps:
        cond = x >= bound if op == ">=" else x <= bound
        expr = F.when(cond, pts) if expr is None else expr.when(cond, pts)
    return expr.otherwise(default)


def scorecard_points() -> Column:
    """Integer points 0..100 of the rule scorecard (nulls earn the lowest step)."""
    fico_avg = (col("fico_range_low") + col("fico_range_high")) / 2
    fico = _points_ladder(fico_avg, [(">=", 750, 20), (">=", 700, 15), (">=", 650, 10)], 5)
    dti = _points_ladder(col("dti"), [("<=", 20, 15), ("<=", 30, 10), ("<=", 40, 5)], 0)
    revol = _points_ladder(col("revol_util"), [("<=", 20, 10), ("<=", 40, 5)], 0)
    emp = F.when(col("emp_length").isin(EMP_LENGTH_VALUES), tenure_years(col("emp_length"))).otherwise(0)
    home = F.coalesce(F.element_at(F.create_map(*[x for k, v in SCORECARD_HOME_POINTS.items()
                                                  for x in (F.lit(k), F.lit(v))]),
                                   col("home_ownership")), F.lit(0))
    inq = _points_ladder(col("inq_last_6mths"), [("<=", 1, 5), ("<=", 3, 3)], 0)
    delinq = F.when(col("delinq_2yrs") == 0, 5).otherwise(0)
    total = fico + dti + revol + emp + home + inq + delinq
    return F.least(F.lit(100), F.greatest(F.lit(0), total)).cast("int")


def scorecard(df: DataFrame) -> DataFrame:
    """L1: rule scorecard. Adds score, prediction (0 = approve iff score >= 50),
    p_default = (100 - score)/100, confidence and recommended_amount."""
    out = df.withColumn("score", scorecard_points())
    p = (100 - F.col("score")) / 100
    return out.withColumns({
        "prediction": F.when(F.col("score") >= 50, 0).otherwise(1),
        "p_default": p,
        "confidence": F.when(p >= 0.8, "high").when(p >= 0.6, "medium").otherwise("low"),
        "recommended_amount": F.when(F.col("score") >= 50,
                                     F.least(col("loan_amnt") * 1.1, col("annual_inc") * 0.3)),
    })


def label_default_probability(df: DataFrame, p: str = "p_default", threshold: float = 0.5) -> DataFrame:
    """L2 labels for a P(default) column: prediction, confidence, risk score, amount."""
    pc = col(p)
    return df.withColumns({
        "prediction": F.when(pc >= threshold, 1).otherwise(0),
        "confidence": F.when((pc >= 0.8) | (pc <= 0.2), "high")
                       .when((pc >= 0.6) | (pc <= 0.4), "medium").otherwise("low"),
        "risk_score": pc * 100,
        "recommended_amount": F.when(pc < threshold,
                                     F.when(pc > 0.7, col("loan_amnt") * 0.5)
                                     .when(pc > 0.5, col("loan_amnt") * 0.8)
                                     .otherwise(col("loan_amnt"))),
    })


def label_repay_probability(df: DataFrame, p: str = "p_repay") -> DataFrame:
    """L3 labels for a P(repay) column: risk = (1-p)*100, confidence by p."""
    pc = col(p)
    return df.withColumns({
        "risk_score": (1 - pc) * 100,
        "confidence": F.when(pc >= 0.8, "high").when(pc >= 0.6, "medium").otherwise("low"),
    })
