"""Column-expression operators against hand-computed values (incl. the reference's golden values)."""

from pyspark.sql import functions as F

from riskframe.functions import applications as A
from riskframe.functions import labels as L
from riskframe.operators import scoring as S


def test_tenure_golden(spark):
    rows = [("5 years", 5), ("< 1 year", 0), ("10+ years", 10), ("n/a", 0), ("invalid", 0), (None, 0), ("1 year", 1)]
    df = spark.createDataFrame(rows, "e string, want int")
    got = df.select(A.tenure_years(F.col("e")).alias("g"), "want").collect()
    assert all(r.g == r.want for r in got)


def test_default_probability_labels_golden(spark):
    df = spark.createDataFrame([(0.9,), (0.1,), (0.6,), (0.4,), (0.5,), (0.7,), (0.3,), (0.0,), (1.0,)],
                               "p_default double").withColumn("loan_amnt", F.lit(10000.0))
    got = {r.p_default: r for r in A.label_default_probability(df).collect()}
    assert [got[p].confidence for p in (0.9, 0.1, 0.6, 0.4, 0.5)] == ["high", "high", "medium", "medium", "low"]
    assert [got[p].risk_score for p in (0.7, 0.3, 0.0, 1.0)] == [70.0, 30.0, 0.0, 100.0]
    # p = .7 -> rejected, medium confidence, risk 70 (end-to-end golden case)
    assert (got[0.7].prediction, got[0.7].confidence, got[0.7].risk_score) == (1, "medium", 70.0)
    assert got[0.3].recommended_amount == 10000.0 and got[0.7].recommended_amount is None


def test_recommended_amount_rule(spark):
    # amount rule alone (threshold 1 so every row is approved): .8 -> 5000, .6 -> 8000, .3 -> 10000
    df = spark.createDataFrame([(0.8,), (0.6,), (0.3,)], "p_default double").withColumn("loan_amnt", F.lit(10000.0))
    got = {r.p_default: r.recommended_amount for r in A.label_default_probability(df, threshold=1.01).collect()}
    assert got == {0.8: 5000.0, 0.6: 8000.0, 0.3: 10000.0}


def _app(**kw):
    base = dict(annual_inc=60000.0, loan_amnt=10000.0, emp_length="5 years", home_ownership="OWN", term="36 months",
                purpose="car", fico_range_low=740, fico_range_high=760, dti=15.0, revol_util=10.0,
                inq_last_6mths=0, delinq_2yrs=0, pub_rec=0)
    base.update(kw)
    return base


SCHEMA = ("annual_inc double, loan_amnt double, emp_length string, home_ownership string, term string, purpose string, "
          "fico_range_low int, fico_range_high int, dti double, revol_util double, inq_last_6mths int, "
          "delinq_2yrs int, pub_rec int")


def test_scorecard_hand_computed(spark):
    # 20 (fico 750) + 15 (dti) + 10 (revol) + 5 (emp) + 10 (OWN) + 5 (inq) + 5 (delinq) = 70
    good = _app()
    # 5 + 0 + 0 + 0 + 3 + 0 + 0 = 8
    bad = _app(fico_range_low=600, fico_range_high=610, dti=45.0, revol_util=90.0, emp_length="n/a",
               home_ownership="OTHER", inq_last_6mths=5, delinq_2yrs=2)
    rows = S.score_by_scorecard(spark.createDataFrame([tuple(good.values()), tuple(bad.values())], SCHEMA)).collect()
    g, b = rows
    assert (g.score, g.prediction, g.confidence) == (70, 0, "low")
    assert abs(g.p_default - 0.3) < 1e-12 and abs(g.recommended_amount - 11000.0) < 1e-9
    assert (b.score, b.prediction, b.confidence, b.recommended_amount) == (8, 1, "high", None)


def test_validation_reasons(spark):
    rows = [tuple(_app().values()),
            tuple(_app(annual_inc=-1.0, fico_range_high=740, term="120 months", revol_util=None).values())]
    v = S.validate_applications(spark.createDataFrame(rows, SCHEMA)).collect()
    assert v[0].is_valid and v[0].reasons == []
    assert v[1].reasons == ["annual_inc_not_positive", "fico_range_high_not_above_low", "term_unknown"]


def test_card_rules_first_failure(spark):
    df = spark.createDataFrame([(5000.0, 3, 9, 10, 7, 9), (20000.0, 1, 1, 30, 0, 2)],
                               "limit_bal double, sex int, marriage_new int, age int, pay_new int, education_new int")
    r = S.validate_card_applications(df).collect()
    assert r[0].rejection.startswith("limit_bal") and r[1].rejection is None


def test_loan_status_mapping(spark):
    rows = [("Fully Paid", 0), (" CURRENT ", 0), ("unpaid", 0), ("Charged Off", 1), ("Late (16-30 days)", 1),
            ("0.0", 0), ("1", 1), (None, 1), ("mystery", 1),
            ("Does not meet the credit policy. Status:Fully Paid", 0)]
    df = spark.createDataFrame(rows, "s string, want int")
    got = df.select(L.loan_status_target(F.col("s")).alias("g"), L.loan_status_target_short(F.col("s")).alias("h"),
                    "want", "s").collect()
    assert all(r.g == r.want for r in got)
    short = {r.s: r.h for r in got}
    assert short["unpaid"] == 1 and short["Fully Paid"] == 0 and short[None] == 1


def test_pay_status_and_caps(spark):
    df = spark.createDataFrame([(2, -1, None), (0, -1, -2), (-1, -2, None), (None, None, None)],
                               "pay_0 int, pay_2 int, pay_3 int")
    got = [r.p for r in df.select(L.pay_status(["pay_0", "pay_2", "pay_3"]).alias("p")).collect()]
    assert got == [1, 0, -1, -1]
    caps = spark.createDataFrame([(0,), (3,), (5,), (None,)], "e int").select(L.cap(F.col("e"), 4).alias("c"))
    assert [r.c for r in caps.collect()] == [0, 3, 4, None]


def test_translation_passthrough(spark):
    df = spark.createDataFrame([("10+ лет",), ("АРЕНДА",), ("unknown",)], "v string")
    got = [r.t for r in df.select(L.translate(F.col("v"), {**L.EMP_LENGTH_RU, **L.HOME_OWNERSHIP_RU}).alias("t")).collect()]
    assert got == ["10+ years", "RENT", "unknown"]
