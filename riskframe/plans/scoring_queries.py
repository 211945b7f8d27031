"""Queries over applications: validation, scorecard, labels, logs."""

from __future__ import annotations

from ..operators import scoring as S
from . import inputs as I
from .catalog import register

FLAGSHIP_SQL = I.with_ctes(I.APPLICATIONS_SQL, """
checked AS (
  SELECT *, list_filter([
      CASE WHEN NOT coalesce(annual_inc > 0, false) THEN 'annual_inc_not_positive' END,
      CASE WHEN NOT coalesce(loan_amnt > 0, false) THEN 'loan_amnt_not_positive' END,
      CASE WHEN NOT coalesce(fico_range_low BETWEEN 300 AND 850, false) THEN 'fico_range_low_out_of_range' END,
      CASE WHEN NOT coalesce(fico_range_high BETWEEN 300 AND 850, false) THEN 'fico_range_high_out_of_range' END,
      CASE WHEN NOT coalesce(fico_range_high > fico_range_low, false) THEN 'fico_range_high_not_above_low' END,
      CASE WHEN NOT coalesce(dti BETWEEN 0 AND 100, false) THEN 'dti_out_of_range' END,
      CASE WHEN revol_util IS NOT NULL AND NOT (revol_util BETWEEN 0 AND 100) THEN 'revol_util_out_of_range' END,
      CASE WHEN inq_last_6mths < 0 THEN 'inq_last_6mths_negative' END,
      CASE WHEN delinq_2yrs < 0 THEN 'delinq_2yrs_negative' END,
      CASE WHEN pub_rec < 0 THEN 'pub_rec_negative' END,
      CASE WHEN emp_length IS NOT NULL AND emp_length NOT IN ('< 1 year','1 year','2 years','3 years','4 years',
           '5 years','6 years','7 years','8 years','9 years','10+ years','n/a') THEN 'emp_length_unknown' END,
      CASE WHEN NOT coalesce(home_ownership IN ('RENT','OWN','MORTGAGE','OTHER'), false) THEN 'home_ownership_unknown' END,
      CASE WHEN NOT coalesce(term IN ('36 months','60 months'), false) THEN 'term_unknown' END,
      CASE WHEN purpose IS NULL THEN 'purpose_missing' END], lambda x: x IS NOT NULL) AS reasons
  FROM applications
),
filled AS (
  SELECT segment, loan_amnt, annual_inc, len(reasons) = 0 AS is_valid,
         fico_range_low, fico_range_high, dti, home_ownership,
         coalesce(revol_util, 0.0) AS revol_util, coalesce(inq_last_6mths, 0) AS inq_last_6mths,
         coalesce(delinq_2yrs, 0) AS delinq_2yrs, coalesce(emp_length, 'n/a') AS emp_length
  FROM checked
),
scored AS (
  SELECT *, CAST(least(100, greatest(0,
      CASE WHEN (fico_range_low + fico_range_high) / 2 >= 750 THEN 20
           WHEN (fico_range_low + fico_range_high) / 2 >= 700 THEN 15
           WHEN (fico_range_low + fico_range_high) / 2 >= 650 THEN 10 ELSE 5 END
    + CASE WHEN dti <= 20 THEN 15 WHEN dti <= 30 THEN 10 WHEN dti <= 40 THEN 5 ELSE 0 END
    + CASE WHEN revol_util <= 20 THEN 10 WHEN revol_util <= 40 THEN 5 ELSE 0 END
    + CASE emp_length WHEN '10+ years' THEN 10 WHEN '9 years' THEN 9 WHEN '8 years' THEN 8
           WHEN '7 years' THEN 7 WHEN '6 years' THEN 6 WHEN '5 years' THEN 5 WHEN '4 years' THEN 4
           WHEN '3 years' THEN 3 WHEN '2 years' THEN 2 WHEN '1 year' THEN 1 ELSE 0 END
    + CASE home_ownership WHEN 'OWN' THEN 10 WHEN 'MORTGAGE' THEN 8 WHEN 'RENT' THEN 5
           WHEN 'OTHER' THEN 3 ELSE 0 END
    + CASE WHEN inq_last_6mths <= 1 THEN 5 WHEN inq_last_6mths <= 3 THEN 3 ELSE 0 END
    + CASE WHEN delinq_2yrs = 0 THEN 5 ELSE 0 END)) AS INTEGER) AS score
  FROM filled
)
SELECT segment,
       count(*) AS n_applications,
       count(*) FILTER (WHERE is_valid) AS n_valid,
       count(*) FILTER (WHERE is_valid AND score >= 50) AS n_approved,
       round(count(*) FILTER (WHERE is_valid AND score >= 50) / nullif(count(*) FILTER (WHERE is_valid), 0), 6) AS approval_rate,
       round(avg(CASE WHEN is_valid THEN score END), 6) AS avg_score,
       round(sum(CASE WHEN is_valid AND score >= 50 THEN least(loan_amnt * 1.1, annual_inc * 0.3) END), 2) AS recommended_total,
       count(*) FILTER (WHERE is_valid AND (100 - score) / 100 < 0.6) AS n_low_confidence
FROM scored GROUP BY segment
""")


@register("scorecard_by_segment", FLAGSHIP_SQL)
def scorecard_by_segment(spark, sf_dir):
    """Flagship: applications → validation → scorecard → per-segment approval."""
    return S.scorecard_summary(I.applications(spark, sf_dir), by="segment")


@register("scorecard_by_segment_stream", FLAGSHIP_SQL)
def scorecard_by_segment_stream(spark, sf_dir):
    """M6: the flagship over an order stream (stream-static join to customers)."""
    from ..streaming.monitors import scorecard_summary_stream
    return scorecard_summary_stream(spark, sf_dir)
