"""Business tables derived from the driver tables.

The driver ships a TPC-H-like star schema; the reference works on loan
applications, a wide loan table, card applications and a prediction log.
Each derived table is a pure column formula over the driver tables, given
twice: as a DataFrame (what the operators run on) and as a SQL CTE (what
the DuckDB oracle runs on).  Work grows with the driver tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# 13-field loan applications: orders ⋈ customer (one application per order)
# ---------------------------------------------------------------------------

def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applications_from(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))


def applications_from(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Applications from an orders table or stream and the customer table."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = customer.select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    emp = (F.when(k % 13 == 0, "< 1 year").when(k % 13 == 1, "1 year")
           .when((k % 13).between(2, 9), F.concat((k % 13).cast("string"), F.lit(" years")))
           .when(k % 13 == 10, "10+ years").when(k % 13 == 11, "n/a"))
    fico_low = (300 + (ck * 7 + k) % 560).cast("int")
    return j.select(
        F.col("o_orderkey").alias("app_id"),
        F.col("o_custkey").alias("cust_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("o_orderdate").alias("applied_at"),
        (F.col("c_acctbal") * 12).alias("annual_inc"),
        F.col("o_totalprice").alias("loan_amnt"),
        emp.alias("emp_length"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "OWN")
         .when(F.col("c_mktsegment") == "BUILDING", "MORTGAGE")
         .when(F.col("c_mktsegment") == "FURNITURE", "RENT")
         .when(F.col("c_mktsegment") == "HOUSEHOLD", "OTHER")
         .otherwise("LEASE").alias("home_ownership"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "36 months")
         .when(F.col("o_orderpriority").isin("3-MEDIUM", "4-NOT SPECIFIED"), "60 months")
         .otherwise("120 months").alias("term"),
        F.when(F.col("o_orderstatus") == "F", "debt_consolidation")
         .when(F.col("o_orderstatus") == "O", "credit_card")
         .otherwise("home_improvement").alias("purpose"),
        fico_low.alias("fico_range_low"),
        (fico_low + (k % 5) * 4).cast("int").alias("fico_range_high"),
        ((k % 1100).cast("double") / 10).alias("dti"),
        F.when(k % 17 == 0, F.lit(None)).otherwise((ck % 1010).cast("double") / 10).alias("revol_util"),
        F.when(k % 11 == 0, F.lit(None)).otherwise((k % 9 - 1).cast("int")).alias("inq_last_6mths"),
        F.when(k % 19 == 0, F.lit(-1)).otherwise((ck % 3).cast("int")).cast("int").alias("delinq_2yrs"),
        F.when(k % 29 == 0, F.lit(None)).otherwise((ck % 2).cast("int")).alias("pub_rec"),
        F.when((F.col("o_orderstatus") == "P") & (k % 7 == 0), "Late (31-120 days)")
         .when(F.col("o_orderstatus") == "P", "Charged Off")
         .when((F.col("o_orderstatus") == "F") & (k % 7 == 1), " FULLY PAID ")
         .when(F.col("o_orderstatus") == "F", "Fully Paid")
         .when(k % 7 == 2, "Default")
         .when(k % 7 == 3, F.lit(None))
         .when(k % 7 == 4, "unpaid")
         .when(k % 7 == 5, "1.0")
         .otherwise("Current").alias("loan_status"),
    )


APPLICATIONS_SQL = """
applications AS (
  SELECT o_orderkey AS app_id, o_custkey AS cust_id, c_mktsegment AS segment,
         c_nationkey AS nation_key, o_orderdate AS applied_at,
         c_acctbal * 12 AS annual_inc, o_totalprice AS loan_amnt,
         CASE WHEN o_orderkey % 13 = 0 THEN '< 1 year' WHEN o_orderkey % 13 = 1 THEN '1 year'
              WHEN o_orderkey % 13 BETWEEN 2 AND 9 THEN CAST(o_orderkey % 13 AS VARCHAR) || ' years'
              WHEN o_orderkey % 13 = 10 THEN '10+ years' WHEN o_orderkey % 13 = 11 THEN 'n/a' END AS emp_length,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'OWN' WHEN 'BUILDING' THEN 'MORTGAGE'
              WHEN 'FURNITURE' THEN 'RENT' WHEN 'HOUSEHOLD' THEN 'OTHER' ELSE 'LEASE' END AS home_ownership,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '36 months'
              WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN '60 months'
              ELSE '120 months' END AS term,
         CASE o_orderstatus WHEN 'F' THEN 'debt_consolidation' WHEN 'O' THEN 'credit_card'
              ELSE 'home_improvement' END AS purpose,
         CAST(300 + (o_custkey * 7 + o_orderkey) % 560 AS INTEGER) AS fico_range_low,
         CAST(300 + (o_custkey * 7 + o_orderkey) % 560 + (o_orderkey % 5) * 4 AS INTEGER) AS fico_range_high,
         CAST(o_orderkey % 1100 AS DOUBLE) / 10 AS dti,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_custkey % 1010 AS DOUBLE) / 10 END AS revol_util,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 9 - 1 AS INTEGER) END AS inq_last_6mths,
         CAST(CASE WHEN o_orderkey % 19 = 0 THEN -1 ELSE o_custkey % 3 END AS INTEGER) AS delinq_2yrs,
         CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(o_custkey % 2 AS INTEGER) END AS pub_rec,
         CASE WHEN o_orderstatus = 'P' AND o_orderkey % 7 = 0 THEN 'Late (31-120 days)'
              WHEN o_orderstatus = 'P' THEN 'Charged Off'
              WHEN o_orderstatus = 'F' AND o_orderkey % 7 = 1 THEN ' FULLY PAID '
              WHEN o_orderstatus = 'F' THEN 'Fully Paid'
              WHEN o_orderkey % 7 = 2 THEN 'Default'
              WHEN o_orderkey % 7 = 3 THEN NULL
              WHEN o_orderkey % 7 = 4 THEN 'unpaid'
              WHEN o_orderkey % 7 = 5 THEN '1.0'
              ELSE 'Current' END AS loan_status
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""


# ---------------------------------------------------------------------------
# 6-field card applications (one per order), label = order still pending
# ---------------------------------------------------------------------------

def card_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        k.alias("app_id"),
        (F.col("o_totalprice") / 4).alias("limit_bal"),
        F.when(k % 41 == 0, 3).otherwise(1 + ck % 2).cast("int").alias("sex"),
        F.when(k % 37 == 0, 5).otherwise(k % 4).cast("int").alias("marriage_new"),
        (18 + (ck * 3 + k) % 65).cast("int").alias("age"),
        (k % 3 - 1).cast("int").alias("pay_new"),
        (1 + ck % 5).cast("int").alias("education_new"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).cast("int").alias("target"),
    )


CARD_APPLICATIONS_SQL = """
card_applications AS (
  SELECT o_orderkey AS app_id, o_totalprice / 4 AS limit_bal,
         CAST(CASE WHEN o_orderkey % 41 = 0 THEN 3 ELSE 1 + o_custkey % 2 END AS INTEGER) AS sex,
         CAST(CASE WHEN o_orderkey % 37 = 0 THEN 5 ELSE o_orderkey % 4 END AS INTEGER) AS marriage_new,
         CAST(18 + (o_custkey * 3 + o_orderkey) % 65 AS INTEGER) AS age,
         CAST(o_orderkey % 3 - 1 AS INTEGER) AS pay_new,
         CAST(1 + o_custkey % 5 AS INTEGER) AS education_new,
         CAST(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS INTEGER) AS target
  FROM orders
)"""


# ---------------------------------------------------------------------------
# wide numeric loan table: lineitem, label = returned, some derived nulls
# ---------------------------------------------------------------------------

def loan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.when(F.col("l_linenumber") == 3, F.lit(None)).otherwise(F.col("l_tax")).alias("tax_gap"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price"),
        "l_returnflag", "l_linestatus",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("int").alias("target"),
    )


LOAN_TABLE_SQL = """
loan_table AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         l_quantity, l_extendedprice, l_discount, l_tax,
         CASE WHEN l_linenumber = 3 THEN NULL ELSE l_tax END AS tax_gap,
         l_extendedprice * (1 - l_discount) AS net_price,
         l_returnflag, l_linestatus,
         CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS target
  FROM lineitem
)"""


# ---------------------------------------------------------------------------
# prediction / request log: events
# ---------------------------------------------------------------------------

def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    return ev.select(
        F.col("event_id").alias("request_id"),
        F.col("ts"),
        F.col("user_id"),
        et.alias("event_type"),
        F.when(et.isin("purchase", "view"), 0).otherwise(1).cast("int").alias("prediction"),
        (et == "error").alias("is_error"),
        F.col("value").alias("processing_ms"),
    )


PREDICTION_LOG_SQL = """
prediction_log AS (
  SELECT event_id AS request_id, ts, user_id, event_type,
         CAST(CASE WHEN event_type IN ('purchase', 'view') THEN 0 ELSE 1 END AS INTEGER) AS prediction,
         event_type = 'error' AS is_error,
         value AS processing_ms
  FROM events
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
