"""Customer relations derived from the order tables, as SQL that other engines run too.

The order tables hold no subscribers, so test subscribers are made from them: a customer's
order history sets tenure, contract and services. ``{orders}`` and ``{customer}`` stand for
the two inputs, so that the same text serves Spark and a SQL oracle.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CUSTOMERS_SQL = """
WITH o AS (
  SELECT o_custkey, count(*) AS n_orders,
         sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS n_urgent,
         min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts
  FROM {orders} GROUP BY o_custkey),
b AS (
  SELECT c.*, o.*,
         CAST((year(last_ts)*12 + month(last_ts)) - (year(first_ts)*12 + month(first_ts)) AS INT) AS tenure,
         CASE WHEN n_urgent <= 1 THEN 'No' WHEN n_urgent = 2 THEN 'DSL' ELSE 'Fiber optic' END AS isvc,
         c_custkey % 10 <> 9 AS phone,
         CAST(18.25 + floor((c_acctbal + 1000) / 110) AS DECIMAL(8,2)) AS mc
  FROM {customer} c JOIN o ON c.c_custkey = o.o_custkey)
SELECT concat('C', CAST(c_custkey AS VARCHAR(20))) AS customer_id,
  CASE WHEN c_nationkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  c_custkey % 6 = 0 AS senior_citizen, c_custkey % 2 = 0 AS partner, c_custkey % 10 < 3 AS dependents,
  tenure AS tenure_months, phone AS phone_service,
  CASE WHEN NOT phone THEN 'No phone service' WHEN c_custkey % 7 < 3 THEN 'Yes' ELSE 'No' END AS multiple_lines,
  isvc AS internet_service,
  CASE WHEN isvc='No' THEN 'No internet service' WHEN n_orders % 2 = 0 THEN 'Yes' ELSE 'No' END AS online_security,
  CASE WHEN isvc='No' THEN 'No internet service' WHEN n_orders % 3 = 0 THEN 'Yes' ELSE 'No' END AS online_backup,
  CASE WHEN isvc='No' THEN 'No internet service' WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS device_protection,
  CASE WHEN isvc='No' THEN 'No internet service' WHEN c_custkey % 5 < 2 THEN 'Yes' ELSE 'No' END AS tech_support,
  CASE WHEN isvc='No' THEN 'No internet service' WHEN c_custkey % 11 < 5 THEN 'Yes' ELSE 'No' END AS streaming_tv,
  CASE WHEN isvc='No' THEN 'No internet service' WHEN c_custkey % 13 < 6 THEN 'Yes' ELSE 'No' END AS streaming_movies,
  CASE WHEN n_orders <= 9 THEN 'Month-to-month' WHEN n_orders <= 11 THEN 'One year' ELSE 'Two year' END AS contract_type,
  c_nationkey % 5 < 3 AS paperless_billing,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE','BUILDING') THEN 'Electronic check' WHEN c_mktsegment='FURNITURE' THEN 'Mailed check'
       WHEN c_mktsegment='HOUSEHOLD' THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS payment_method,
  mc AS monthly_charges,
  CASE WHEN tenure = 0 THEN NULL ELSE CAST(mc * tenure AS DECIMAL(10,2)) END AS total_charges,
  last_ts < TIMESTAMP '2000-09-01 00:00:00' AS churn
FROM b
"""

# A stand-in for a model's probability, plain arithmetic so that every engine agrees on it.
SCORES_SQL = """
SELECT *, CAST(greatest(20, least(980, 330
   + CASE contract_type WHEN 'Month-to-month' THEN 150 WHEN 'Two year' THEN -120 ELSE 0 END
   + CASE internet_service WHEN 'No' THEN 60 WHEN 'Fiber optic' THEN -40 ELSE 0 END
   + (48 - tenure_months) * 8 + CAST(floor(monthly_charges) AS INT) % 17 * 5)) AS DOUBLE) / 1000 AS churn_probability,
   CAST(monthly_charges * 12 AS DECIMAL(12,2)) AS clv
FROM {customers}
"""

# The same customers as a raw, untidy export: texts under the raw header, ``seq`` for row
# order, some cells spoilt and some ids repeated later on with another charge.
RAW_SQL = """
WITH k AS (SELECT *, CAST(substring(customer_id, 2, 19) AS BIGINT) AS key FROM {customers}),
r AS (
  SELECT key * 2 AS seq, 0 AS again, k.* FROM k
  UNION ALL
  SELECT key * 2 + 1000000000000 AS seq, 1 AS again, k.* FROM k WHERE key % 40 = 7)
SELECT seq, customer_id AS customerID, gender,
  CASE WHEN senior_citizen THEN '1' ELSE '0' END AS SeniorCitizen,
  CASE WHEN key % 53 = 3 THEN 'Y' WHEN partner THEN 'Yes' ELSE 'No' END AS Partner,
  CASE WHEN dependents THEN 'Yes' ELSE 'No' END AS Dependents,
  CASE WHEN key % 97 = 5 THEN '-1' ELSE CAST(tenure_months AS VARCHAR(20)) END AS tenure,
  CASE WHEN phone_service THEN 'Yes' ELSE 'No' END AS PhoneService,
  multiple_lines AS MultipleLines,
  CASE WHEN key % 31 = 4 THEN concat(' ', internet_service, '  ') WHEN key % 71 = 9 THEN NULL ELSE internet_service END AS InternetService,
  online_security AS OnlineSecurity, online_backup AS OnlineBackup, device_protection AS DeviceProtection,
  CASE WHEN key % 61 = 8 OR (key % 80 = 7 AND again = 0) THEN 'Maybe' ELSE tech_support END AS TechSupport,
  streaming_tv AS StreamingTV, streaming_movies AS StreamingMovies,
  CASE WHEN key % 83 = 2 THEN 'Weekly' ELSE contract_type END AS Contract,
  CASE WHEN paperless_billing THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
  payment_method AS PaymentMethod,
  CASE WHEN key % 89 = 6 THEN 'n.a.' ELSE CAST(CAST(monthly_charges + again AS DECIMAL(8,2)) AS VARCHAR(20)) END AS MonthlyCharges,
  CASE WHEN total_charges IS NULL OR key % 67 = 1 THEN ' ' ELSE CAST(total_charges AS VARCHAR(20)) END AS TotalCharges,
  CASE WHEN churn THEN 'Yes' ELSE 'No' END AS Churn
FROM r
"""


@lru_cache(maxsize=256)
def _table_schema(app: str, path: str) -> StructType:
    return SparkSession.active().read.parquet(path).schema


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its footer is read once per session and not once per query."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_table_schema(spark.sparkContext.applicationId, path)).parquet(path)


def derive_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed customers: orders reduced per customer first, then joined on the unique key."""
    return spark.sql(
        CUSTOMERS_SQL,
        orders=read_table(spark, sf_dir, "orders"),
        customer=read_table(spark, sf_dir, "customer"),
    )


def derive_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untidy raw rows with a ``seq`` column that fixes their order."""
    return spark.sql(RAW_SQL, customers=derive_customers(spark, sf_dir))


def derive_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a deterministic churn probability and customer value."""
    return spark.sql(SCORES_SQL, customers=derive_customers(spark, sf_dir))
