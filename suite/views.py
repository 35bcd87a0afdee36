"""HR-shaped views of the given tables, as SQL that Spark and the comparison engine both run.

The tables hold no nulls and no faults, so the views put some in by expression.
"""

from pyspark.sql import DataFrame, SparkSession

PER = """
SELECT c_custkey AS id, c_custkey AS employee_id,
       c_name AS first_name, c_mktsegment AS last_name, c_mktsegment AS job_id,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_nationkey END AS department_id,
       CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(floor(c_custkey / 10e0) AS BIGINT) END AS manager_id,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 30000e0 + c_acctbal * 20e0 END AS salary,
       CASE WHEN c_custkey % 4 = 0 THEN CAST(c_custkey % 30 AS DOUBLE) / 100e0 END AS commission_pct,
       DATE '2015-01-01' + CAST(c_custkey % 3000 AS INT) AS hire_date,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(10 + c_custkey % 100 AS BIGINT) END AS age,
       CASE c_custkey % 5 WHEN 0 THEN 'user' || CAST(c_custkey AS STRING) WHEN 1 THEN NULL
            ELSE 'user' || CAST(c_custkey AS STRING) || '@example.com' END AS email,
       CASE c_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'QQ12345' ELSE
            'AB' || CAST(100000 + 2 * ((c_custkey * 3) % 1000) + CASE WHEN c_custkey % 50 = 1 THEN 1 ELSE 0 END AS STRING) || 'C' END AS nino,
       CASE c_custkey % 6 WHEN 0 THEN '1980-02-30' WHEN 1 THEN '1980-2-3' WHEN 2 THEN NULL
            WHEN 3 THEN '03/02/1980' ELSE '1980-02-03' END AS date_of_birth,
       CASE c_custkey % 7 WHEN 0 THEN 'AB1 2CD' WHEN 1 THEN NULL WHEN 2 THEN '12345-6789' ELSE '12345' END AS postal_code,
       CASE c_custkey % 8 WHEN 0 THEN 'gb' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 'GB' END AS country,
       CASE c_custkey % 6 WHEN 0 THEN '555-123-4567' WHEN 1 THEN 'none' WHEN 2 THEN NULL ELSE '5551234567' END AS phone,
       CASE c_custkey % 10 WHEN 3 THEN 'id 123-45-6789' WHEN 4 THEN NULL ELSE 'id ' || CAST(c_custkey AS STRING) END AS reference,
       CASE c_custkey % 5 WHEN 0 THEN 'P-12-24' WHEN 1 THEN NULL ELSE 'P-' || CAST(1000 + c_custkey % 9000 AS STRING) || '-24' END AS project_code,
       CAST((c_custkey * c_custkey * 37) % 1009 AS DOUBLE) / 47e0 - 10e0 AS latitude,
       CAST((c_custkey * c_custkey * c_custkey + 91 * c_custkey) % 1013 AS DOUBLE) / 47e0 - 10e0 AS longitude
FROM customer"""

ASSIGNMENTS = """
SELECT o_orderkey AS id, o_custkey AS employee_id, o_orderpriority AS job_id,
       CAST(o_orderdate AS DATE) AS start_date,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 200 AS INT) AS end_date
FROM orders"""

JOB_HISTORY = """
SELECT o_orderkey AS id, o_custkey AS employee_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'AUTOMOBILE' WHEN '2-HIGH' THEN 'BUILDING' WHEN '3-MEDIUM' THEN 'FURNITURE'
            WHEN '5-LOW' THEN 'HOUSEHOLD' ELSE 'MACHINERY' END AS job_id,
       o_orderdate AS start_date,
       o_orderdate + INTERVAL '1' DAY * CAST(o_orderkey % 200 AS INT) + INTERVAL '36' HOUR AS end_date
FROM orders"""

ADDRESSES = """
SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 1 THEN NULL ELSE '12345' END AS postal_code,
       CASE c_custkey % 3 WHEN 0 THEN '2020-1-31' WHEN 1 THEN '2021-13-01' ELSE NULL END AS date_from
FROM customer"""

DEPT = """
SELECT n_nationkey AS department_id, n_name AS department_name, n_regionkey AS location_id FROM nation"""

LOCATIONS = """
SELECT r_regionkey AS location_id, r_name AS city, r_name AS state_province, r_regionkey AS country_id FROM region"""

JOBS = """
SELECT DISTINCT c_mktsegment AS job_id, 'Job ' || c_mktsegment AS job_title FROM customer"""

RECORDS = """
SELECT c_custkey AS id, c_nationkey AS k1, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS k2
FROM customer"""

RULE_LOG = """
SELECT event_id, ts,
       'rule_' || CAST(event_id % 17 AS STRING) || '_' || event_type AS config_key,
       'rule_' || CAST(event_id % 17 AS STRING) AS rule_id, event_type AS table_name,
       'value' AS column_name,
       CASE event_id % 4 WHEN 0 THEN 'Critical' WHEN 1 THEN 'High' WHEN 2 THEN 'Medium' ELSE 'Low' END AS severity,
       CASE event_id % 3 WHEN 0 THEN 'gdpr_rules' WHEN 1 THEN 'data_quality_rules' ELSE 'table_specific_rules' END AS category,
       CASE WHEN value > 60 THEN 'deactivate' ELSE 'save' END AS action
FROM events"""

RULE_EVENTS = """
SELECT event_id, ts, event_id % 18 AS rule_no, 'registered_' || CAST(event_id % 18 AS STRING) AS config_key,
       CASE user_id % 4 WHEN 0 THEN 'violation' WHEN 1 THEN NULL ELSE 'skip' END AS on_null,
       CASE user_id % 3 WHEN 0 THEN 'pass' WHEN 1 THEN NULL ELSE 'violation' END AS polarity,
       CASE event_id % 4 WHEN 0 THEN 'Critical' WHEN 1 THEN 'High' WHEN 2 THEN 'Medium' ELSE 'Low' END AS severity,
       CASE WHEN value > 60 THEN 'deactivate' ELSE 'save' END AS action
FROM events"""

RUN_HISTORY = """
SELECT event_type AS dataset, CAST(ts AS DATE) AS run_date, count(*) AS total_records,
       count(*) - count(DISTINCT user_id) AS duplicate_records,
       avg(CASE WHEN value < 100 THEN 1e0 ELSE 0e0 END) AS accuracy,
       avg(CASE WHEN value > 20 THEN 1e0 ELSE 0e0 END) AS completeness
FROM events GROUP BY event_type, CAST(ts AS DATE)"""

ITEM_LOG = """
SELECT event_id, ts, user_id AS item_id,
       CASE WHEN event_type IN ('view', 'signup') THEN 'add' ELSE 'update' END AS action,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'fix ' || event_type END AS description,
       CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'purchase' THEN 'Completed'
            WHEN event_type = 'error' THEN 'in progress' ELSE 'pending' END AS status,
       CASE WHEN value > 60 THEN 'high' WHEN value > 20 THEN 'medium' ELSE NULL END AS impact
FROM events"""

MEASURES = """
SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax, 1e0 AS unit FROM lineitem"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _split(text: str) -> tuple[str, str, str]:
    """Text before, name of, and text after the table that a view selects from."""
    head, _, tail = text.rpartition("FROM ")
    name = tail.split()[0]
    return head, name, tail[len(name) :]


def over(df: DataFrame, text: str) -> DataFrame:
    """A view text applied to a DataFrame, streaming or not."""
    head, _, rest = _split(text)
    return df.sparkSession.sql(f"{head}FROM {{t}} {rest}", t=df)


def view(spark: SparkSession, sf: str, text: str) -> DataFrame:
    """A view text over the parquet table it selects from."""
    return over(table(spark, sf, _split(text)[1]), text)


def with_views(**views: str) -> str:
    """``WITH name AS (text), ...`` to put before a SELECT."""
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in views.items()) + "\n"
