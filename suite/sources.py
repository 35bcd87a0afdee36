"""Reading tables, rule files and histories; writing results and alerts."""

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.operators import monitor as mo
from assay.operators.rule_pack import PACK
from assay.operators.rules import run_rules
from assay.plans.lineage import fresh_dir
from assay.sources import results as rs
from assay.sources import rule_files as rf
from assay.sources import tables as tb
from suite import case
from suite import rules as rule_cases
from suite import views as v


@case(
    "scan_table",
    "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING'",
)
def scan_table(spark, sf):
    return tb.scan_table(
        spark,
        f"{sf}/customer.parquet",
        columns=["c_custkey", "c_name", "c_acctbal"],
        where="c_acctbal > 0 AND c_mktsegment = 'BUILDING'",
    )


@case(
    "scan_csv_set",
    v.with_views(people=v.PER, assignments=v.ASSIGNMENTS, addresses=v.ADDRESSES)
    + """SELECT 'people' AS dataset, id, nullif(email, '') AS text_value, salary AS number_value, hire_date AS date_value FROM people
UNION ALL SELECT 'assignments', id, job_id, CAST(employee_id AS DOUBLE), start_date FROM assignments
UNION ALL SELECT 'addresses', id, postal_code, NULL, NULL FROM addresses""",
)
def scan_csv_set(spark, sf):
    tables = {
        "people": v.view(spark, sf, v.PER),
        "assignments": v.view(spark, sf, v.ASSIGNMENTS),
        "addresses": v.view(spark, sf, v.ADDRESSES),
    }
    folder = fresh_dir(spark, "csv")
    for name, df in tables.items():
        df.write.csv(f"{folder}/{name}", header=True, escape='"')
    read = tb.scan_csv_set(
        spark, {n: f"{folder}/{n}" for n in tables}, {n: T.StructType(df.schema.fields) for n, df in tables.items()}
    )
    shown = {
        "people": ("email", "salary", "hire_date"),
        "assignments": ("job_id", "CAST(employee_id AS DOUBLE)", "start_date"),
        "addresses": ("postal_code", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DATE)"),
    }
    parts = [
        read[n].selectExpr(
            f"'{n}' AS dataset", "id", f"{t} AS text_value", f"{x} AS number_value", f"{d} AS date_value"
        )
        for n, (t, x, d) in shown.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@case(
    "csv_quarantine",
    v.with_views(per=v.PER)
    + """SELECT 'good' AS outcome, id, CAST(NULL AS VARCHAR) AS record FROM per WHERE id % 11 NOT IN (3, 7)
UNION ALL SELECT 'bad', NULL, CASE id % 11 WHEN 3 THEN id || ',today,' || coalesce(age, 0) ELSE id || ',2024-01-01' END
FROM per WHERE id % 11 IN (3, 7)""",
)
def csv_quarantine(spark, sf):
    """Lines with a word for a date or a field too few, among good ones."""
    folder = fresh_dir(spark, "broken")
    people = v.view(spark, sf, v.PER)
    people.selectExpr(
        "CASE id % 11 WHEN 3 THEN concat(id, ',today,', coalesce(age, 0)) WHEN 7 THEN concat(id, ',2024-01-01') "
        "ELSE concat(id, ',2024-01-01,', coalesce(age, 0)) END AS `id,hired,age`"
    ).write.option("header", False).text(folder)
    schema = T.StructType.fromDDL("id bigint, hired date, age bigint")
    good, bad = tb.scan_csv_checked(spark, folder, schema, header=False)
    return good.selectExpr("'good' AS outcome", "id", "CAST(NULL AS STRING) AS record").unionByName(
        bad.selectExpr("'bad' AS outcome", "CAST(NULL AS BIGINT) AS id", "record")
    )


TEMPLATE_FIELDS = (
    "named_struct('id', id, 'name', id, 'description', description, 'severity', severity, "
    "'validation_code', validation_code, 'validation_code_sql', validation_code_sql)"
)


@case(
    "rule_templates_flatten",
    rule_cases.LOG[:-1]
    + ",\n"
    + rule_cases.TEMPLATES
    + """SELECT category, CASE WHEN category = 'table_specific_rules' THEN severity END AS subcategory, id, id AS name,
       description, severity, validation_code, validation_code_sql FROM templates""",
)
def rule_templates_flatten(spark, sf):
    """Templates go to one JSON document per category, nested by severity for one of them.

    A document holds the rule templates of a category: their number is set by the rule
    catalogue and does not grow with the event log they are derived from.
    """
    catalogue = rule_cases.templates(spark, sf)
    listed = F.expr(f"collect_list({TEMPLATE_FIELDS})")
    flat = (
        catalogue.where("category <> 'table_specific_rules'")
        .groupBy("category")
        .agg(listed.alias("rules"))
        .select("category", F.to_json(F.create_map("category", "rules")).alias("value"))
    )
    nested = (
        catalogue.where("category = 'table_specific_rules'")
        .groupBy("category", "severity")
        .agg(listed.alias("rules"))
        .groupBy("category")
        .agg(F.map_from_entries(F.collect_list(F.struct("severity", "rules"))).alias("groups"))
        .select("category", F.to_json(F.create_map("category", "groups")).alias("value"))
    )
    folder = fresh_dir(spark, "templates")
    flat.unionByName(nested).withColumnRenamed("category", "document").write.partitionBy("document").text(folder)
    return rf.load_rule_templates(spark, folder).select(
        "category", "subcategory", "id", "name", "description", "severity", "validation_code", "validation_code_sql"
    )


@case(
    "rule_configs_load",
    rule_cases.STATE
    + """SELECT config_key, rule_id, table_name, column_name, severity, category,
       strftime(last_updated, '%Y-%m-%dT%H:%M:%S') AS last_updated, coalesce(CASE WHEN severity <> 'Low' THEN is_active END, true) AS is_active
FROM state""",
)
def rule_configs_load(spark, sf):
    """The current rules, one JSON document per table; the number of rules is set by their keys."""
    config = F.struct(
        "rule_id",
        "table_name",
        "column_name",
        "severity",
        "category",
        F.date_format("last_updated", "yyyy-MM-dd'T'HH:mm:ss").alias("last_updated"),
        F.when(F.col("severity") != "Low", F.col("is_active")).alias("is_active"),
    )
    documents = (
        rule_cases.state(spark, sf)
        .groupBy(F.col("table_name").alias("document"))
        .agg(F.map_from_entries(F.collect_list(F.struct("config_key", config.alias("config")))).alias("rules"))
        .select("document", F.to_json(F.struct(F.col("rules").alias("rule_configs"))).alias("value"))
    )
    folder = fresh_dir(spark, "configs")
    documents.write.partitionBy("document").text(folder)
    return rf.load_rule_configs(spark, folder).select(
        "config_key", "rule_id", "table_name", "column_name", "severity", "category", "last_updated", "is_active"
    )


@case(
    "assessment_results_io",
    rule_cases.PER
    + "SELECT *, CAST(TIMESTAMP '2024-03-02 08:00:00' AS TIMESTAMP) AS run_ts, 'per' AS run_table, "
    + "CAST(NULL AS VARCHAR) AS run_column, DATE '2024-03-02' AS run_date FROM ("
    + "\nUNION ALL ".join(rule_cases.result_sql(r, c, "per") for r, c in (("ppl_001", "age"), ("dq1", "email")))
    + ") t",
)
def assessment_results_io(spark, sf):
    folder = fresh_dir(spark, "results")
    df = rule_cases.per(spark, sf)
    rules = [PACK["ppl_001"].on("age"), PACK["dq1"].on("email")]
    rs.save_results(rule_cases.rounded(run_rules(df, rules[:1])), folder, datetime(2024, 3, 1, 8), "per", "age")
    rs.save_results(rule_cases.rounded(run_rules(df, rules)), folder, datetime(2024, 3, 2, 8), "per")
    return rs.load_latest_results(spark, folder)


@case(
    "metrics_history_load",
    v.with_views(run_history=v.RUN_HISTORY)
    + """SELECT dataset, CASE WHEN dataset <> 'view' THEN CAST(run_date AS TIMESTAMP) END AS timestamp,
       round(completeness, 9) AS completeness, round(accuracy, 9) AS accuracy FROM run_history""",
)
def metrics_history_load(spark, sf):
    folder = fresh_dir(spark, "history")
    v.view(spark, sf, v.RUN_HISTORY).selectExpr(
        "dataset",
        "CASE WHEN dataset = 'view' THEN 'not a time' ELSE date_format(run_date, 'yyyy-MM-dd HH:mm:ss') END AS timestamp",
        "round(completeness, 9) AS completeness",
        "round(accuracy, 9) AS accuracy",
    ).write.csv(folder, header=True)
    return rs.load_metrics_history(spark, folder, ["completeness", "accuracy"], keys=["dataset"])
