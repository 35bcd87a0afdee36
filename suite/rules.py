"""Rule engine, rule pack, registry and rule statistics."""

from datetime import datetime

from pyspark.sql import functions as F

from assay.operators import registry as rg
from assay.operators import rules as ru
from assay.operators.rule_book import assess_registered
from assay.operators.rule_pack import OVERLAP, PACK, overlapping_rows
from assay.plans.lineage import fresh_dir
from assay.sources import results as rs
from suite import case
from suite import views as v

PER = v.with_views(per=v.PER)


def per(spark, sf):
    return v.view(spark, sf, v.PER)


# Violations in SQL, per rule id; the condition is null where the rule skips the row.
PHONE = r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b"
VIOLATES = {
    "gdpr_001": r"regexp_matches(CAST({c} AS VARCHAR), '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b')",
    "gdpr_002": f"regexp_matches({{c}}, '{PHONE}')",
    "gdpr_003": r"regexp_matches({c}, '\b\d{3}-\d{2}-\d{4}\b')",
    "gdpr_004": r"regexp_matches({c}, '\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b')",
    "gdpr_006": r"NOT regexp_matches({c}, '^[\w\.-]+@[\w\.-]+\.\w+$')",
    "gdpr_007": r"NOT regexp_matches({c}, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') OR {c} IS NOT NULL AND try_strptime({c}, '%Y-%m-%d') IS NULL",
    "gdpr_008": f"NOT regexp_matches({{c}}, '{PHONE}')",
    "ppl_001": "{c} NOT BETWEEN 18 AND 100",
    "asg_001": "date_diff('day', start_date, end_date) > 90",
    "asg_002": r"NOT regexp_matches({c}, '^P-\d{4}-\d{2}$')",
    "addr_001": r"NOT regexp_matches({c}, '^\d{5}(-\d{4})?$')",
    "addr_002": r"NOT regexp_matches({c}, '^[A-Z]{2}$')",
    "emp_001": "{c} NOT BETWEEN 30000 AND 200000",
    "emp_002": "{c} IS NULL",
    "dq1": "{c} IS NULL",
    "dq2": r"{c} IS NULL OR NOT regexp_matches({c}, '^\d{4}-\d{1,2}-\d{1,2}$') OR try_strptime({c}, '%Y-%m-%d') IS NULL",
}


def violates(rule_id, column):
    # Braces of the patterns rule out str.format.
    return "(" + VIOLATES[rule_id].replace("{c}", column) + ")"


def result_sql(rule_id, column, source):
    rule = PACK[rule_id]
    bad = f"CAST(count(*) FILTER ({violates(rule_id, column)}) AS BIGINT)"
    return (
        f"SELECT '{rule_id}' AS rule_id, '{column}' AS column_name, '{rule.severity}' AS severity, "
        f"'{rule.description}' AS description, count(*) AS total_records, {bad} AS violations, "
        f"round((count(*) - {bad}) * 100.0e0 / count(*), 6) AS compliance_rate, CAST(NULL AS VARCHAR) AS error "
        f"FROM {source}"
    )


def rounded(df):
    return df.withColumn("compliance_rate", F.round("compliance_rate", 6))


def documents(spark, sf):
    return v.table(spark, sf, "documents")


def assignments(spark, sf):
    return v.view(spark, sf, v.ASSIGNMENTS)


ASSIGNMENTS = v.with_views(assignments=v.ASSIGNMENTS)
SINGLE = {
    "rule_pii_email": ("gdpr_001", "text", "documents", documents),
    "rule_pii_phone": ("gdpr_002", "phone", "per", per),
    "rule_pii_ssn": ("gdpr_003", "reference", "per", per),
    "rule_pii_card": ("gdpr_004", "text", "documents", documents),
    "rule_email_format": ("gdpr_006", "email", "per", per),
    "rule_date_format_strict": ("gdpr_007", "date_of_birth", "per", per),
    "rule_phone_format": ("gdpr_008", "phone", "per", per),
    "rule_age_range": ("ppl_001", "age", "per", per),
    "rule_duration_limit": ("asg_001", "end_date", "assignments", assignments),
    "rule_project_code": ("asg_002", "project_code", "per", per),
    "rule_postal_code": ("addr_001", "postal_code", "per", per),
    "rule_country_code": ("addr_002", "country", "per", per),
    "rule_salary_range": ("emp_001", "salary", "per", per),
    "rule_required_ref": ("emp_002", "department_id", "per", per),
    "rule_required_field": ("dq1", "age", "per", per),
    "rule_date_parse": ("dq2", "date_of_birth", "per", per),
}
PREFIX = {"documents": "", "per": PER, "assignments": ASSIGNMENTS}


def single(rule_id, column, load):
    def run(spark, sf):
        return rounded(ru.run_rules(load(spark, sf), [PACK[rule_id].on(column)]))

    return run


for name, (rule_id, column, source, load) in SINGLE.items():
    case(name, PREFIX[source] + result_sql(rule_id, column, source))(single(rule_id, column, load))


@case(
    "rule_overlap",
    ASSIGNMENTS
    + """SELECT * FROM assignments WHERE employee_id IN (
  SELECT a1.employee_id FROM assignments a1 JOIN assignments a2 ON a1.employee_id = a2.employee_id
  WHERE a1.id <> a2.id AND a1.start_date < a2.end_date AND a2.start_date < a1.end_date)""",
)
def rule_overlap(spark, sf):
    return overlapping_rows(assignments(spark, sf))


# --- engine -----------------------------------------------------------------------------------

PLACED = [
    ("gdpr_001", "email"), ("gdpr_002", "phone"), ("gdpr_003", "reference"), ("gdpr_004", "phone"),
    ("gdpr_006", "email"), ("gdpr_007", "date_of_birth"), ("gdpr_008", "phone"), ("ppl_001", "age"),
    ("asg_002", "project_code"), ("addr_001", "postal_code"), ("addr_002", "country"), ("emp_001", "salary"),
    ("emp_002", "department_id"), ("dq1", "age"), ("dq2", "date_of_birth"), ("gdpr_001", "age"),
]


def placed_rules():
    return [PACK[r].on(c, "per") for r, c in PLACED]


def broken_rules():
    return [
        ru.Rule("broken_column", "no_such_column > 1", "age"),
        ru.Rule("broken_pattern", "email RLIKE '('", "email"),
        ru.Rule("no_boolean", "age + 1", "age"),
        ru.Rule("broken_syntax", "age >", "age"),
    ]


ALL_RESULTS = "\nUNION ALL ".join(result_sql(r, c, "per") for r, c in PLACED)


@case(
    "rule_validation",
    "WITH customers AS (SELECT * FROM customer)\n"
    "SELECT 'balance' AS rule_id, 'c_acctbal' AS column_name, 'High' AS severity, '' AS description, "
    "count(*) AS total_records, count(*) FILTER (c_acctbal NOT BETWEEN 0 AND 9000) AS violations, "
    "round((count(*) - count(*) FILTER (c_acctbal NOT BETWEEN 0 AND 9000)) * 100.0e0 / count(*), 6) AS compliance_rate, "
    "CAST(NULL AS VARCHAR) AS error FROM customers",
)
def rule_validation(spark, sf):
    rule = ru.Rule("balance", "column_name NOT BETWEEN 0 AND 9000", "c_acctbal", severity="High")
    return rounded(ru.run_rules(v.table(spark, sf, "customer"), [rule]))


@case(
    "rule_error_isolation",
    PER
    + f"SELECT rule_id, column_name, total_records, violations, error IS NOT NULL AS failed FROM ({ALL_RESULTS}) t"
    + "".join(
        f"\nUNION ALL SELECT '{r}', '{c}', NULL, NULL, true"
        for r, c in (("broken_column", "age"), ("broken_pattern", "email"), ("no_boolean", "age"), ("broken_syntax", "age"))
    ),
)
def rule_error_isolation(spark, sf):
    return ru.run_rules(per(spark, sf), [*placed_rules(), *broken_rules()]).select(
        "rule_id", "column_name", "total_records", "violations", F.col("error").isNotNull().alias("failed")
    )


@case(
    "rule_sample_violations",
    PER
    + ", marked AS ("
    + "\nUNION ALL ".join(
        f"SELECT id AS key, '{r}' AS rule_id, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM per WHERE {violates(r, c)}"
        for r, c in PLACED
    )
    + """)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY rule_id, column_name ORDER BY key) AS INTEGER) AS position FROM marked) t
WHERE position <= 5""",
)
def rule_sample_violations(spark, sf):


    return ru.sample_violations(per(spark, sf), placed_rules(), "id", 5)


COLUMNS = ["id", "employee_id", "first_name", "last_name", "job_id", "department_id", "manager_id", "salary",
           "commission_pct", "hire_date", "age", "email", "nino", "date_of_birth", "postal_code", "country", "phone",
           "reference", "project_code", "latitude", "longitude"]
NUMERIC = ["id", "employee_id", "department_id", "manager_id", "salary", "commission_pct", "age", "latitude", "longitude"]
REGISTERED = [*PLACED, ("not_null", "*"), ("broken_column", "age")]


def rule_events(spark, sf):
    """Events that save and stop rules with their predicates, written to a log and read back."""
    codes = {r: PACK[r].predicate for r, _ in PLACED} | {
        "not_null": "column_name IS NULL",
        "broken_column": "no_such_column > 1",
    }
    catalogue = spark.createDataFrame(
        [(no, r, "per", c, "cat", r, codes[r]) for no, (r, c) in enumerate(REGISTERED)],
        "rule_no bigint, rule_id string, table_name string, column_name string, category string, description string, predicate string",
    )
    log = fresh_dir(spark, "rule-log")
    rg.append_event(v.view(spark, sf, v.RULE_EVENTS).join(F.broadcast(catalogue), "rule_no").drop("rule_no"), log)
    return spark.read.parquet(log)


def registered_counts():
    """Per registered rule and column: rows for which its predicate is true, false and unknown."""
    for no, (r, c) in enumerate(REGISTERED[:-1]):
        for column in COLUMNS if c == "*" else [c]:
            test = f"({column} IS NULL)" if c == "*" else violates(r, column)
            yield (
                f"SELECT {no} AS rule_no, '{r}' AS name, '{column}' AS column_name, count(*) FILTER ({test}) AS t, "
                f"count(*) FILTER (NOT {test}) AS f, count(*) FILTER ({test} IS NULL) AS u FROM per"
            )


REGISTRY = (
    v.with_views(per=v.PER, rule_events=v.RULE_EVENTS)[:-1]
    + """,
saves AS (SELECT *, row_number() OVER (PARTITION BY rule_no ORDER BY ts DESC, event_id DESC) AS rn
          FROM rule_events WHERE action = 'save'),
stops AS (SELECT *, row_number() OVER (PARTITION BY rule_no ORDER BY ts DESC, event_id DESC) AS rn
          FROM rule_events WHERE action = 'deactivate'),
standing AS (SELECT s.rule_no, coalesce(s.on_null, 'skip') AS on_null, coalesce(s.polarity, 'violation') AS polarity
             FROM saves s LEFT JOIN stops d ON s.rule_no = d.rule_no AND d.rn = 1
             WHERE s.rn = 1 AND NOT coalesce(d.ts > s.ts OR d.ts = s.ts AND d.event_id > s.event_id, false)),
counted AS ("""
    + "\nUNION ALL ".join(registered_counts())
    + """),
judged AS (SELECT name, column_name, CASE polarity WHEN 'pass' THEN f ELSE t END
                  + CASE on_null WHEN 'violation' THEN u ELSE 0 END AS n
           FROM counted JOIN standing USING (rule_no))
"""
)


@case(
    "assessment_run",
    REGISTRY
    + "SELECT 'basic_stats' AS section, 'row_count' AS name, CAST(NULL AS VARCHAR) AS column_name, "
    + "CAST(NULL AS BOOLEAN) AS success, CAST(count(*) AS DOUBLE) AS value, false AS failed FROM per"
    + "\nUNION ALL SELECT 'basic_stats', 'duplicates', NULL, NULL, CAST(coalesce(sum(n - 1), 0) AS DOUBLE), false FROM "
    + f"(SELECT count(*) AS n FROM per GROUP BY {', '.join(COLUMNS)}) t"
    + "".join(
        f"\nUNION ALL SELECT 'missing_values', 'missing', '{c}', NULL, CAST(count(*) - count({c}) AS DOUBLE), false FROM per"
        for c in COLUMNS
    )
    + "".join(
        f"\nUNION ALL SELECT 'correlations', '{b}', '{a}', NULL, round(corr({a}, {b}), 6), false FROM per"
        for i, a in enumerate(NUMERIC)
        for b in NUMERIC[i + 1 :]
    )
    + "\nUNION ALL SELECT 'rules', name, column_name, n = 0, CAST(n AS DOUBLE), false FROM judged"
    + f"\nUNION ALL SELECT 'rules', 'broken_column', 'age', false, NULL, true FROM standing WHERE rule_no = {len(PLACED) + 1}",
)
def assessment_run(spark, sf):
    """All columns of the table, and the rules that its event log holds at the end."""
    result = assess_registered(rule_events(spark, sf), "per", per(spark, sf))
    return result.select(
        "section",
        "name",
        "column_name",
        "success",
        F.round("value", 6).alias("value"),
        F.col("error").isNotNull().alias("failed"),
    )


FAILS = {
    "age_of_text": ("CAST(column_name AS INT) < 18", "reference"),
    "ratio": ("salary / (age - 20) > 5000", "salary"),
    "born_late": ("to_date(column_name, 'yyyy-MM-dd') > DATE '2000-01-01'", "date_of_birth"),
}


@case(
    "rule_value_errors",
    PER
    + "SELECT rule_id, column_name, total_records, violations, CAST(NULL AS BIGINT) AS failed_rows FROM ("
    + "\nUNION ALL ".join(result_sql(r, c, "per") for r, c in PLACED)
    + r""") t
UNION ALL SELECT 'age_of_text', 'reference', NULL, NULL, count(*) FILTER (reference IS NOT NULL AND try_cast(reference AS INTEGER) IS NULL) FROM per
UNION ALL SELECT 'ratio', 'salary', NULL, NULL, count(*) FILTER (age = 20 AND salary IS NOT NULL) FROM per
UNION ALL SELECT 'born_late', 'date_of_birth', NULL, NULL, count(*) FILTER (date_of_birth IS NOT NULL AND
  (try_strptime(date_of_birth, '%Y-%m-%d') IS NULL OR NOT regexp_matches(date_of_birth, '^\d{4}-\d{2}-\d{2}$'))) FROM per""",
)
def rule_value_errors(spark, sf):
    """Rules that meet values they cannot be computed for, in one scan with rules that can."""
    failing = [ru.Rule(name, predicate, column) for name, (predicate, column) in FAILS.items()]
    return ru.run_rules(per(spark, sf), [*placed_rules(), *failing]).select(
        "rule_id",
        "column_name",
        "total_records",
        "violations",
        F.regexp_extract("error", r"for (\d+) rows", 1).cast("bigint").alias("failed_rows"),
    )


@case(
    "assessment_run_column",
    ASSIGNMENTS
    + """SELECT 'basic_stats' AS section, 'row_count' AS name, NULL AS column_name, CAST(NULL AS BOOLEAN) AS success, CAST(count(*) AS DOUBLE) AS value FROM assignments
UNION ALL SELECT 'checks', 'missing_values', 'employee_id', count(*) = count(employee_id), CAST(count(*) - count(employee_id) AS DOUBLE) FROM assignments
UNION ALL SELECT 'checks', 'negative_values', 'employee_id', count(*) FILTER (employee_id < 0) = 0, CAST(count(*) FILTER (employee_id < 0) AS DOUBLE) FROM assignments
UNION ALL SELECT 'checks', 'zero_values', 'employee_id', count(*) FILTER (employee_id = 0) = 0, CAST(count(*) FILTER (employee_id = 0) AS DOUBLE) FROM assignments
UNION ALL SELECT 'rules', 'dq1', 'employee_id', count(*) = count(employee_id), CAST(count(*) - count(employee_id) AS DOUBLE) FROM assignments
UNION ALL SELECT 'rules', 'asg_003', 'employee_id', count(*) = 0, CAST(count(*) AS DOUBLE) FROM assignments WHERE employee_id IN (
  SELECT a1.employee_id FROM assignments a1 JOIN assignments a2 ON a1.employee_id = a2.employee_id
  WHERE a1.id <> a2.id AND a1.start_date < a2.end_date AND a2.start_date < a1.end_date)""",
)
def assessment_run_column(spark, sf):
    rules = [PACK["dq1"].on("employee_id"), PACK["asg_001"].on("end_date")]
    return ru.assessment_run(assignments(spark, sf), rules, [OVERLAP], column="employee_id").drop("error")


# --- registry ---------------------------------------------------------------------------------

LOG = v.with_views(rule_log=v.RULE_LOG)
STATE = (
    LOG[:-1]
    + """,
saves AS (SELECT *, row_number() OVER (PARTITION BY config_key ORDER BY ts DESC, event_id DESC) AS rn
          FROM rule_log WHERE action = 'save'),
stops AS (SELECT *, row_number() OVER (PARTITION BY config_key ORDER BY ts DESC, event_id DESC) AS rn
          FROM rule_log WHERE action = 'deactivate'),
state AS (SELECT s.config_key, s.rule_id, s.table_name, s.column_name, s.severity, s.category,
                 NOT coalesce(d.ts > s.ts OR d.ts = s.ts AND d.event_id > s.event_id, false) AS is_active,
                 s.ts AS last_updated, s.ts AS activated_at,
                 CASE WHEN d.ts > s.ts OR d.ts = s.ts AND d.event_id > s.event_id THEN d.ts END AS deactivated_at
          FROM saves s LEFT JOIN stops d ON s.config_key = d.config_key AND d.rn = 1 WHERE s.rn = 1)
"""
)
ATTRIBUTES = ["rule_id", "table_name", "column_name", "severity", "category"]


def state(spark, sf):
    return rg.current_rules(v.view(spark, sf, v.RULE_LOG), ATTRIBUTES)


TEMPLATES = """templates AS (SELECT DISTINCT rule_id AS id, category, severity, 'Rule ' || rule_id AS description,
  'column_name of table_name as ' || rule_id AS validation_code,
  'SELECT column_name FROM table_name' AS validation_code_sql FROM rule_log)
"""
TARGETS = [("per", "age"), ("per", "email"), ("assignments", "end_date")]


def templates(spark, sf):
    return (
        v.view(spark, sf, v.RULE_LOG)
        .selectExpr(
            "rule_id AS id",
            "category",
            "severity",
            "'Rule ' || rule_id AS description",
            "'column_name of table_name as ' || rule_id AS validation_code",
            "'SELECT column_name FROM table_name' AS validation_code_sql",
        )
        .distinct()
    )


@case(
    "rule_instantiate",
    LOG[:-1]
    + ",\n"
    + TEMPLATES
    + """, targets(table_name, column_name) AS (VALUES ('per', 'age'), ('per', 'email'), ('assignments', 'end_date'))
SELECT id || '_' || table_name || '_' || column_name AS config_key, id AS rule_id, table_name, column_name, description,
       replace(replace(validation_code, 'table_name', table_name), 'column_name', column_name) AS python_code,
       replace(replace(validation_code_sql, 'table_name', table_name), 'column_name', column_name) AS sql_code,
       severity, category
FROM templates, targets WHERE category = 'gdpr_rules' AND severity = 'High'""",
)
def rule_instantiate(spark, sf):
    return rg.instantiate_rules(templates(spark, sf), TARGETS, category="gdpr_rules", severity="High")


@case("rule_registry_current", STATE + "SELECT * FROM state")
def rule_registry_current(spark, sf):
    return state(spark, sf)


@case("active_rules", STATE + "SELECT * FROM state WHERE is_active AND category = 'data_quality_rules'")
def active_rules(spark, sf):
    return rg.active_rules(state(spark, sf), category="data_quality_rules")


@case(
    "rule_counts",
    STATE
    + """SELECT count(*) AS total_rules, count(*) FILTER (severity = 'Critical') AS critical_rules,
       count(DISTINCT table_name) AS tables_covered, count(*) FILTER (is_active) AS active_rules FROM state""",
)
def rule_counts(spark, sf):
    return rg.rule_counts(state(spark, sf))


@case(
    "rule_adoption",
    STATE[:-1]
    + ",\n"
    + TEMPLATES
    + """SELECT (SELECT count(*) FROM templates) AS available, (SELECT count(*) FROM state) AS configured,
       (SELECT count(*) FROM state WHERE is_active) AS active,
       round((SELECT count(*) FROM state WHERE is_active) * 100.0e0 / (SELECT count(*) FROM templates), 6) AS adoption_rate""",
)
def rule_adoption(spark, sf):
    result = rg.rule_adoption(templates(spark, sf), state(spark, sf))
    return result.withColumn("adoption_rate", F.round("adoption_rate", 6))


def by(attribute):
    def run(spark, sf):
        return rg.rules_by(state(spark, sf), attribute)

    return run


for name, attribute in (
    ("rules_by_severity", "severity"),
    ("rules_by_category", "category"),
    ("rules_by_table", "table_name"),
):
    case(name, STATE + f"SELECT {attribute}, count(*) AS rules FROM state GROUP BY {attribute} ORDER BY 2 DESC, 1")(
        by(attribute)
    )


@case(
    "rule_activity_timeline",
    STATE
    + """SELECT CAST(ts AS DATE) AS activity_date, activity, count(*) AS changes FROM (
  SELECT activated_at AS ts, 'activated' AS activity FROM state
  UNION ALL SELECT deactivated_at, 'deactivated' FROM state) t
WHERE ts IS NOT NULL GROUP BY 1, 2""",
)
def rule_activity_timeline(spark, sf):
    return rg.rule_activity_timeline(state(spark, sf))


@case("recent_rule_updates", STATE + "SELECT * FROM state ORDER BY last_updated DESC, config_key LIMIT 5")
def recent_rule_updates(spark, sf):
    return rg.recent_rule_updates(state(spark, sf), 5)


@case(
    "rule_execution_history",
    v.with_views(run_history=v.RUN_HISTORY)
    + """SELECT dataset AS rule_id, run_date AS run_ts, round(accuracy * 100, 6) AS compliance_rate,
       round(lag(accuracy * 100) OVER w, 6) AS previous_rate, max(run_date) OVER (PARTITION BY dataset) AS last_validated,
       round(accuracy * 100 - lag(accuracy * 100) OVER w, 6) AS change
FROM run_history WINDOW w AS (PARTITION BY dataset ORDER BY run_date)""",
)
def rule_execution_history(spark, sf):
    results = v.view(spark, sf, v.RUN_HISTORY).selectExpr(
        "dataset AS rule_id", "run_date AS run_ts", "accuracy * 100 AS compliance_rate"
    )
    rates = ["compliance_rate", "previous_rate", "change"]
    return rg.rule_execution_history(results).withColumns({c: F.round(c, 6) for c in rates})


RUNS = [(datetime(2024, 3, day, 8), keep) for day, keep in ((1, "id % 3 <> 0"), (2, "id % 3 <> 1"), (3, "id % 3 <> 2"))]
WATCHED = PLACED[:8]


@case(
    "rule_execution_saved",
    PER
    + ", saved AS ("
    + "\nUNION ALL ".join(
        f"SELECT rule_id, compliance_rate, TIMESTAMP '{ts}' AS run_ts FROM ({result_sql(r, c, f'(SELECT * FROM per WHERE {keep}) t')}) s"
        for ts, keep in RUNS
        for r, c in WATCHED
    )
    + """)
SELECT rule_id, CAST(run_ts AS TIMESTAMP) AS run_ts, compliance_rate, lag(compliance_rate) OVER w AS previous_rate,
       CAST(max(run_ts) OVER (PARTITION BY rule_id) AS TIMESTAMP) AS last_validated,
       round(compliance_rate - lag(compliance_rate) OVER w, 6) AS change
FROM saved WINDOW w AS (PARTITION BY rule_id ORDER BY run_ts)""",
)
def rule_execution_saved(spark, sf):
    """Runs are saved to disk, the last one twice, and their history is read back."""
    folder = fresh_dir(spark, "runs")
    people = per(spark, sf)
    for ts, keep in [*RUNS, RUNS[-1]]:
        results = ru.run_rules(people.where(keep), [PACK[r].on(c, "per") for r, c in WATCHED])
        rs.save_results(rounded(results), folder, ts, "per")
    saved = rs.load_results(spark, folder).select("rule_id", "run_ts", "compliance_rate")
    return rg.rule_execution_history(saved).withColumn("change", F.round("change", 6))
