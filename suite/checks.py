"""Default checks, pass/fail report, expectations, validators and runs over datasets."""

from pyspark.sql import functions as F

from assay.functions import predicates as p
from assay.operators import checks as ck
from assay.operators import datasets as ds
from assay.operators import expectations as ex
from suite import case
from suite import views as v
from suite.profiling import PER_CLASSES

PER = v.with_views(per=v.PER)

# Conditions that a passing row meets, in SQL.
PASS = {
    "missing_values": "{c} IS NOT NULL",
    "negative_values": "coalesce({c} >= 0, false)",
    "zero_values": "coalesce({c} <> 0, true)",
    "empty_strings": r"coalesce(length(regexp_replace({c}, '^\s+|\s+$', '', 'g')) > 0, false)",
    "special_characters": r"coalesce(regexp_matches({c}, '^[a-zA-Z0-9\s]*$'), true)",
}
TEXT = {
    "missing_values": "Check for missing values",
    "negative_values": "Check for negative values",
    "zero_values": "Check for zero values",
    "empty_strings": "Check for empty strings",
    "special_characters": "Check for special characters",
}
BY_CLASS = {
    "numeric": ["missing_values", "negative_values", "zero_values"],
    "string": ["missing_values", "empty_strings", "special_characters"],
    "other": ["missing_values"],
}
DEFAULTS = {c: BY_CLASS[kind] for c, kind in PER_CLASSES.items()}


def per(spark, sf):
    return v.view(spark, sf, v.PER)


def check_sql(plan):
    """The check report in SQL for ``column -> check names``."""
    branches = []
    for c, names in plan.items():
        for name in names:
            ok = PASS[name].format(c=c)
            branches.append(
                f"SELECT '{c}' AS column_name, '{name}' AS check_name, '{TEXT[name]}' AS description, "
                f"coalesce(bool_and({ok}), true) AS success, CAST(count(*) FILTER (NOT {ok}) AS BIGINT) AS failed_rows, "
                "CAST(NULL AS VARCHAR) AS error FROM per"
            )
    return PER + "\nUNION ALL ".join(branches)


def single(check, columns):
    """Query of one check on some columns."""

    def run(spark, sf):
        return ck.run_column_checks(per(spark, sf), {c: [check] for c in columns})

    return run


for check, columns in (
    (ck.MISSING_VALUES, ["salary", "country", "first_name", "hire_date"]),
    (ck.NEGATIVE_VALUES, ["salary", "age", "latitude"]),
    (ck.ZERO_VALUES, ["salary", "age", "commission_pct"]),
    (ck.EMPTY_STRINGS, ["country", "email", "first_name"]),
    (ck.SPECIAL_CHARACTERS, ["country", "email", "first_name"]),
):
    case(f"check_{check.name}", check_sql({c: [check.name] for c in columns}))(single(check, columns))


@case("default_column_checks", check_sql(DEFAULTS))
def default_column_checks(spark, sf):
    return ck.default_column_checks(per(spark, sf), list(DEFAULTS))


REPORTED = {"age": [ck.MISSING_VALUES, ck.NEGATIVE_VALUES], "country": [ck.EMPTY_STRINGS, ck.SPECIAL_CHARACTERS]}


def report_sql():
    return PER + "\nUNION ALL ".join(
        f"SELECT id, '{c}' AS column_checked, '{k.name}' AS check_name, CAST({c} AS VARCHAR) AS value, "
        f"CASE WHEN {PASS[k.name].format(c=c)} THEN 'Passed' ELSE 'Failed' END AS status FROM per"
        for c, ks in REPORTED.items()
        for k in ks
    )


@case("passfail_rows", report_sql())
def passfail_rows(spark, sf):
    return ck.passfail_rows(per(spark, sf), REPORTED, "id")


@case(
    "passfail_summary",
    PER
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_checked, '{k.name}' AS check_name, count(*) AS total, "
        f"CAST(count(*) FILTER ({PASS[k.name].format(c=c)}) AS BIGINT) AS passed, "
        f"CAST(count(*) FILTER (NOT {PASS[k.name].format(c=c)}) AS BIGINT) AS failed FROM per"
        for c, ks in REPORTED.items()
        for k in ks
    ),
)
def passfail_summary(spark, sf):
    return ck.passfail_summary(per(spark, sf), REPORTED)


@case(
    "passfail_filter",
    report_sql().replace(PER, PER + "SELECT * FROM (", 1) + ") t WHERE status = 'Failed' AND check_name = 'empty_strings'",
)
def passfail_filter(spark, sf):
    return ck.passfail_rows(per(spark, sf), REPORTED, "id", status="Failed", check_name="empty_strings")


# --- expectations -----------------------------------------------------------------------------


def union(frames):
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


@case(
    "expect_not_null",
    PER
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) = count({c}) AS success, count(*) AS element_count, "
        f"count(*) - count({c}) AS null_count, round((count(*) - count({c})) * 100.0e0 / count(*), 6) AS null_percent FROM per"
        for c in ("nino", "email", "id")
    ),
)
def expect_not_null(spark, sf):
    result = union([ex.expect_not_null(per(spark, sf), c) for c in ("nino", "email", "id")])
    return result.withColumn("null_percent", F.round("null_percent", 6))


@case(
    "expect_unique",
    PER
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) = count(DISTINCT {c}) AS success, count(*) AS element_count, "
        f"count(*) - count(DISTINCT {c}) AS duplicate_count, count(DISTINCT {c}) AS unique_count, "
        f"round((count(*) - count(DISTINCT {c})) * 100.0e0 / count(*), 6) AS duplicate_percent FROM per"
        for c in ("nino", "email", "id")
    ),
)
def expect_unique(spark, sf):
    result = union([ex.expect_unique(per(spark, sf), c) for c in ("nino", "email", "id")])
    return result.withColumn("duplicate_percent", F.round("duplicate_percent", 6))


def _range_sql(outside):
    return (
        f"SELECT 'salary' AS column_name, count(*) FILTER ({outside}) = 0 AS success, count(salary) AS element_count, "
        f"count(*) FILTER ({outside}) AS violation_count, "
        f"round(count(*) FILTER ({outside}) * 100.0e0 / count(salary), 6) AS violation_percent, "
        "min(salary) AS min_value, max(salary) AS max_value, CAST(NULL AS VARCHAR) AS error FROM per"
    )


@case(
    "expect_in_range",
    PER
    + _range_sql("salary NOT BETWEEN 30000 AND 200000")
    + "\nUNION ALL "
    + _range_sql("salary < 10000")
    + "\nUNION ALL "
    + _range_sql("salary > 150000")
    + "\nUNION ALL SELECT 'salary', true, NULL, NULL, NULL, NULL, NULL, 'No range specified'"
    + "\nUNION ALL SELECT 'email', false, NULL, NULL, NULL, NULL, NULL, 'Column is not numeric'",
)
def expect_in_range(spark, sf):
    df = per(spark, sf)
    result = union(
        [
            ex.expect_in_range(df, "salary", 30000, 200000),
            ex.expect_in_range(df, "salary", min_value=10000),
            ex.expect_in_range(df, "salary", max_value=150000),
            ex.expect_in_range(df, "salary"),
            ex.expect_in_range(df, "email", 0, 1),
        ]
    )
    return result.withColumn("violation_percent", F.round("violation_percent", 6))


# --- validators ---------------------------------------------------------------------------------

DATE_OK = (
    r"CASE WHEN {c} IS NOT NULL THEN regexp_matches({c}, '^\d{4}-\d{1,2}-\d{1,2}$') AND try_strptime({c}, '%Y-%m-%d') IS NOT NULL END"
)
EMAIL_OK = r"regexp_matches({c}, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')"
NINO_OK = r"regexp_matches({c}, '^[A-CEGHJ-PR-TW-Z][A-CEGHJ-NPR-TW-Z][0-9]{6}[A-D]$')"


def _ok(text, c):
    return text.replace("{c}", c)


@case(
    "validate_date_format",
    PER + f"SELECT id, date_of_birth AS value, {_ok(DATE_OK, 'date_of_birth')} AS valid FROM per",
)
def validate_date_format(spark, sf):
    return per(spark, sf).select(
        "id", F.col("date_of_birth").alias("value"), p.is_date(F.col("date_of_birth")).alias("valid")
    )


@case("validate_numeric_range", PER + "SELECT id, age AS value, coalesce(age BETWEEN 18 AND 65, false) AS valid FROM per")
def validate_numeric_range(spark, sf):
    return per(spark, sf).select("id", F.col("age").alias("value"), p.in_range(F.col("age"), 18, 65).alias("valid"))


@case("validate_email", PER + f"SELECT id, email AS value, {_ok(EMAIL_OK, 'email')} AS valid FROM per")
def validate_email(spark, sf):
    return per(spark, sf).select("id", F.col("email").alias("value"), p.is_email(F.col("email")).alias("valid"))


@case("validate_nino", PER + f"SELECT id, nino AS value, {_ok(NINO_OK, 'nino')} AS valid FROM per")
def validate_nino(spark, sf):
    return per(spark, sf).select("id", F.col("nino").alias("value"), p.is_nino(F.col("nino")).alias("valid"))


# --- datasets -----------------------------------------------------------------------------------


@case(
    "invalid_dates_auto",
    PER
    + f"SELECT 'invalid_dates' AS check_name, 'date_of_birth' AS column_name, "
    f"CAST(count(*) FILTER (NOT ({_ok(DATE_OK, 'date_of_birth')})) AS DOUBLE) AS value FROM per",
)
def invalid_dates_auto(spark, sf):
    return ds.invalid_dates(per(spark, sf))


SETS = v.with_views(people=v.PER, assignments=v.ASSIGNMENTS, addresses=v.ADDRESSES)
SET_COLUMNS = {
    "people": [
        "id", "employee_id", "first_name", "last_name", "job_id", "department_id", "manager_id", "salary",
        "commission_pct", "hire_date", "age", "email", "nino", "date_of_birth", "postal_code", "country", "phone",
        "reference", "project_code", "latitude", "longitude",
    ],
    "assignments": ["id", "employee_id", "job_id", "start_date", "end_date"],
    "addresses": ["id", "postal_code", "date_from"],
}


def quality_sql():
    branches = []
    for name, columns in SET_COLUMNS.items():
        for c in columns:
            branches.append(
                f"SELECT '{name}' AS dataset, 'missing_values' AS check_name, '{c}' AS column_name, "
                f"1 - count({c}) / CAST(count(*) AS DOUBLE) AS value FROM {name} "
                f"HAVING (count(*) - count({c})) / CAST(count(*) AS DOUBLE) > 0.1"
            )
        branches.append(
            f"SELECT '{name}', 'duplicates', NULL, CAST(coalesce(sum(n - 1), 0) AS DOUBLE) FROM "
            f"(SELECT count(*) AS n FROM {name} GROUP BY {', '.join(columns)}) t"
        )
    for name, c in (("people", "date_of_birth"), ("addresses", "date_from")):
        branches.append(
            f"SELECT '{name}', 'invalid_dates', '{c}', "
            f"CAST(count(*) FILTER (NOT ({_ok(DATE_OK, c)})) AS DOUBLE) FROM {name}"
        )
    branches.append(
        f"SELECT 'people', 'invalid_emails', 'email', CAST(count(*) FILTER (NOT coalesce({_ok(EMAIL_OK, 'email')}, false)) AS DOUBLE) FROM people"
    )
    branches.append(
        f"SELECT 'people', 'invalid_ninos', 'nino', CAST(count(*) FILTER (NOT coalesce({_ok(NINO_OK, 'nino')}, false)) AS DOUBLE) FROM people"
    )
    return "SELECT dataset, check_name, column_name, round(value, 9) AS value FROM (" + "\nUNION ALL ".join(branches) + ") t"


def datasets(spark, sf):
    return {
        "people": per(spark, sf),
        "assignments": v.view(spark, sf, v.ASSIGNMENTS),
        "addresses": v.view(spark, sf, v.ADDRESSES),
    }


@case("quality_checks", SETS + quality_sql())
def quality_checks(spark, sf):
    return ds.quality_checks(datasets(spark, sf)).withColumn("value", F.round("value", 9))


@case("quality_report", SETS + quality_sql() + " WHERE value > 0 ORDER BY dataset, check_name, column_name")
def quality_report(spark, sf):
    return ds.quality_report(ds.quality_checks(datasets(spark, sf))).withColumn("value", F.round("value", 9))


@case(
    "check_suite",
    PER
    + f"""SELECT 'nino_validation' AS quality_check, count(*) AS found FROM per WHERE NOT coalesce({_ok(NINO_OK, 'nino')}, false)
UNION ALL SELECT 'minors', count(*) FROM per WHERE age < 18
UNION ALL SELECT 'repeated_names', count(*) FROM (SELECT first_name FROM per GROUP BY first_name HAVING count(*) > 1) t""",
)
def check_suite(spark, sf):
    def found(rows):
        return rows.agg(F.count(F.lit(1)).alias("found"))

    suite = ds.CheckSuite()
    suite.add_row_check("nino_validation", ~p.null_fails(p.is_nino(F.col("nino"))))
    suite.add_row_check("minors", "age < 18")
    suite.add_quality_check(
        "repeated_names", lambda df: found(df.groupBy("first_name").count().where("count > 1"))
    )
    return suite.run_quality_checks(per(spark, sf))
