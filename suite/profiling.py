"""Table and column profiling."""

from pyspark.sql import functions as F

from assay.operators import profile as pr
from assay.operators import stored_profile as sp
from assay.plans.lineage import fresh_dir
from suite import case
from suite import views as v

PER = v.with_views(per=v.PER)
PER_COLUMNS = [
    "id", "employee_id", "first_name", "last_name", "job_id", "department_id", "manager_id", "salary",
    "commission_pct", "hire_date", "age", "email", "nino", "date_of_birth", "postal_code", "country", "phone",
    "reference", "project_code", "latitude", "longitude",
]
PER_TYPES = {
    **dict.fromkeys(PER_COLUMNS, "string"),
    **dict.fromkeys(["id", "employee_id", "manager_id", "age"], "bigint"),
    **dict.fromkeys(["salary", "commission_pct", "latitude", "longitude"], "double"),
    "department_id": "int",
    "hire_date": "date",
}
WIDTHS = {"bigint": 8, "double": 8, "int": 4, "date": 4}
NUMERIC = [c for c in PER_COLUMNS if PER_TYPES[c] in ("bigint", "int", "double")]
STRINGS = [c for c in PER_COLUMNS if PER_TYPES[c] == "string"]
PER_CLASSES = {c: "numeric" if c in NUMERIC else "string" if c in STRINGS else "other" for c in PER_COLUMNS}


def per(spark, sf):
    return v.view(spark, sf, v.PER)


def each(columns, template):
    """One UNION ALL branch per column."""
    return "\nUNION ALL ".join(template.replace("{c}", c) for c in columns)


MISSING = each(
    PER_COLUMNS,
    "SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, count(*) AS total, "
    "(count(*) - count({c})) / CAST(count(*) AS DOUBLE) AS ratio FROM per",
)
DISTINCT = each(PER_COLUMNS, "SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM per")
NUMBERS = each(
    NUMERIC,
    "SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean, round(CAST(median({c}) AS DOUBLE), 6) AS median, "
    "round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min, "
    "round(CAST(max({c}) AS DOUBLE), 6) AS max FROM per",
)
TEXTS = each(
    STRINGS,
    "SELECT '{c}' AS column_name, round(avg(length({c})), 6) AS avg_length, "
    "CAST(max(length({c})) AS INTEGER) AS max_length, "
    "CAST(count(*) FILTER ({c} = '') AS BIGINT) AS empty_strings FROM per",
)


def rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


MEASURES = ["mean", "median", "std", "min", "max"]


@case("missing_by_column", PER + MISSING)
def missing_by_column(spark, sf):
    return pr.missing_by_column(per(spark, sf))


@case("missing_above_threshold", PER + f"SELECT * FROM ({MISSING}) t WHERE ratio > 0.1")
def missing_above_threshold(spark, sf):
    return pr.missing_above_threshold(per(spark, sf), 0.1)


@case("distinct_by_column", PER + DISTINCT)
def distinct_by_column(spark, sf):
    return pr.distinct_by_column(per(spark, sf))


def _bytes() -> str:
    fixed = [f"count({c}) * {WIDTHS[PER_TYPES[c]]}" for c in PER_COLUMNS if PER_TYPES[c] in WIDTHS]
    text = [f"coalesce(sum(strlen({c})), 0)" for c in STRINGS]
    return " + ".join(fixed + text)


@case(
    "table_basic_stats",
    PER
    + "SELECT 'table' AS section, 'row_count' AS name, CAST(count(*) AS VARCHAR) AS value FROM per"
    + f"\nUNION ALL SELECT 'table', 'column_count', '{len(PER_COLUMNS)}'"
    + f"\nUNION ALL SELECT 'table', 'logical_bytes', CAST({_bytes()} AS VARCHAR) FROM per"
    + "\nUNION ALL "
    + each(PER_COLUMNS, "SELECT 'missing_values', '{c}', CAST(count(*) - count({c}) AS VARCHAR) FROM per")
    + "".join(f"\nUNION ALL SELECT 'dtypes', '{c}', '{t}'" for c, t in PER_TYPES.items()),
)
def table_basic_stats(spark, sf):
    return pr.table_basic_stats(per(spark, sf))


RECORDS = v.with_views(records=v.RECORDS)


@case(
    "duplicate_count",
    RECORDS
    + "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_records "
    "FROM (SELECT count(*) AS n FROM records GROUP BY k1, k2) t",
)
def duplicate_count(spark, sf):
    return pr.duplicate_count(v.view(spark, sf, v.RECORDS), ["k1", "k2"])


@case(
    "duplicate_rows",
    RECORDS
    + """SELECT r.id, r.k1, r.k2 FROM records r
JOIN (SELECT k1, k2 FROM records GROUP BY k1, k2 HAVING count(*) > 1) g
  ON r.k1 IS NOT DISTINCT FROM g.k1 AND r.k2 IS NOT DISTINCT FROM g.k2""",
)
def duplicate_rows(spark, sf):
    return pr.duplicate_rows(v.view(spark, sf, v.RECORDS), ["k1", "k2"], ["id"])


CORRELATED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "unit"]
MEASURED = v.with_views(measures=v.MEASURES)


def _pair(a, b):
    if "unit" in (a, b):  # a constant column has no correlation
        return f"SELECT '{a}' AS column1, '{b}' AS column2, CAST(NULL AS DOUBLE) AS correlation"
    return f"SELECT '{a}' AS column1, '{b}' AS column2, round(corr({a}, {b}), 6) AS correlation FROM measures"


PAIRS = "\nUNION ALL ".join(_pair(a, b) for i, a in enumerate(CORRELATED) for b in CORRELATED[i + 1 :])


@case(
    "correlation_matrix",
    MEASURED
    + f", pairs AS ({PAIRS})\nSELECT * FROM pairs UNION ALL SELECT column2, column1, correlation FROM pairs"
    + "".join(
        f"\nUNION ALL SELECT '{c}', '{c}', CAST({'NULL' if c == 'unit' else 1} AS DOUBLE)" for c in CORRELATED
    ),
)
def correlation_matrix(spark, sf):
    return rounded(pr.correlation_matrix(v.view(spark, sf, v.MEASURES), CORRELATED), ["correlation"])


@case(
    "relationship_strength",
    MEASURED
    + f"""SELECT *, CASE WHEN abs(correlation) > 0.7 THEN 'strong' WHEN abs(correlation) > 0.3 THEN 'moderate'
       ELSE 'weak' END AS relationship FROM ({PAIRS}) t""",
)
def relationship_strength(spark, sf):
    return rounded(pr.relationship_strength(v.view(spark, sf, v.MEASURES), CORRELATED), ["correlation"])


@case("numeric_column_stats", PER + NUMBERS)
def numeric_column_stats(spark, sf):
    return rounded(pr.numeric_column_stats(per(spark, sf), NUMERIC), MEASURES)


@case("string_column_stats", PER + TEXTS)
def string_column_stats(spark, sf):
    return rounded(pr.string_column_stats(per(spark, sf), STRINGS), ["avg_length"])


@case(
    "top_values",
    PER
    + f""", long AS ({each(PER_COLUMNS, "SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM per")}),
counts AS (SELECT column_name, value, count(*) AS frequency FROM long WHERE value IS NOT NULL GROUP BY ALL)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY frequency DESC, value) AS INTEGER) AS position
  FROM counts) t WHERE position <= 5""",
)
def top_values(spark, sf):
    return pr.top_values(per(spark, sf), PER_COLUMNS, 5)


@case("sample_values", PER + "SELECT id, CAST(email AS VARCHAR) AS value FROM per ORDER BY id LIMIT 5")
def sample_values(spark, sf):
    return pr.sample_values(per(spark, sf), "email", "id", 5)


def _types():
    return ", ".join(f"('{c}', '{t}', '{PER_CLASSES[c]}')" for c, t in PER_TYPES.items())


@case(
    "table_profile",
    PER
    + f""", missing AS ({MISSING}), distincts AS ({DISTINCT}), numbers AS ({NUMBERS}), texts AS ({TEXTS}),
types(column_name, dtype, column_class) AS (VALUES {_types()})
SELECT * FROM missing JOIN types USING (column_name) JOIN distincts USING (column_name)
LEFT JOIN numbers USING (column_name) LEFT JOIN texts USING (column_name)""",
)
def table_profile(spark, sf):
    return rounded(pr.table_profile(per(spark, sf)), [*MEASURES, "avg_length"])


KEPT = ["column_name", "dtype", "missing", "total", "mean", "std", "min", "max", "avg_length", "max_length", "empty_strings"]


@case(
    "stored_profile",
    PER
    + f""", missing AS ({MISSING}), numbers AS ({NUMBERS}), texts AS ({TEXTS}),
types(column_name, dtype, column_class) AS (VALUES {_types()})
SELECT {', '.join(KEPT)} FROM missing JOIN types USING (column_name)
LEFT JOIN numbers USING (column_name) LEFT JOIN texts USING (column_name)""",
)
def stored_profile(spark, sf):
    """Parts by department, merged; medians and distinct counts, being sketches, are left to the tests."""
    path = fresh_dir(spark, "profile")
    sp.store_profile(per(spark, sf), path, "department_id")
    merged = sp.stored_profile(spark, path).select(*KEPT)
    return rounded(merged, ["mean", "std", "min", "max", "avg_length"])


@case(
    "column_histogram",
    """WITH bounds AS (SELECT min(value) AS low, max(value) AS high FROM events),
counts AS (
  SELECT least(CAST(floor((value - low) * 20 / (high - low)) AS INTEGER), 19) AS bucket, count(*) AS frequency
  FROM events, bounds GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bucket, round(low + (high - low) * i / 20, 6) AS lower,
       round(low + (high - low) * (i + 1) / 20, 6) AS upper, coalesce(frequency, 0) AS frequency
FROM bounds, range(20) r(i) LEFT JOIN counts ON counts.bucket = i""",
)
def column_histogram(spark, sf):
    return rounded(pr.column_histogram(v.table(spark, sf, "events"), "value", 20), ["lower", "upper"])


@case(
    "quality_dimensions",
    """WITH e AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS person,
       (event_id % 5) * 3600 AS lag FROM events)
SELECT event_type AS dataset, CAST(ts AS DATE) AS period, count(*) AS rows,
       round((count(person) + count(value) + count(props)) / CAST(3 * count(*) AS DOUBLE), 6) AS completeness,
       round(count(*) FILTER (NOT (value > 100) AND (person IS NULL OR person <> 5)) / CAST(count(*) AS DOUBLE), 6) AS accuracy,
       round(count(*) FILTER (lag <= 7200) / CAST(count(*) AS DOUBLE), 6) AS timeliness
FROM e GROUP BY 1, 2""",
)
def quality_dimensions(spark, sf):
    events = v.table(spark, sf, "events").withColumns(
        {
            "person": F.expr("CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END"),
            "lag": F.expr("(event_id % 5) * 3600"),
        }
    )
    result = pr.quality_dimensions(
        events,
        group=[F.col("event_type").alias("dataset"), F.to_date("ts").alias("period")],
        cells=["person", "value", "props"],
        violations=[F.col("value") > 100, F.col("person") == 5],
        lag_seconds=F.col("lag"),
        limit_seconds=7200,
    )
    return rounded(result, ["completeness", "accuracy", "timeliness"])


@case(
    "table_assessment",
    PER
    + "SELECT 'basic_stats' AS section, 'row_count' AS name, CAST(count(*) AS DOUBLE) AS value FROM per"
    + f"\nUNION ALL SELECT 'basic_stats', 'column_count', CAST({len(PER_COLUMNS)} AS DOUBLE)"
    + "\nUNION ALL SELECT 'basic_stats', 'duplicates', CAST(coalesce(sum(n - 1), 0) AS DOUBLE) FROM "
    + f"(SELECT count(*) AS n FROM per GROUP BY {', '.join(PER_COLUMNS)}) t"
    + "\nUNION ALL "
    + each(PER_COLUMNS, "SELECT 'missing_values', '{c}', CAST(count(*) - count({c}) AS DOUBLE) FROM per")
    + "".join(
        f"\nUNION ALL SELECT 'correlations', '{a}~{b}', round(corr({a}, {b}), 6) FROM per" for a, b in pr.pairs(NUMERIC)
    ),
)
def table_assessment(spark, sf):
    return rounded(pr.table_assessment(per(spark, sf).select(*PER_COLUMNS)), ["value"])


@case(
    "column_assessment",
    PER
    + """, s AS (SELECT country AS c, id FROM per)
SELECT 'basic_stats' AS section, 'dtype' AS name, 'string' AS value
UNION ALL SELECT 'basic_stats', 'missing', CAST(count(*) - count(c) AS VARCHAR) FROM s
UNION ALL SELECT 'basic_stats', 'distinct_values', CAST(count(DISTINCT c) AS VARCHAR) FROM s
UNION ALL SELECT 'string_stats', 'avg_length', CAST(round(avg(length(c)), 6) AS VARCHAR) FROM s
UNION ALL SELECT 'string_stats', 'max_length', CAST(max(length(c)) AS VARCHAR) FROM s
UNION ALL SELECT 'string_stats', 'empty_strings', CAST(count(*) FILTER (c = '') AS VARCHAR) FROM s
UNION ALL SELECT * FROM (SELECT 'sample_values', CAST(id AS VARCHAR), c FROM s ORDER BY id LIMIT 5) t""",
)
def column_assessment(spark, sf):
    return pr.column_assessment(per(spark, sf), "country", "id")
