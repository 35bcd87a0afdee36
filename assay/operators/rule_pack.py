"""The shipped rules, as violation predicates on ``column_name``, and the overlap rule."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from assay.operators.rules import Rule, SetRule
from assay.plans.skew import HOT_ROWS, salted_join

# Rule ids, severities, limits and patterns.
PHONE = r"\\b\\d{3}[-.]?\\d{3}[-.]?\\d{4}\\b"
PACK = {
    r.rule_id: r
    for r in [
        Rule(
            "gdpr_001",
            "contains(CAST(column_name AS STRING), '@')"  # cheap, and true of every match
            r" AND CAST(column_name AS STRING) RLIKE '\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}\\b'",
            severity="Critical",
            category="gdpr_rules",
            description="Holds an e-mail address",
        ),
        Rule(
            "gdpr_002",
            f"CAST(column_name AS STRING) RLIKE '{PHONE}'",
            severity="High",
            category="gdpr_rules",
            description="Holds a phone number",
        ),
        Rule(
            "gdpr_003",
            r"CAST(column_name AS STRING) RLIKE '\\b\\d{3}-\\d{2}-\\d{4}\\b'",
            severity="Critical",
            category="gdpr_rules",
            description="Holds a social security number",
        ),
        Rule(
            "gdpr_004",
            r"CAST(column_name AS STRING) RLIKE '\\b\\d{4}[-\\s]?\\d{4}[-\\s]?\\d{4}[-\\s]?\\d{4}\\b'",
            severity="Critical",
            category="gdpr_rules",
            description="Holds a payment card number",
        ),
        Rule(
            "gdpr_006",
            r"NOT column_name RLIKE '^[\\w\\.-]+@[\\w\\.-]+\\.\\w+\\z'",
            severity="High",
            category="gdpr_rules",
            description="Must be an e-mail address",
        ),
        Rule(
            "gdpr_007",
            r"NOT column_name RLIKE '^[0-9]{4}-[0-9]{2}-[0-9]{2}\\z'"
            " OR try_to_timestamp(column_name, 'yyyy-MM-dd') IS NULL AND column_name IS NOT NULL",
            severity="Medium",
            category="gdpr_rules",
            description="Must be a zero-padded, real date",
        ),
        Rule(
            "gdpr_008",
            f"NOT column_name RLIKE '{PHONE}'",
            severity="Medium",
            category="gdpr_rules",
            description="Must be a phone number",
        ),
        Rule(
            "ppl_001",
            "column_name NOT BETWEEN 18 AND 100",
            severity="High",
            category="table_specific_rules",
            description="Age from 18 to 100",
        ),
        Rule(
            "asg_001",
            "datediff(end_date, start_date) > 90",
            severity="High",
            category="table_specific_rules",
            description="Assignment of at most 90 days",
        ),
        Rule(
            "asg_002",
            r"NOT column_name RLIKE '^P-\\d{4}-\\d{2}\\z'",
            severity="Medium",
            category="table_specific_rules",
            description="Project code P-####-YY",
        ),
        Rule(
            "addr_001",
            r"NOT column_name RLIKE '^\\d{5}(-\\d{4})?\\z'",
            severity="High",
            category="table_specific_rules",
            description="Postal code of five or nine digits",
        ),
        Rule(
            "addr_002",
            r"NOT column_name RLIKE '^[A-Z]{2}\\z'",
            severity="High",
            category="table_specific_rules",
            description="Country code of two capitals",
        ),
        Rule(
            "emp_001",
            "column_name NOT BETWEEN 30000 AND 200000",
            severity="High",
            category="table_specific_rules",
            description="Salary from 30,000 to 200,000",
        ),
        Rule(
            "emp_002",
            "column_name IS NULL",
            severity="High",
            category="table_specific_rules",
            description="Reference must be set",
            on_null="violation",
        ),
        Rule(
            "dq1",
            "column_name IS NULL",
            severity="High",
            category="data_quality_rules",
            description="Required field must be set",
            on_null="violation",
        ),
        Rule(
            "dq2",
            r"NOT column_name RLIKE '^\\d{4}-\\d{1,2}-\\d{1,2}\\z'"
            " OR try_to_timestamp(column_name, 'yyyy-M-d') IS NULL",
            severity="High",
            category="data_quality_rules",
            description="Must be a real date",
            on_null="violation",
        ),
    ]
}


def overlapping_owners(df: DataFrame, owner: str, start: str, end: str) -> DataFrame:
    """Owners with two intervals that overlap (``a.start < b.end AND b.start < a.end``).

    Sound for ``end >= start``; reversed intervals and intervals with an open bound are left
    to rules of their own. Nothing is compared pairwise. Equal starts are merged first, with
    map-side combine: two intervals longer than zero from one start overlap, otherwise only
    the latest end counts. Then a day knows its own overlaps, first start and latest end, and
    a running maximum over the days of an owner finds those that reach into a later day. A
    window thus holds the starts of one owner and day, or the days of one owner, even if one
    owner has a third of the table.
    """
    intervals = df.where(
        F.col(owner).isNotNull() & F.col(start).isNotNull() & (F.col(end) >= F.col(start))
    ).select(F.col(owner).alias("owner"), F.col(start).alias("s"), F.col(end).alias("e"))
    starts = intervals.groupBy("owner", "s").agg(
        F.max("e").alias("e"), F.count(F.when(F.col("e") > F.col("s"), 1)).alias("long")
    )
    if isinstance(df.schema[start].dataType, DateType):
        days = starts.select(
            "owner",
            F.col("s").alias("day"),
            F.col("s").alias("first"),
            F.col("e").alias("last"),
            (F.col("long") > 1).alias("hit"),
        )
    else:
        within = Window.partitionBy("owner", "day").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
        reaches = F.max("e").over(within) > F.col("s")
        days = (
            starts.withColumn("day", F.to_date("s"))
            .withColumn("hit", (F.col("long") > 1) | F.coalesce(reaches, F.lit(False)))
            .groupBy("owner", "day")
            .agg(F.min("s").alias("first"), F.max("e").alias("last"), F.bool_or("hit").alias("hit"))
        )
    earlier = Window.partitionBy("owner").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return (
        days.withColumn("reached", F.max("last").over(earlier))
        .where(F.col("hit") | (F.col("reached") > F.col("first")))
        .select(F.col("owner").alias(owner))
        .distinct()
    )


def overlapping_rows(
    df: DataFrame,
    owner: str = "employee_id",
    start: str = "start_date",
    end: str = "end_date",
    key: str = "id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All rows of owners with an overlap."""
    offenders = overlapping_owners(df, owner, start, end)
    return salted_join(df, offenders, [owner], [key], "left_semi", hot_rows=hot_rows)


OVERLAP = SetRule(
    "asg_003",
    overlapping_rows,
    column_name="employee_id",
    severity="Critical",
    description="Assignments of one person must not overlap",
)
