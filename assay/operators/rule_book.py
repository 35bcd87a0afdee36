"""Rules kept as data: predicates in the event log, compiled against the tables they name.

A save event carries, beside the attributes of a rule, its predicate, what an unknown outcome means
(``on_null``) and its polarity: a predicate that is true for a ``violation`` or for a ``pass``. Its target is
a column, or a kind of columns: ``*`` for all, ``*numeric``, ``*string`` and ``*time`` for those of a kind.
The current state is joined to the columns of the tables; what names no column of its table
becomes a rule with an error instead of being passed over.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.operators.registry import active_rules, current_rules
from assay.operators.rules import ASSESSMENT, Rule, SetRule, assessment_run

ATTRIBUTES = [
    "rule_id", "table_name", "column_name", "severity", "category", "description", "predicate", "on_null", "polarity",
]
POLARITIES, ON_NULL = ("violation", "pass"), ("skip", "violation")


@dataclass(frozen=True)
class Compiled:
    """Rules that can be tried on a table, and the reasons why others cannot."""

    rules: list[Rule]
    faults: list[tuple[Rule, str]]


def column_kind(kind: T.DataType) -> str:
    if isinstance(kind, T.NumericType):
        return "numeric"
    if isinstance(kind, T.StringType):
        return "string"
    return "time" if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else "other"


def table_columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, column_name, kind`` of all columns of the tables: a literal made from their schemas."""
    rows = [
        (table, field.name, column_kind(field.dataType)) for table, df in tables.items() for field in df.schema
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, kind string")


def placed_rules(events: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per active rule and column that it applies to, with ``fault`` where there is none.

    Only rules of the given tables are looked at. A missing ``on_null`` counts as skip, a missing
    polarity as violation.
    """
    spark = events.sparkSession
    wanted = active_rules(current_rules(events, ATTRIBUTES)).where(F.col("table_name").isin(*tables))
    columns = table_columns(spark, tables).select(
        F.col("table_name").alias("_table"), F.col("column_name").alias("_column"), "kind"
    )
    target = F.coalesce("column_name", F.lit("*"))
    # A name that a column really has comes before the meaning of the sign.
    applies = (F.col("table_name") == F.col("_table")) & (
        (target == F.col("_column")) | (target == "*") | (target == F.concat(F.lit("*"), F.col("kind")))
    )
    on_null, polarity = F.coalesce("on_null", F.lit("skip")), F.coalesce("polarity", F.lit("violation"))
    fault = (
        F.when(F.trim(F.coalesce("predicate", F.lit(""))) == "", F.lit("no predicate"))
        .when(~on_null.isin(*ON_NULL), F.concat(F.lit("unknown on_null: "), on_null))
        .when(~polarity.isin(*POLARITIES), F.concat(F.lit("unknown polarity: "), polarity))
        .when(F.col("_column").isNull(), F.concat(F.lit("no such column: "), target))
    )
    return wanted.join(F.broadcast(columns), applies, "left").select(
        "config_key",
        "rule_id",
        "table_name",
        F.coalesce("_column", "column_name").alias("column_name"),
        "severity",
        "category",
        "description",
        "predicate",
        on_null.alias("on_null"),
        polarity.alias("polarity"),
        fault.alias("fault"),
    )


def compile_rules(events: DataFrame, table_name: str, df: DataFrame) -> Compiled:
    """The rules of one table as they stand in the event log, in order of key and column.

    Rules become part of the plan, so those of one table are brought to the driver: a row per rule
    and column, whatever the size of the log or the table.
    """
    rules, faults = [], []
    placed = placed_rules(events, {table_name: df}).orderBy("config_key", "column_name")
    for row in placed.toLocalIterator():
        about = {
            "rule_id": row.rule_id,
            "column_name": row.column_name or "",
            "table_name": table_name,
            "severity": row.severity or "Medium",
            "category": row.category or "",
            "description": row.description or "",
        }
        if row.fault is not None:
            faults.append((Rule(predicate="false", **about), row.fault))
        else:
            predicate = f"NOT ({row.predicate})" if row.polarity == "pass" else row.predicate
            rules.append(Rule(predicate=predicate, on_null=row.on_null, **about))
    return Compiled(rules, faults)


def assess_registered(
    events: DataFrame, table_name: str, df: DataFrame, set_rules: list[SetRule] = (), column: str | None = None
) -> DataFrame:
    """:func:`assay.operators.rules.assessment_run` of a table, or one of its columns, by the event log alone."""
    compiled = compile_rules(events, table_name, df)
    result = assessment_run(df, compiled.rules, set_rules, column)
    bad = [
        ("rules", rule.rule_id, rule.column_name, False, None, fault)
        for rule, fault in compiled.faults
        if column is None or rule.column_name == column
    ]
    return result.unionByName(df.sparkSession.createDataFrame(bad, ASSESSMENT)) if bad else result
