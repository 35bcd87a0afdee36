"""Expectations on one column: not null, unique, in range. Each gives one row."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators.profile import column_class, q, require_column
from assay.plans.shape import count_where, percent


def expect_not_null(df: DataFrame, column: str) -> DataFrame:
    """``(column_name, success, element_count, null_count, null_percent)``"""
    require_column(df, column)
    counts = df.agg(F.count(F.lit(1)).alias("element_count"), count_where(q(column).isNull()).alias("null_count"))
    return counts.select(
        F.lit(column).alias("column_name"),
        (F.col("null_count") == 0).alias("success"),
        "element_count",
        "null_count",
        F.expr(percent("null_count", "element_count", 0.0)).alias("null_percent"),
    )


def expect_unique(df: DataFrame, column: str) -> DataFrame:
    """``(column_name, success, element_count, duplicate_count, unique_count, duplicate_percent)``

    Nulls have no distinct value, so each of them counts as a duplicate.
    """
    require_column(df, column)
    counts = df.agg(F.count(F.lit(1)).alias("element_count"), F.count_distinct(q(column)).alias("unique_count"))
    duplicates = F.col("element_count") - F.col("unique_count")
    return counts.select(
        F.lit(column).alias("column_name"),
        (duplicates == 0).alias("success"),
        "element_count",
        duplicates.alias("duplicate_count"),
        "unique_count",
        F.expr(percent("element_count - unique_count", "element_count", 0.0)).alias("duplicate_percent"),
    )


def expect_in_range(
    df: DataFrame, column: str, min_value: float | None = None, max_value: float | None = None
) -> DataFrame:
    """``(column_name, success, element_count, violation_count, violation_percent, min_value, max_value, error)``

    Nulls are left out of all counts. No bounds succeed with a note, a non-numeric column
    fails with an error; both are known from the arguments and the schema, without a scan.
    """
    require_column(df, column)
    error = None
    if column_class(df, column) != "numeric":
        error, success = "Column is not numeric", False
    elif min_value is None and max_value is None:
        error, success = "No range specified", True
    if error is not None:
        schema = (
            "column_name string, success boolean, element_count bigint, violation_count bigint, "
            "violation_percent double, min_value double, max_value double, error string"
        )
        return df.sparkSession.createDataFrame([(column, success, None, None, None, None, None, error)], schema)
    v = q(column).cast("double")
    outside = F.lit(False)
    if min_value is not None:
        outside = outside | (v < min_value)
    if max_value is not None:
        outside = outside | (v > max_value)
    counts = df.where(v.isNotNull()).agg(
        F.count(F.lit(1)).alias("element_count"),
        count_where(outside).alias("violation_count"),
        F.min(v).alias("min_value"),
        F.max(v).alias("max_value"),
    )
    return counts.select(
        F.lit(column).alias("column_name"),
        (F.col("violation_count") == 0).alias("success"),
        "element_count",
        "violation_count",
        F.expr(percent("violation_count", "element_count", 0.0)).alias("violation_percent"),
        "min_value",
        "max_value",
        F.lit(None).cast("string").alias("error"),
    )
