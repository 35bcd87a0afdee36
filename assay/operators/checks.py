"""Default column checks and the pass/fail report."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.functions import predicates as p
from assay.operators.profile import column_class, q, require_column
from assay.plans.shape import count_where, one_scan, text, union_all


@dataclass(frozen=True)
class Check:
    """A named condition that every row of a column should meet; it must never be null."""

    name: str
    description: str
    passes: Callable[[Column], Column]


MISSING_VALUES = Check("missing_values", "Check for missing values", lambda c: c.isNotNull())
NEGATIVE_VALUES = Check("negative_values", "Check for negative values", lambda c: p.null_fails(c >= 0))
ZERO_VALUES = Check("zero_values", "Check for zero values", lambda c: p.null_passes(c != 0))
EMPTY_STRINGS = Check("empty_strings", "Check for empty strings", p.not_blank)
SPECIAL_CHARACTERS = Check("special_characters", "Check for special characters", p.plain_text)

BY_CLASS = {
    "numeric": [MISSING_VALUES, NEGATIVE_VALUES, ZERO_VALUES],
    "string": [MISSING_VALUES, EMPTY_STRINGS, SPECIAL_CHARACTERS],
    "other": [MISSING_VALUES],
}


def default_checks(df: DataFrame, column: str) -> list[Check]:
    """The checks that fit the type of the column."""
    require_column(df, column)
    return BY_CLASS[column_class(df, column)]


def _applicable(df: DataFrame, column: str, check: Check) -> str | None:
    """The error a check would raise on this column, or None; only the analyser runs."""
    try:
        df.select(check.passes(q(column)))
    except AnalysisException as error:
        return error.getMessage().split("\n")[0]
    return None


def run_column_checks(df: DataFrame, checks: dict[str, list[Check]]) -> DataFrame:
    """One row per column and check from a single scan.

    ``(column_name, check_name, description, success, failed_rows, error)``; a check that
    does not fit its column gives a row with ``success = false`` and an error text.
    """
    planned = [(c, check, _applicable(df, c, check)) for c, cs in checks.items() for check in cs]

    def fields(column: str, check: Check):
        return lambda failed: {
            "column_name": text(column),
            "check_name": text(check.name),
            "description": text(check.description),
            "success": f"{failed} = 0",
            "failed_rows": failed,
            "error": text(None),
        }

    frames = one_scan(
        df,
        [(count_where(~check.passes(q(c))), fields(c, check)) for c, check, error in planned if error is None],
    )
    bad = [(c, check.name, check.description, False, None, error) for c, check, error in planned if error]
    if bad:
        schema = (
            "column_name string, check_name string, description string, success boolean, "
            "failed_rows bigint, error string"
        )
        frames.append(df.sparkSession.createDataFrame(bad, schema))
    return union_all(frames)


def default_column_checks(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Type-driven checks of the given columns (default: all), still one scan."""
    return run_column_checks(df, {c: default_checks(df, c) for c in columns or df.columns})


def passfail_rows(
    df: DataFrame,
    checks: dict[str, list[Check]],
    key: str,
    status: str | None = None,
    check_name: str | None = None,
) -> DataFrame:
    """Every row once per check with its status: a narrow map, no shuffle.

    ``check_name`` drops other checks before any row is multiplied, ``status`` keeps only
    Passed or Failed.
    """
    marks = [
        F.struct(
            F.lit(c).alias("column_checked"),
            F.lit(check.name).alias("check_name"),
            q(c).cast("string").alias("value"),
            F.when(check.passes(q(c)), "Passed").otherwise("Failed").alias("status"),
        )
        for c, cs in checks.items()
        for check in cs
        if check_name in (None, check.name)
    ]
    if not marks:
        raise ValueError(f"no check named {check_name}")
    marked = F.array(*marks)
    if status is not None:
        marked = F.filter(marked, lambda m: m["status"] == status)
    return df.select(q(key).alias(key), F.inline(marked))


def passfail_summary(df: DataFrame, checks: dict[str, list[Check]]) -> DataFrame:
    """Total, passed and failed rows per check, counted without building the report."""

    def fields(column: str, check: Check):
        return lambda passed: {
            "column_checked": text(column),
            "check_name": text(check.name),
            "total": "_total",
            "passed": passed,
            "failed": f"_total - {passed}",
        }

    return union_all(
        one_scan(df, [(count_where(check.passes(q(c))), fields(c, check)) for c, cs in checks.items() for check in cs])
    )
