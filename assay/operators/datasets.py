"""Quality run over a set of named datasets, its report, and suites of custom checks."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.functions import predicates as p
from assay.operators.profile import duplicate_count, q, string_columns
from assay.plans.shape import count_where, name, one_scan, rows_of, text, union_all


def date_columns(df: DataFrame) -> list[str]:
    """String columns whose name speaks of a date."""
    return [c for c in string_columns(df) if "date" in c.lower()]


def _fields(check: str, column: str | None):
    return lambda v: {"check_name": text(check), "column_name": text(column), "value": f"CAST({v} AS DOUBLE)"}


def _date_measures(df: DataFrame) -> list:
    return [(count_where(~p.is_date(q(c))), _fields("invalid_dates", c)) for c in date_columns(df)]


def invalid_dates(df: DataFrame) -> DataFrame:
    """``(check_name, column_name, value)``: non-null values that are no real date, per date column."""
    measures = _date_measures(df)
    if not measures:
        return df.sparkSession.createDataFrame([], "check_name string, column_name string, value double")
    return union_all(one_scan(df, measures))


def quality_checks(data: dict[str, DataFrame], threshold: float = 0.1) -> DataFrame:
    """``(dataset, check_name, column_name, value)`` for every dataset.

    Missing ratios above the threshold, duplicate rows and invalid dates for all datasets,
    e-mail and NINO format for ``people``. Per dataset: one scan for all row measures and
    one shuffle for the duplicates.
    """
    frames = []
    for dataset, df in data.items():
        measures = [
            (f"try_divide(count_if({name(c)} IS NULL), count(1))", _fields("missing_values", c)) for c in df.columns
        ]
        measures += _date_measures(df)
        if dataset == "people":
            for check, column, valid in (("invalid_emails", "email", p.is_email), ("invalid_ninos", "nino", p.is_nino)):
                if column in df.columns:
                    measures.append((count_where(~p.null_fails(valid(q(column)))), _fields(check, column)))
        rows = union_all(one_scan(df, measures))
        parts = [
            rows.where((F.col("check_name") != "missing_values") | (F.col("value") > threshold)),
            rows_of(duplicate_count(df), [_fields("duplicates", None)("duplicate_records")]),
        ]
        frames += [part.withColumn("dataset", F.lit(dataset)) for part in parts]
    return union_all(frames).select("dataset", "check_name", "column_name", "value")


def quality_report(results: DataFrame) -> DataFrame:
    """Only the issues: non-zero values, in a stable order."""
    return results.where("value > 0").orderBy("dataset", "check_name", "column_name")


class CheckSuite:
    """Named checks that run together.

    A check is a function from DataFrame to DataFrame, all with equal columns, or the condition that a
    violating row meets. Conditions share scans and give ``found``, the number of rows that meet them; if
    there are functions too, ``found`` must be their column as well.
    """

    def __init__(self) -> None:
        self._checks: dict[str, Callable[[DataFrame], DataFrame]] = {}
        self._conditions: dict[str, Column | str | Callable[[DataFrame], Column]] = {}

    def add_quality_check(self, title: str, check: Callable[[DataFrame], DataFrame]) -> "CheckSuite":
        self._conditions.pop(title, None)
        self._checks[title] = check
        return self

    def add_row_check(self, title: str, violates: Column | str | Callable[[DataFrame], Column]) -> "CheckSuite":
        """Count the rows for which ``violates`` is true: a column, SQL text, or a function from the table to a column."""
        self._checks.pop(title, None)
        self._conditions[title] = violates
        return self

    def run_quality_checks(self, df: DataFrame) -> DataFrame:
        """Union of all results with a leading ``quality_check``."""
        if not self._checks and not self._conditions:
            raise ValueError("no checks registered")

        def measure(violates) -> Column:
            if isinstance(violates, str):
                return count_where(F.expr(violates))
            return count_where(violates if isinstance(violates, Column) else violates(df))

        def fields(title: str):
            return lambda found: {"quality_check": text(title), "found": found}

        return union_all(
            [
                *one_scan(df, [(measure(c), fields(title)) for title, c in self._conditions.items()]),
                *[check(df).select(F.lit(title).alias("quality_check"), "*") for title, check in self._checks.items()],
            ]
        )
