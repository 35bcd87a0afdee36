"""Rule engine: rules are SQL predicates that are true for violating rows.

Row rules of a table are compiled into shared aggregates, so one scan serves dozens of
rules and reads only the columns they use. A rule that cannot be analysed, is no boolean, or meets a
value that it cannot be computed for, becomes a result row with an error and leaves the others alone.
"""

import logging
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.functions.statistics import pearson
from assay.operators.checks import default_checks
from assay.operators.profile import duplicate_count, numeric_columns, pairs, q
from assay.operators.tolerant import tolerant
from assay.plans.shape import PAIRS_PER_PASS, count_where, name, one_scan, percent, rows_of, text, union_all

log = logging.getLogger(__name__)

RESULT = (
    "rule_id string, column_name string, severity string, description string, total_records bigint, "
    "violations bigint, compliance_rate double, error string"
)
ASSESSMENT = "section string, name string, column_name string, success boolean, value double, error string"


@dataclass(frozen=True)
class Rule:
    """``predicate`` is true for a violating row.

    ``column_name`` and ``table_name`` inside the text stand for the rule's own column and
    table. ``on_null`` says what an unknown outcome means: ``skip`` or ``violation``.
    """

    rule_id: str
    predicate: str
    column_name: str = ""
    table_name: str = ""
    severity: str = "Medium"
    category: str = ""
    description: str = ""
    on_null: str = "skip"

    def __post_init__(self) -> None:
        if self.on_null not in ("skip", "violation"):
            raise ValueError(f"on_null must be skip or violation, not {self.on_null}")

    @property
    def config_key(self) -> str:
        return f"{self.rule_id}_{self.table_name}_{self.column_name}"

    @property
    def sql(self) -> str:
        return self.predicate.replace("table_name", self.table_name).replace("column_name", name(self.column_name))

    def on(self, column_name: str, table_name: str = "") -> "Rule":
        return replace(self, column_name=column_name, table_name=table_name or self.table_name)

    def known(self, predicate: str) -> str:
        """SQL text of a boolean without nulls."""
        return f"coalesce({predicate}, {str(self.on_null == 'violation').lower()})"

    @property
    def violation_sql(self) -> str:
        return self.known(self.sql)

    def violation(self) -> Column:
        return F.expr(self.violation_sql)


@dataclass(frozen=True)
class SetRule:
    """A rule over several rows: ``violating`` returns the violating rows of a table."""

    rule_id: str
    violating: Callable[[DataFrame], DataFrame]
    column_name: str = ""
    severity: str = "Medium"
    description: str = ""


def _probe_row(df: DataFrame) -> DataFrame:
    """One made-up row with the columns of ``df``, as a literal that needs no job."""
    values = []
    for field in df.schema:
        sample = "''" if isinstance(field.dataType, T.StringType) else "NULL"
        if isinstance(field.dataType, T.NumericType):
            sample = "0"
        values.append(f"CAST({sample} AS {field.dataType.simpleString()})")
    names = ", ".join(name(c) for c in df.columns)
    return df.sparkSession.sql(f"SELECT * FROM VALUES ({', '.join(values)}) AS probe({names})")


def _analysis_error(probe: DataFrame, rule: Rule) -> str | None:
    """Unknown columns, syntax errors, results that are no boolean."""
    try:
        kind = probe.select(F.expr(rule.sql).alias("v")).schema["v"].dataType
        if isinstance(kind, (T.BooleanType, T.NullType)):
            # The form that will run: aggregates, windows and generators fail only here.
            _ = probe.agg(F.expr(f"count_if({rule.violation_sql})")).schema
    except AnalysisException as error:
        return error.getMessage().split("\n")[0]
    return None if isinstance(kind, (T.BooleanType, T.NullType)) else "rule did not return a boolean"


def _pattern_error(probe: DataFrame, rules: list[Rule]) -> str | None:
    """Patterns are only compiled when a value is matched, so match the made-up row."""
    try:
        probe.select(*[F.expr(r.sql).alias(f"v{i}") for i, r in enumerate(rules)]).collect()
    except PySparkException as error:
        # Other run-time errors depend on the data and say nothing about the rule.
        if (error.getCondition() or "").startswith("INVALID_PARAMETER_VALUE"):
            return error.getMessage().split("\n")[0]
    return None


def rule_errors(df: DataFrame, rules: list[Rule]) -> dict[int, str]:
    """Error text by position for rules that cannot run on ``df``; the table is not read.

    Each rule is analysed alone. Patterns are tried for all rules together, and one by one
    only if that fails.
    """
    if not rules:
        return {}
    probe = _probe_row(df)
    errors = {i: _analysis_error(probe, rule) for i, rule in enumerate(rules)}
    sound = [i for i, error in errors.items() if error is None]
    if sound and _pattern_error(probe, [rules[i] for i in sound]) is not None:
        errors.update({i: _pattern_error(probe, [rules[i]]) for i in sound})
    return {i: error for i, error in errors.items() if error is not None}


@dataclass(frozen=True)
class Counted:
    """How the violations of a rule are counted: SQL texts over the value of its aggregate."""

    aggregate: str
    may_fail: bool
    reasons: str = ""

    def violations(self, value: str) -> str:
        return f"{value}.violations" if self.may_fail else value

    def unless_failed(self, value: str, then: str) -> str:
        return f"IF({value}.failed = 0, {then}, NULL)" if self.may_fail else then

    def error(self, value: str) -> str:
        if not self.may_fail:
            return text(None)
        said = f"concat({text(self.reasons)}, ': cannot be computed for ', {value}.failed, ' rows')"
        return f"IF({value}.failed > 0, {said}, NULL)"


def counted(schema_only: DataFrame, rule: Rule) -> Counted:
    """Violations, and beside them the rows for which the rule cannot be computed, if there can be such."""
    form = tolerant(schema_only, rule.sql)
    violations = f"count_if({rule.known(form.value)})"
    if form.failed is None:
        return Counted(violations, False)
    return Counted(f"named_struct('violations', {violations}, 'failed', count_if({form.failed}))", True, form.reasons)


def _schema_only(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], df.schema)


def _result(rule, how: Counted = Counted("", False)):
    def fields(value: str) -> dict[str, str]:
        violations = how.violations(value)
        return {
            "rule_id": text(rule.rule_id),
            "column_name": text(rule.column_name),
            "severity": text(rule.severity),
            "description": text(rule.description),
            "total_records": how.unless_failed(value, "_total"),
            "violations": how.unless_failed(value, violations),
            "compliance_rate": how.unless_failed(value, percent(f"_total - {violations}", "_total", 100.0)),
            "error": how.error(value),
        }

    return fields


def _set_rule_counts(df: DataFrame, rule: SetRule) -> DataFrame:
    """One row: ``_total`` and ``violations``."""
    zero = F.lit(0).cast("bigint")
    parts = df.agg(F.count(F.lit(1)).alias("_total"), zero.alias("violations")).unionByName(
        rule.violating(df).agg(zero.alias("_total"), F.count(F.lit(1)).alias("violations"))
    )
    return parts.agg(F.sum("_total").alias("_total"), F.sum("violations").alias("violations"))


def run_rules(df: DataFrame, rules: list[Rule], set_rules: list[SetRule] = ()) -> DataFrame:
    """One result row per rule: totals, violations, compliance rate in percent, or an error.

    A rule that cannot be computed for some rows has their number as its error and no counts; the
    rows of the other rules come from the same scan and are as they would be without it.
    """
    errors = rule_errors(df, rules)
    schema_only = _schema_only(df)
    good = [(r, counted(schema_only, r)) for i, r in enumerate(rules) if i not in errors]
    frames = one_scan(df, [(how.aggregate, _result(r, how)) for r, how in good])
    frames += [rows_of(_set_rule_counts(df, rule), [_result(rule)("violations")]) for rule in set_rules]
    bad = [
        (rules[i].rule_id, rules[i].column_name, rules[i].severity, rules[i].description, None, None, None, text)
        for i, text in sorted(errors.items())
    ]
    if bad or not frames:
        frames.append(df.sparkSession.createDataFrame(bad, RESULT))
    return union_all(frames)


def run_rules_isolated(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """As ``run_rules``, but evaluated now, for rules that may fail in ways that have no ``try_`` form.

    If the shared scan fails all the same, the rules are split in half and tried again, so one failing
    rule costs a logarithmic number of extra scans. Only one row per rule is brought back.
    """
    if not rules:
        return df.sparkSession.createDataFrame([], RESULT)

    def attempt(part: list[Rule]) -> list[tuple]:
        try:
            return [tuple(r) for r in run_rules(df, part).collect()]
        except PySparkException as error:
            if len(part) == 1:
                r = part[0]
                text = str(error).split("\n")[0]
                return [(r.rule_id, r.column_name, r.severity, r.description, None, None, None, text)]
            log.warning("shared scan of %d rules failed, splitting", len(part))
            middle = len(part) // 2
            return attempt(part[:middle]) + attempt(part[middle:])

    return df.sparkSession.createDataFrame(attempt(rules), RESULT)


def failing_rules(rules: list[Rule]) -> Column:
    """Array of the ids of the rules that a row violates."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(r.violation(), F.lit(r.rule_id)) for r in rules]))


def sample_violations(df: DataFrame, rules: list[Rule], key: str, k: int = 5) -> DataFrame:
    """The first ``k`` violating rows of each rule by ``key``: ``(rule_id, column_name, position, key, value)``.

    One scan marks the rows; each partition keeps at most ``k`` rows per rule before the
    shuffle. Rows that a rule cannot be computed for count as unknown.
    """
    errors = rule_errors(df, rules)
    good = [r for i, r in enumerate(rules) if i not in errors]
    if not good:
        key_type = df.schema[key].dataType.simpleString()
        schema = f"key {key_type}, rule_id string, column_name string, value string, position int"
        return df.sparkSession.createDataFrame([], schema)
    schema_only = _schema_only(df)
    marks = ", ".join(
        f"IF({r.known(tolerant(schema_only, r.sql).value)}, named_struct('rule_id', {text(r.rule_id)}, 'column_name', {text(r.column_name)}, "
        f"'value', CAST({name(r.column_name) if r.column_name else 'NULL'} AS STRING)), NULL)"
        for r in good
    )
    long = df.selectExpr(f"{name(key)} AS key", f"inline(array_compact(array({marks})))")
    order = Window.partitionBy("rule_id", "column_name").orderBy("key")
    return long.withColumn("position", F.row_number().over(order)).where(F.col("position") <= k)


def assessment_run(
    df: DataFrame, rules: list[Rule], set_rules: list[SetRule] = (), column: str | None = None
) -> DataFrame:
    """Long ``(section, name, column_name, success, value, error)`` for a table or one column.

    A table gets its summary with correlations, a column its default checks; both get all
    their rules. Whatever looks at single rows shares a scan, as far as generated code allows;
    correlations, duplicates and set rules run beside it.
    """

    def fields(section: str, item: str, column_name: str | None, judged: bool, how: Counted = Counted("", False)):
        def row(value: str) -> dict[str, str]:
            found = how.unless_failed(value, how.violations(value))
            return {
                "section": text(section),
                "name": text(item),
                "column_name": text(column_name),
                "success": f"coalesce({found} = 0, false)" if judged else "CAST(NULL AS BOOLEAN)",
                "value": f"CAST({found} AS DOUBLE)",
                "error": how.error(value),
            }

        return row

    measures = [("count(1)", fields("basic_stats", "row_count", None, False))]
    frames = []
    if column is None:
        measures += [
            (f"count_if({name(c)} IS NULL)", fields("missing_values", "missing", c, False)) for c in df.columns
        ]
        related = [
            (pearson(a, b), fields("correlations", b, a, False)) for a, b in pairs(numeric_columns(df))
        ]
        frames += one_scan(df, related, PAIRS_PER_PASS)
        frames.append(
            rows_of(duplicate_count(df), [fields("basic_stats", "duplicates", None, False)("duplicate_records")])
        )
    else:
        rules = [r for r in rules if r.column_name == column]
        set_rules = [r for r in set_rules if r.column_name == column]
        measures += [
            (count_where(~check.passes(q(column))), fields("checks", check.name, column, True))
            for check in default_checks(df, column)
        ]
    errors = rule_errors(df, rules)
    schema_only = _schema_only(df)
    for i, r in enumerate(rules):
        if i not in errors:
            how = counted(schema_only, r)
            measures.append((how.aggregate, fields("rules", r.rule_id, r.column_name, True, how)))
    frames += one_scan(df, measures)
    for rule in set_rules:
        row = fields("rules", rule.rule_id, rule.column_name, True)
        frames.append(rows_of(_set_rule_counts(df, rule), [row("violations")]))
    if errors:
        bad = [("rules", rules[i].rule_id, rules[i].column_name, False, None, text) for i, text in errors.items()]
        frames.append(df.sparkSession.createDataFrame(bad, ASSESSMENT))
    return union_all(frames)
