"""Rule registry as an append-only event log, and statistics on the rules.

Event rows: ``event_id, ts, action, config_key, rule_id, table_name, column_name, severity,
category`` with action ``save``, ``deactivate`` or ``deactivate_all`` (no key). Nothing is
ever updated in place, so writers only append and every state can be rebuilt.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.plans.shape import count_where, rows_of


def instantiate_rules(
    templates: DataFrame,
    targets: list[tuple[str, str]],
    category: str | None = None,
    severity: str | None = None,
) -> DataFrame:
    """Configurations for chosen templates on chosen ``(table, column)`` targets.

    The target list comes from table schemas, so it is a small literal: each template row is
    exploded over it without a join.
    """
    chosen = templates
    if category is not None:
        chosen = chosen.where(F.col("category") == category)
    if severity is not None:
        chosen = chosen.where(F.col("severity") == severity)
    pairs = F.array(
        *[F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("column_name")) for t, c in targets]
    )

    def placed(code: str) -> Column:
        with_table = F.replace(F.col(code), F.lit("table_name"), F.col("table_name"))
        return F.replace(with_table, F.lit("column_name"), F.col("column_name"))

    return chosen.select("*", F.inline(pairs)).select(
        F.concat_ws("_", "id", "table_name", "column_name").alias("config_key"),
        F.col("id").alias("rule_id"),
        "table_name",
        "column_name",
        "description",
        placed("validation_code").alias("python_code"),
        placed("validation_code_sql").alias("sql_code"),
        "severity",
        "category",
    )


def current_rules(events: DataFrame, attributes: list[str]) -> DataFrame:
    """State of every rule that was ever saved.

    The last save gives the attributes and ``activated_at`` = ``last_updated``. A rule is
    inactive if a deactivation of it, or of all rules, came later; ``deactivated_at`` is the
    latest one. Deactivating an unknown key changes nothing. Aggregates only, no sort.
    """
    when = F.struct("ts", "event_id")
    saved = F.col("action") == "save"
    state = (
        events.where("config_key IS NOT NULL")
        .groupBy("config_key")
        .agg(
            F.max_by(F.when(saved, F.struct(*attributes)), F.when(saved, when)).alias("rule"),
            F.max(F.when(saved, when)).alias("saved"),
            F.max(F.when(F.col("action") == "deactivate", when)).alias("stopped"),
        )
        .where("saved IS NOT NULL")
    )
    all_stopped = events.where("action = 'deactivate_all'").agg(F.max(when)).scalar()
    stopped = F.greatest("stopped", all_stopped)
    return (
        state.withColumn("stopped", stopped)
        .withColumn("stopped", F.when(F.col("stopped") > F.col("saved"), F.col("stopped")))
        .select(
            "config_key",
            "rule.*",
            F.col("stopped").isNull().alias("is_active"),
            F.col("saved.ts").alias("last_updated"),
            F.col("saved.ts").alias("activated_at"),
            F.col("stopped.ts").alias("deactivated_at"),
        )
    )


def append_event(events: DataFrame, path: str) -> None:
    """Add change events to the log."""
    events.write.mode("append").parquet(path)


def active_rules(
    rules: DataFrame,
    table_name: str | None = None,
    column_name: str | None = None,
    category: str | None = None,
    severity: str | None = None,
) -> DataFrame:
    """Active rules with optional filters; a missing ``is_active`` counts as active."""
    wanted = {"table_name": table_name, "column_name": column_name, "category": category, "severity": severity}
    active = rules.where(F.coalesce("is_active", F.lit(True)))
    for name, value in wanted.items():
        if value is not None:
            active = active.where(F.col(name) == value)
    return active


# --- statistics ---------------------------------------------------------------------------


def rule_counts(rules: DataFrame) -> DataFrame:
    """One row: total, critical, tables covered, active."""
    return rules.agg(
        F.count(F.lit(1)).alias("total_rules"),
        count_where(F.col("severity") == "Critical").alias("critical_rules"),
        F.count_distinct("table_name").alias("tables_covered"),
        count_where(F.col("is_active")).alias("active_rules"),
    )


def rule_adoption(templates: DataFrame, rules: DataFrame) -> DataFrame:
    """One row: available, configured, active, and active / available in percent (0 if none)."""
    counted = templates.agg(
        F.count(F.lit(1)).alias("available"),
        F.lit(0).cast("bigint").alias("configured"),
        F.lit(0).cast("bigint").alias("active"),
    ).unionByName(
        rules.agg(
            F.lit(0).cast("bigint").alias("available"),
            F.count(F.lit(1)).alias("configured"),
            count_where(F.col("is_active")).alias("active"),
        )
    )
    totals = counted.agg(*[F.sum(c).alias(c) for c in ("available", "configured", "active")])
    rate = F.try_divide(F.col("active") * 100.0, F.col("available"))
    return totals.withColumn("adoption_rate", F.coalesce(rate, F.lit(0.0)))


def rules_by(rules: DataFrame, attribute: str) -> DataFrame:
    """Rules per value of severity, category or table, most frequent first."""
    return rules.groupBy(attribute).agg(F.count(F.lit(1)).alias("rules")).orderBy(F.desc("rules"), attribute)


def rule_activity_timeline(rules: DataFrame) -> DataFrame:
    """``(activity_date, activity, changes)`` for activations and deactivations."""
    long = rows_of(
        rules,
        [
            {"ts": "activated_at", "activity": "'activated'"},
            {"ts": "deactivated_at", "activity": "'deactivated'"},
        ],
    )
    return (
        long.where("ts IS NOT NULL")
        .groupBy(F.to_date("ts").alias("activity_date"), "activity")
        .agg(F.count(F.lit(1)).alias("changes"))
    )


def recent_rule_updates(rules: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` latest changes, ties by key."""
    return rules.orderBy(F.desc("last_updated"), "config_key").limit(k)


def rule_execution_history(results: DataFrame) -> DataFrame:
    """Adds the previous compliance rate, its change and the last validation per rule.

    The window holds the runs of one rule, one row each; it does not grow with the tables
    that were validated.
    """
    runs = Window.partitionBy("rule_id").orderBy("run_ts")
    return results.withColumns(
        {
            "previous_rate": F.lag("compliance_rate").over(runs),
            "last_validated": F.max("run_ts").over(Window.partitionBy("rule_id")),
        }
    ).withColumn("change", F.col("compliance_rate") - F.col("previous_rate"))
