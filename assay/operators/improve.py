"""Trends of quality metrics, problem areas, causes, recommendations and improvement items."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.plans.shape import count_where, rows_of, text

# Texts per metric.
CAUSES = {
    "completeness": [
        "Missing data validation at entry point",
        "Incomplete data migration",
        "System integration issues",
    ],
    "accuracy": [
        "Insufficient data validation rules",
        "Manual data entry errors",
        "Outdated data transformation logic",
    ],
    "timeliness": ["Processing delays", "Resource constraints", "Inefficient data pipeline"],
}
ACTIONS = {
    "completeness": [
        "Implement mandatory field validation",
        "Review data migration processes",
        "Enhance system integration monitoring",
    ],
    "accuracy": [
        "Enhance validation rules",
        "Implement automated data quality checks",
        "Review and update transformation logic",
    ],
    "timeliness": [
        "Optimize data processing pipeline",
        "Implement performance monitoring",
        "Review resource allocation",
    ],
}


def metric_trends(history: DataFrame) -> DataFrame:
    """Least-squares slope over run number 0..n-1 per ``(dataset, metric)``.

    Input ``(dataset, metric, ts, value)``, one row per run. Improving iff the slope is above
    zero. Null values keep their run number but do not count.
    """
    runs = Window.partitionBy("dataset", "metric").orderBy("ts")
    return (
        history.withColumn("n", (F.row_number().over(runs) - 1).cast("double"))
        .groupBy("dataset", "metric")
        .agg(
            F.regr_slope("value", "n").alias("slope"),
            F.max_by("value", "ts").alias("current_value"),
            F.avg("value").alias("historical_mean"),
        )
        .withColumn("trend", F.when(F.col("slope") > 0, "improving").otherwise("declining"))
    )


def problem_areas(trends: DataFrame) -> DataFrame:
    """Declining metrics: high severity below a slope of -0.1, otherwise medium."""
    return trends.where("trend = 'declining'").select(
        "dataset",
        "metric",
        "slope",
        F.when(F.col("slope") < -0.1, "high").otherwise("medium").alias("severity"),
        F.format_string("%.2f%% decline per period", F.abs(F.col("slope") * 100)).alias("trend"),
    )


def _looked_up(table: dict[str, list[str]]) -> Column:
    """The texts of a metric, from a literal of three entries."""
    entries = []
    for metric, texts in table.items():
        entries += [F.lit(metric), F.array(*[F.lit(t) for t in texts])]
    return F.create_map(*entries)[F.col("metric")]


def root_causes(problems: DataFrame) -> DataFrame:
    """``(dataset, metric, severity, potential_causes)`` for metrics with known causes."""
    return problems.select("dataset", "metric", "severity", _looked_up(CAUSES).alias("potential_causes")).where(
        "potential_causes IS NOT NULL"
    )


def recommendations(problems: DataFrame) -> DataFrame:
    """One row per action: ``(dataset, metric, priority, position, action)``."""
    return problems.select(
        "dataset",
        "metric",
        F.when(F.col("severity") == "high", "high").otherwise("medium").alias("priority"),
        F.posexplode(_looked_up(ACTIONS)).alias("position", "action"),
    )


# --- improvement items ------------------------------------------------------------------------


def improvements_current(events: DataFrame) -> DataFrame:
    """State of every item from its events ``(event_id, ts, item_id, action, description, status, impact)``.

    The first ``add`` creates the item, with defaults for what it leaves out; the latest later
    ``update`` sets the status. Updates of unknown items are ignored.
    """
    when = F.struct("ts", "event_id")
    added, updated = F.col("action") == "add", F.col("action") == "update"
    return (
        events.groupBy("item_id")
        .agg(
            F.min_by(F.when(added, F.struct("ts", "description", "status", "impact")), F.when(added, when)).alias("item"),
            F.min(F.when(added, when)).alias("added"),
            F.max(F.when(updated, when)).alias("updated"),
            F.max_by(F.when(updated, F.col("status")), F.when(updated, when)).alias("new_status"),
        )
        .where("added IS NOT NULL")
        .select(
            "item_id",
            F.col("item.ts").alias("date"),
            F.coalesce("item.description", F.lit("")).alias("description"),
            F.when(F.col("updated") > F.col("added"), F.col("new_status"))
            .otherwise(F.coalesce("item.status", F.lit("pending")))
            .alias("status"),
            F.coalesce("item.impact", F.lit("low")).alias("impact"),
        )
    )


def improvement_progress(items: DataFrame) -> DataFrame:
    """``(metric, value)``: overall progress in percent, total, completed and pending items."""
    counts = items.agg(
        F.count(F.lit(1)).alias("total"),
        count_where(F.lower("status") == "completed").alias("completed"),
        count_where(F.lower("status") == "pending").alias("pending"),
    )
    values = {
        "Overall Progress": "coalesce(try_divide(completed * 100D, total), 0D)",
        "Total Improvements": "CAST(total AS DOUBLE)",
        "Completed": "CAST(completed AS DOUBLE)",
        "Pending": "CAST(pending AS DOUBLE)",
    }
    return rows_of(counts, [{"metric": text(metric), "value": value} for metric, value in values.items()])


def improvements_by(items: DataFrame, attribute: str) -> DataFrame:
    """Items per impact or status."""
    return items.where(F.col(attribute).isNotNull()).groupBy(attribute).agg(F.count(F.lit(1)).alias("items"))
