"""Monitoring: metric snapshots, anomalies against earlier runs, reports and alerts.

The history is a long table ``(dataset, run_ts, metric, column_name, value)`` with one row
per run and measure. It grows with the number of runs, not with the monitored tables, so
windows over the runs of one dataset stay small.
"""

import logging
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assay.operators.profile import duplicate_count, numeric_columns
from assay.plans.shape import name, one_scan, rows_of, text, union_all
from assay.sources.results import publish, publish_alerts, run_key

log = logging.getLogger(__name__)

WATCHED = ("total_records", "duplicate_records")


def monitor_metrics(df: DataFrame, dataset: str, run_ts: datetime) -> DataFrame:
    """Metrics of one dataset: records, duplicates, missing shares, mean/std/min/max."""

    def fields(metric: str, column: str | None):
        return lambda v: {"metric": text(metric), "column_name": text(column), "value": f"CAST({v} AS DOUBLE)"}

    measures = [("count(1)", fields("total_records", None))]
    for c in df.columns:
        share = f"try_divide(CAST(count_if({name(c)} IS NULL) AS DOUBLE), count(1))"
        measures.append((share, fields("missing_pct", c)))
    for c in numeric_columns(df):
        v = f"CAST({name(c)} AS DOUBLE)"
        for metric, value in (
            ("mean", f"avg({v})"),
            ("std", f"stddev_samp({v})"),
            ("min", f"min({v})"),
            ("max", f"max({v})"),
        ):
            measures.append((value, fields(metric, c)))
    frames = one_scan(df, measures)
    frames.append(rows_of(duplicate_count(df), [fields("duplicate_records", None)("duplicate_records")]))
    return union_all(frames).select(
        F.lit(dataset).alias("dataset"),
        F.lit(run_ts).cast("timestamp_ntz").alias("run_ts"),
        "metric",
        "column_name",
        "value",
    )


def metric_anomalies(history: DataFrame, threshold: float = 2.0, metrics: tuple[str, ...] = WATCHED) -> DataFrame:
    """Each watched value with mean, deviation and z-score of the *earlier* runs of its dataset.

    At least two earlier runs and a positive deviation are needed; an anomaly has a z-score
    strictly above the threshold.
    """
    earlier = (
        Window.partitionBy("dataset", "metric")
        .orderBy("run_ts")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    scored = history.where(F.col("metric").isin(*metrics)).withColumns(
        {
            "historical_mean": F.avg("value").over(earlier),
            "historical_std": F.stddev_samp("value").over(earlier),
        }
    )
    z = F.when(
        F.col("historical_std") > 0,
        F.abs(F.col("value") - F.col("historical_mean")) / F.col("historical_std"),
    )
    return scored.withColumn("z_score", z).withColumn(
        "is_anomaly", F.coalesce(F.col("z_score") > threshold, F.lit(False))
    )


def _messages(anomalies: DataFrame) -> DataFrame:
    text = F.format_string("%s shows unusual pattern (z-score: %.2f)", "metric", "z_score")
    return anomalies.where("is_anomaly").withColumn("message", text)


def monitor_report(history: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Every metric of every run with its anomaly verdict where there is one."""
    verdicts = metric_anomalies(history, threshold).select(
        "dataset", "run_ts", "metric", "z_score", "is_anomaly"
    )
    return history.join(verdicts, ["dataset", "run_ts", "metric"], "left").withColumn(
        "is_anomaly", F.coalesce("is_anomaly", F.lit(False))
    )


def monitor_alerts(
    history: DataFrame, threshold: float = 2.0, metrics: tuple[str, ...] = WATCHED
) -> DataFrame:
    """``(dataset, run_ts, anomalies, messages)`` for runs with anomalies.

    A run has at most one message per watched metric, so the list per run is bounded.
    """
    return alerts_of(metric_anomalies(history, threshold, metrics))


def alerts_of(judged: DataFrame) -> DataFrame:
    """``(dataset, run_ts, anomalies, messages)`` from rows with ``z_score`` and ``is_anomaly``."""
    return (
        _messages(judged)
        .groupBy("dataset", "run_ts")
        .agg(
            F.count(F.lit(1)).alias("anomalies"),
            F.array_sort(F.collect_list("message")).alias("messages"),
        )
    )


def run_report(
    history: DataFrame, run_ts: datetime, threshold: float = 2.0, metrics: tuple[str, ...] = WATCHED
) -> DataFrame:
    """The rows of one run of :func:`monitor_report`: judged by sums over its earlier runs, without a window."""
    now = F.lit(run_ts).cast("timestamp_ntz")
    earlier = (
        history.where((F.col("run_ts") < now) & F.col("metric").isin(*metrics))
        .groupBy("dataset", "metric")
        .agg(F.avg("value").alias("_mean"), F.stddev_samp("value").alias("_std"))
    )
    z = F.when(F.col("_std") > 0, F.abs(F.col("value") - F.col("_mean")) / F.col("_std"))
    return (
        history.where(F.col("run_ts") == now)
        .join(earlier, ["dataset", "metric"], "left")
        .withColumn("z_score", z)
        .withColumn("is_anomaly", F.coalesce(F.col("z_score") > threshold, F.lit(False)))
        .select(*history.columns, "z_score", "is_anomaly")
    )


def monitor_run(
    spark: SparkSession,
    data: dict[str, DataFrame],
    history_path: str,
    alerts_path: str,
    run_ts: datetime,
    threshold: float = 2.0,
) -> DataFrame:
    """One monitoring run over all datasets: publish metrics, judge them, publish alerts.

    A run is named by ``run_ts``: run again, after a failure at any point or without one, it leaves its
    metrics and alerts once. A dataset that fails is logged and skipped. Returns the report rows of
    this run.
    """
    for dataset, df in data.items():
        try:
            measured = monitor_metrics(df, dataset, run_ts).withColumn("run", F.lit(run_key(run_ts)))
            publish(measured, history_path, ["run", "dataset"])
        except PySparkException:
            log.exception("monitoring of %s failed", dataset)
    history = spark.read.parquet(history_path).withColumn("dataset", F.col("dataset").cast("string")).drop("run")
    report = run_report(history, run_ts, threshold)
    publish_alerts(alerts_of(report), alerts_path, run_ts)
    return report
