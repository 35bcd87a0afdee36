"""Histories on disk: assessment results, metric history and alerts."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


RUN_KEY = "run_key"


def run_key(run_ts) -> str:
    """Name of a run in folders; runs of one time have one name."""
    return f"{run_ts:%Y%m%dT%H%M%S.%f}"


def publish(df: DataFrame, path: str, by: list[str]) -> None:
    """Put the partitions of ``df`` in place of those of equal keys ``by``; all others stay.

    New files are staged beside the table and moved in at the end, so a run that is repeated, or was
    killed and starts again, leaves its rows once. A partition that has no rows now is left as it was.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def save_results(results: DataFrame, path: str, run_ts, table_name: str, column_name: str | None = None) -> None:
    """Publish one assessment run with its metadata, partitioned by run date.

    A run is named by its time, table and column; saving it again replaces it.
    """
    stamped = (
        results.withColumn("run_ts", F.lit(run_ts).cast("timestamp_ntz"))
        .withColumn("run_table", F.lit(table_name))
        .withColumn("run_column", F.lit(column_name).cast("string"))
        .withColumn("run_date", F.to_date("run_ts"))
    )
    # Lengths keep names apart that hold the mark between them.
    names = ["" if x is None else f"{len(x)}.{x}" for x in (table_name, column_name)]
    publish(stamped.withColumn(RUN_KEY, F.lit("~".join([run_key(run_ts), *names]))), path, ["run_date", RUN_KEY])


def load_results(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all saved runs."""
    return spark.read.parquet(path).drop(RUN_KEY)


def load_latest_results(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest run; only its date partition is read."""
    runs = load_results(spark, path)
    newest_day = runs.agg(F.max("run_date"))
    same_day = runs.where(F.col("run_date") == newest_day.scalar())
    return same_day.where(F.col("run_ts") == same_day.agg(F.max("run_ts")).scalar())


def load_metrics_history(spark: SparkSession, path: str, metrics: list[str], keys: list[str] = ()) -> DataFrame:
    """Metric history from CSV: key columns, a parsed ``timestamp`` and the metrics as doubles."""
    schema = ", ".join(
        [*(f"`{k}` string" for k in keys), "`timestamp` string", *(f"`{m}` double" for m in metrics)]
    )
    history = spark.read.schema(schema).csv(path, header=True, enforceSchema=False)
    return history.withColumn("timestamp", F.col("timestamp").try_cast("timestamp_ntz"))


def publish_alerts(alerts: DataFrame, path: str, run_ts) -> None:
    """Put the alerts of a run in place of those of the same run, also if there are none now."""
    alerts.write.mode("overwrite").partitionBy("dataset").parquet(f"{path}/run={run_key(run_ts)}")


ALERTS = "dataset string, run_ts timestamp_ntz, anomalies bigint, messages array<string>"


def load_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Alerts of all published runs; none if no run had any."""
    return spark.read.schema(ALERTS).parquet(path)


def append_alerts(alerts: DataFrame, path: str) -> None:
    """Append alert rows, one folder per dataset."""
    alerts.write.mode("append").partitionBy("dataset").parquet(path)
