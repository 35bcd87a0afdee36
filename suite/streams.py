"""Structured Streaming jobs, run over all available data until they stop."""

from pyspark.sql import functions as F

from assay.operators.rule_pack import PACK
from assay.plans.lineage import fresh_dir
from assay.streaming import metrics as sm
from assay.streaming import validation as sv
from suite import case
from suite import views as v
from suite.rules import violates


def stream(spark, sf, name):
    """The parquet table as a file stream."""
    schema = v.table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def _wide(df):
    return sm.windowed_metrics(
        df,
        "ts",
        F.col("event_type"),
        interval="1 day",
        lateness="1 hour",
        numeric=["value"],
        checked=["user_id", "props"],
        identity=["event_id"],
    )


@case(
    "stream_monitor",
    """WITH closed AS (
  SELECT event_type AS dataset, date_trunc('day', ts) AS run_ts, user_id, props, value FROM events
  WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)),
wide AS (SELECT dataset, CAST(run_ts AS TIMESTAMP) AS run_ts, count(*) AS n, count(user_id) AS nu, count(props) AS np,
                avg(value) AS mean, stddev_samp(value) AS std, min(value) AS low, max(value) AS high FROM closed GROUP BY 1, 2)
SELECT dataset, run_ts, 'total_records' AS metric, CAST(NULL AS VARCHAR) AS column_name, CAST(n AS DOUBLE) AS value FROM wide
UNION ALL SELECT dataset, run_ts, 'missing_pct', 'user_id', (n - nu) / CAST(n AS DOUBLE) FROM wide
UNION ALL SELECT dataset, run_ts, 'missing_pct', 'props', (n - np) / CAST(n AS DOUBLE) FROM wide
UNION ALL SELECT dataset, run_ts, 'mean', 'value', round(mean, 6) FROM wide
UNION ALL SELECT dataset, run_ts, 'std', 'value', round(std, 6) FROM wide
UNION ALL SELECT dataset, run_ts, 'min', 'value', low FROM wide
UNION ALL SELECT dataset, run_ts, 'max', 'value', high FROM wide""",
)
def stream_monitor(spark, sf):
    """Closed windows only; the approximate duplicate count has no exact counterpart and is left out."""
    history, alerts = fresh_dir(spark, "stream-history"), fresh_dir(spark, "stream-alerts")
    sm.start_stream_monitor(
        _wide(stream(spark, sf, "events")), history, alerts, fresh_dir(spark, "stream-state")
    ).awaitTermination()
    return (
        spark.read.schema(sm.HISTORY)
        .parquet(history)
        .where("metric <> 'approx_duplicates'")
        .drop("batch_id")
        .withColumn("value", F.round("value", 6))
    )


@case(
    "stream_alerts",
    """WITH closed AS (
  SELECT event_type AS dataset, date_trunc('day', ts) AS run_ts, count(*) AS n, avg(value) AS mean FROM events
  WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2),
measured AS (SELECT dataset, run_ts, 'total_records' AS metric, CAST(n AS DOUBLE) AS value FROM closed
             UNION ALL SELECT dataset, run_ts, 'mean', mean FROM closed),
scored AS (SELECT *, abs(value - avg(value) OVER w) / nullif(stddev_samp(value) OVER w, 0) AS z FROM measured
           WINDOW w AS (PARTITION BY dataset, metric ORDER BY run_ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT dataset, CAST(run_ts AS TIMESTAMP) AS run_ts, count(*) AS anomalies FROM scored WHERE z > 1.5 GROUP BY 1, 2""",
)
def stream_alerts(spark, sf):
    """Alerts of the stream, judged by the state that is kept between batches."""
    alerts = fresh_dir(spark, "stream-alerts")
    sm.start_stream_monitor(
        _wide(stream(spark, sf, "events")),
        fresh_dir(spark, "stream-history"),
        alerts,
        fresh_dir(spark, "stream-state"),
        threshold=1.5,
        metrics=("total_records", "mean"),
    ).awaitTermination()
    found = spark.read.schema("dataset string, run_ts timestamp_ntz, anomalies bigint").parquet(alerts)
    return found.select("dataset", "run_ts", "anomalies")


RULES = [("ppl_001", "age"), ("dq1", "email"), ("asg_002", "project_code"), ("addr_002", "country"), ("dq2", "date_of_birth")]
FAILED = "concat_ws(',', " + ", ".join(f"CASE WHEN {violates(r, c)} THEN '{r}' END" for r, c in RULES) + ")"


@case(
    "stream_rule_validation",
    v.with_views(per=v.PER)
    + f"SELECT id, CASE WHEN {FAILED} = '' THEN 'valid' ELSE 'quarantine' END AS sink, {FAILED} AS failed_rules FROM per",
)
def stream_rule_validation(spark, sf):
    people = v.over(stream(spark, sf, "customer"), v.PER)
    valid, quarantine = fresh_dir(spark, "valid"), fresh_dir(spark, "quarantine")
    sv.start_rule_validation(
        people,
        lambda: [PACK[r].on(c, "per") for r, c in RULES],
        valid,
        quarantine,
        fresh_dir(spark, "validation-state"),
    ).awaitTermination()
    good = spark.read.parquet(valid).select("id", F.lit("valid").alias("sink"), F.lit("").alias("failed_rules"))
    bad = spark.read.parquet(quarantine).select(
        "id", F.lit("quarantine").alias("sink"), F.array_join("failed_rules", ",").alias("failed_rules")
    )
    return good.unionByName(bad)
