"""Monitoring, anomalies, alerts, trends and improvement tracking."""

from datetime import datetime

from pyspark.sql import functions as F

from assay.operators import improve as im
from assay.operators import monitor as mo
from assay.plans.lineage import fresh_dir
from assay.sources.results import append_alerts
from suite import case
from suite import views as v

HISTORY = v.with_views(run_history=v.RUN_HISTORY)
# The run history in the long form that the operators use.
LONG = (
    HISTORY[:-1]
    + """,
history AS (SELECT dataset, CAST(run_date AS TIMESTAMP) AS run_ts, 'total_records' AS metric, CAST(NULL AS VARCHAR) AS column_name,
                   CAST(total_records AS DOUBLE) AS value FROM run_history
            UNION ALL SELECT dataset, run_date, 'duplicate_records', NULL, duplicate_records FROM run_history),
scored AS (SELECT *, avg(value) OVER w AS historical_mean, stddev_samp(value) OVER w AS historical_std, count(*) OVER w AS earlier
           FROM history WINDOW w AS (PARTITION BY dataset, metric ORDER BY run_ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
judged AS (SELECT dataset, run_ts, metric, column_name, value, historical_mean, CASE WHEN earlier >= 2 THEN historical_std END AS historical_std,
                  CASE WHEN earlier >= 2 AND historical_std > 0 THEN abs(value - historical_mean) / historical_std END AS z_score
           FROM scored)
"""
)


def history(spark, sf):
    runs = v.view(spark, sf, v.RUN_HISTORY)
    return runs.select(
        "dataset",
        F.col("run_date").cast("timestamp_ntz").alias("run_ts"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(m).alias("metric"),
                        F.lit(None).cast("string").alias("column_name"),
                        F.col(m).cast("double").alias("value"),
                    )
                    for m in mo.WATCHED
                ]
            )
        ),
    )


def rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


SNAPSHOT = {
    "customer": (["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], ["c_custkey", "c_nationkey", "c_acctbal"]),
    "orders": (
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
        ["o_orderkey", "o_custkey", "o_totalprice"],
    ),
    "events": (["event_id", "ts", "user_id", "event_type", "value", "props"], ["event_id", "user_id", "value"]),
}
RUN_TS = datetime(2024, 3, 1, 8)


def snapshot_sql(tables):
    branches = []
    for t in tables:
        columns, numeric = SNAPSHOT[t]
        head = f"SELECT '{t}' AS dataset, TIMESTAMP '2024-03-01 08:00:00' AS run_ts"
        branches.append(f"{head}, 'total_records' AS metric, CAST(NULL AS VARCHAR) AS column_name, CAST(count(*) AS DOUBLE) AS value FROM {t}")
        branches.append(
            f"{head}, 'duplicate_records', NULL, CAST(coalesce(sum(n - 1), 0) AS DOUBLE) FROM (SELECT count(*) AS n FROM {t} GROUP BY {', '.join(columns)}) g"
        )
        branches += [
            f"{head}, 'missing_pct', '{c}', (count(*) - count({c})) / CAST(count(*) AS DOUBLE) FROM {t}" for c in columns
        ]
        for c in numeric:
            branches += [
                f"{head}, '{m}', '{c}', round(CAST({f}({c}) AS DOUBLE), 4) FROM {t}"
                for m, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
            ]
    return "\nUNION ALL ".join(branches)


@case("monitor_metrics", snapshot_sql(SNAPSHOT))
def monitor_metrics(spark, sf):
    first, *rest = [mo.monitor_metrics(v.table(spark, sf, t), t, RUN_TS) for t in SNAPSHOT]
    for frame in rest:
        first = first.unionByName(frame)
    return rounded(first, ["value"], 4)


@case(
    "metric_anomalies",
    LONG
    + """SELECT dataset, run_ts, metric, column_name, value, round(historical_mean, 6) AS historical_mean,
       round(historical_std, 6) AS historical_std, round(z_score, 6) AS z_score, coalesce(z_score > 2, false) AS is_anomaly
FROM judged""",
)
def metric_anomalies(spark, sf):
    return rounded(mo.metric_anomalies(history(spark, sf)), ["historical_mean", "historical_std", "z_score"])


@case(
    "monitor_report",
    LONG
    + """SELECT dataset, run_ts, metric, column_name, value, round(z_score, 6) AS z_score,
       coalesce(z_score > 2, false) AS is_anomaly FROM judged""",
)
def monitor_report(spark, sf):
    return rounded(mo.monitor_report(history(spark, sf)), ["z_score"])


ALERTS = """SELECT dataset, run_ts, count(*) AS anomalies,
       string_agg(metric || ' shows unusual pattern (z-score: ' || printf('%.2f', z_score) || ')', '; ' ORDER BY metric) AS messages
FROM judged WHERE z_score > 2 GROUP BY dataset, run_ts"""


@case("monitor_alerts", LONG + ALERTS)
def monitor_alerts(spark, sf):
    return mo.monitor_alerts(history(spark, sf)).withColumn("messages", F.array_join("messages", "; "))


@case("alert_sink", LONG + ALERTS)
def alert_sink(spark, sf):
    folder = fresh_dir(spark, "alerts")
    append_alerts(mo.monitor_alerts(history(spark, sf)), folder)
    return spark.read.parquet(folder).withColumn("messages", F.array_join("messages", "; "))


@case(
    "monitor_run",
    "SELECT *, CAST(NULL AS DOUBLE) AS z_score, false AS is_anomaly FROM (" + snapshot_sql(["customer", "events"]) + ") t",
)
def monitor_run(spark, sf):
    data = {t: v.table(spark, sf, t) for t in ("customer", "events")}
    report = mo.monitor_run(spark, data, fresh_dir(spark, "history"), fresh_dir(spark, "alerts"), RUN_TS)
    return rounded(report, ["value"], 4)


# --- trends -------------------------------------------------------------------------------------

TRENDS = (
    HISTORY[:-1]
    + """,
measured AS (SELECT dataset, 'accuracy' AS metric, run_date, accuracy AS value FROM run_history
             UNION ALL SELECT dataset, 'completeness', run_date, completeness FROM run_history),
numbered AS (SELECT *, row_number() OVER (PARTITION BY dataset, metric ORDER BY run_date) - 1 AS n FROM measured),
trends AS (SELECT dataset, metric, regr_slope(value, n) AS slope, arg_max(value, run_date) AS current_value, avg(value) AS historical_mean
           FROM numbered GROUP BY dataset, metric),
problems AS (SELECT dataset, metric, CASE WHEN slope < -0.1 THEN 'high' ELSE 'medium' END AS severity, slope FROM trends WHERE NOT slope > 0)
"""
)


def trends(spark, sf):
    measured = v.view(spark, sf, v.RUN_HISTORY).select(
        "dataset",
        F.col("run_date").alias("ts"),
        F.inline(
            F.array(
                *[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("accuracy", "completeness")]
            )
        ),
    )
    return im.metric_trends(measured)


@case(
    "metric_trends",
    TRENDS
    + """SELECT dataset, metric, round(slope, 9) AS slope, round(current_value, 9) AS current_value,
       round(historical_mean, 9) AS historical_mean, CASE WHEN slope > 0 THEN 'improving' ELSE 'declining' END AS trend FROM trends""",
)
def metric_trends(spark, sf):
    return rounded(trends(spark, sf), ["slope", "current_value", "historical_mean"], 9)


@case(
    "problem_areas",
    TRENDS
    + """SELECT dataset, metric, round(slope, 9) AS slope, severity,
       printf('%.2f', abs(slope * 100)) || '% decline per period' AS trend FROM problems""",
)
def problem_areas(spark, sf):
    return rounded(im.problem_areas(trends(spark, sf)), ["slope"], 9)


def lookup(table):
    return ", ".join(
        f"('{m}', {i}, '{text}')" for m, texts in table.items() for i, text in enumerate(texts)
    )


@case(
    "root_causes",
    TRENDS[:-1]
    + f""",
causes(metric, position, cause) AS (VALUES {lookup(im.CAUSES)})
SELECT dataset, metric, severity, string_agg(cause, '; ' ORDER BY position) AS potential_causes
FROM problems JOIN causes USING (metric) GROUP BY dataset, metric, severity""",
)
def root_causes(spark, sf):
    causes = im.root_causes(im.problem_areas(trends(spark, sf)))
    return causes.withColumn("potential_causes", F.array_join("potential_causes", "; "))


@case(
    "recommendations",
    TRENDS[:-1]
    + f""",
actions(metric, position, action) AS (VALUES {lookup(im.ACTIONS)})
SELECT dataset, metric, CASE severity WHEN 'high' THEN 'high' ELSE 'medium' END AS priority, position, action
FROM problems JOIN actions USING (metric)""",
)
def recommendations(spark, sf):
    return im.recommendations(im.problem_areas(trends(spark, sf)))


# --- improvement items ------------------------------------------------------------------------------

ITEMS = v.with_views(item_log=v.ITEM_LOG)[:-1] + """,
adds AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY ts, event_id) AS rn FROM item_log WHERE action = 'add'),
updates AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY ts DESC, event_id DESC) AS rn FROM item_log WHERE action = 'update'),
items AS (SELECT a.item_id, a.ts AS date, coalesce(a.description, '') AS description,
                 CASE WHEN u.ts > a.ts OR u.ts = a.ts AND u.event_id > a.event_id THEN u.status ELSE coalesce(a.status, 'pending') END AS status,
                 coalesce(a.impact, 'low') AS impact
          FROM adds a LEFT JOIN updates u ON a.item_id = u.item_id AND u.rn = 1 WHERE a.rn = 1)
"""


def items(spark, sf):
    return im.improvements_current(v.view(spark, sf, v.ITEM_LOG))


@case("improvement_current", ITEMS + "SELECT * FROM items")
def improvement_current(spark, sf):
    return items(spark, sf)


@case(
    "improvement_progress",
    ITEMS
    + """SELECT 'Overall Progress' AS metric, round(count(*) FILTER (lower(status) = 'completed') * 100.0e0 / count(*), 6) AS value FROM items
UNION ALL SELECT 'Total Improvements', CAST(count(*) AS DOUBLE) FROM items
UNION ALL SELECT 'Completed', CAST(count(*) FILTER (lower(status) = 'completed') AS DOUBLE) FROM items
UNION ALL SELECT 'Pending', CAST(count(*) FILTER (lower(status) = 'pending') AS DOUBLE) FROM items""",
)
def improvement_progress(spark, sf):
    return rounded(im.improvement_progress(items(spark, sf)), ["value"])


@case("improvement_impact", ITEMS + "SELECT impact, count(*) AS items FROM items GROUP BY impact")
def improvement_impact(spark, sf):
    return im.improvements_by(items(spark, sf), "impact")


@case("improvement_by_status", ITEMS + "SELECT status, count(*) AS items FROM items GROUP BY status")
def improvement_by_status(spark, sf):
    return im.improvements_by(items(spark, sf), "status")
