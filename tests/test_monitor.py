"""Monitoring, trends, improvement items, result files."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from assay.operators import improve as im
from assay.operators import monitor as mo
from assay.plans.lineage import fresh_dir
from assay.sources import results as rs
from tests.conftest import rows

HISTORY = "dataset string, run_ts timestamp_ntz, metric string, column_name string, value double"


def day(n):
    return datetime(2024, 1, n)


def history(spark, series):
    data = [(d, day(i + 1), m, None, float(x)) for (d, m), xs in series.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(data, HISTORY)


def test_metrics(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (3, None), (None, "b")], "n int, s string")
    got = {(r["metric"], r["column_name"]): r["value"] for r in mo.monitor_metrics(df, "d", day(1)).collect()}
    assert got["total_records", None] == 4
    assert got["duplicate_records", None] == 1
    assert got["missing_pct", "s"] == 0.25
    assert got["mean", "n"] == pytest.approx(5 / 3)
    assert ("mean", "s") not in got


def test_anomalies_need_two_earlier_runs_and_deviation(spark):
    got = rows(
        mo.metric_anomalies(
            history(
                spark,
                {
                    ("one", "total_records"): [10],
                    ("two", "total_records"): [10, 99],
                    ("three", "total_records"): [10, 12, 99],
                    ("flat", "total_records"): [10, 10, 99],
                    ("edge", "total_records"): [1, 3, 2, 4],
                    ("other", "mean"): [1, 2, 99],
                },
            )
        )
        .where("is_anomaly")
        .select("dataset", "run_ts")
    )
    assert got == [("three", day(3))]


def test_threshold_is_strict(spark):
    # Earlier runs 1, 3, 2: mean 2, deviation 1; 4 lies exactly two deviations away.
    h = history(spark, {("edge", "total_records"): [1, 3, 2, 4], ("over", "total_records"): [1, 3, 2, 4.01]})
    got = mo.metric_anomalies(h).where("is_anomaly")
    assert rows(got.select("dataset")) == [("over",)]


def test_report_and_alerts(spark):
    h = history(spark, {("d", "total_records"): [10, 12, 99], ("d", "duplicate_records"): [1, 2, 90], ("d", "mean"): [1, 2, 3]})
    report = mo.monitor_report(h)
    assert report.count() == h.count()
    alert = mo.monitor_alerts(h).first()
    assert (alert["dataset"], alert["run_ts"], alert["anomalies"]) == ("d", day(3), 2)
    assert alert["messages"][1] == "total_records shows unusual pattern (z-score: 62.23)"


def test_monitoring_runs_build_a_history(spark):
    folder = fresh_dir(spark, "monitor")
    reports = []
    for i, n in enumerate((10, 12, 90)):
        data = {"a": spark.range(n), "b": spark.range(5)}
        reports.append(mo.monitor_run(spark, data, f"{folder}/h", f"{folder}/a", day(i + 1)))
    found = rows(reports[2].where("is_anomaly").select("dataset", "metric"))
    assert found == [("a", "total_records")]
    alerts = spark.read.parquet(f"{folder}/a")
    assert rows(alerts.select("dataset", "anomalies")) == [("a", 1)]


def test_a_failing_dataset_is_skipped(spark):
    folder = fresh_dir(spark, "monitor")
    failing = spark.range(3).select(F.raise_error(F.lit("broken")).cast("int").alias("x"))
    report = mo.monitor_run(spark, {"bad": failing, "good": spark.range(3)}, f"{folder}/h", f"{folder}/a", day(1))
    assert {r["dataset"] for r in report.collect()} == {"good"}


def trends(spark, series):
    data = [("d", m, day(i + 1), x) for m, xs in series.items() for i, x in enumerate(xs)]
    frame = im.metric_trends(spark.createDataFrame(data, "dataset string, metric string, ts timestamp_ntz, value double").orderBy(F.rand(1)))
    return frame, {r["metric"]: r for r in frame.collect()}


def test_trends_and_problems(spark):
    frame, got = trends(
        spark,
        {
            "rising": [0.1, 0.2, 0.3],
            "accuracy": [0.9, 0.85, 0.8],
            "timeliness": [0.9, 0.7, 0.5],
            "completeness": [0.5, 0.5, 0.5],
            "edge": [0.9, 0.8, 0.7],
            "single": [0.4],
        },
    )
    assert got["rising"]["trend"] == "improving" and got["rising"]["slope"] == pytest.approx(0.1)
    assert got["timeliness"]["current_value"] == 0.5 and got["timeliness"]["historical_mean"] == pytest.approx(0.7)
    problems = im.problem_areas(frame)
    found = {r["metric"]: (r["severity"], r["trend"]) for r in problems.collect()}
    assert found["completeness"] == ("medium", "0.00% decline per period")
    assert found["timeliness"] == ("high", "20.00% decline per period")
    assert found["accuracy"] == ("medium", "5.00% decline per period")
    assert "rising" not in found
    causes = {r["metric"]: r["potential_causes"] for r in im.root_causes(problems).collect()}
    assert set(causes) == {"completeness", "accuracy", "timeliness"} and len(causes["accuracy"]) == 3
    actions = rows(im.recommendations(problems).where("metric = 'timeliness'").select("position", "priority", "action"))
    assert actions[0] == (0, "high", "Optimize data processing pipeline") and len(actions) == 3


def test_improvements(spark):
    events = spark.createDataFrame(
        [
            (1, day(1), 1, "add", "x", None, None),
            (2, day(2), 1, "update", None, "Completed", None),
            (3, day(3), 2, "add", None, "pending", "high"),
            (4, day(4), 9, "update", None, "completed", None),
            (5, day(5), 3, "add", "z", "COMPLETED", "high"),
            (6, day(6), 3, "update", None, "in progress", None),
            (7, day(7), 3, "update", None, "completed", None),
        ],
        "event_id long, ts timestamp_ntz, item_id long, action string, description string, status string, impact string",
    )
    items = im.improvements_current(events)
    assert rows(items) == [
        (1, day(1), "x", "Completed", "low"),
        (2, day(3), "", "pending", "high"),
        (3, day(5), "z", "completed", "high"),
    ]
    progress = dict(rows(im.improvement_progress(items)))
    assert progress == {"Overall Progress": pytest.approx(200 / 3), "Total Improvements": 3, "Completed": 2, "Pending": 1}
    assert rows(im.improvements_by(items, "impact")) == [("high", 2), ("low", 1)]
    assert dict(rows(im.improvement_progress(items.limit(0)))) == dict.fromkeys(progress, 0.0)


def test_latest_results(spark):
    path = fresh_dir(spark, "results")
    for hour, value in ((8, 1), (9, 2)):
        rs.save_results(spark.createDataFrame([(value,)], "v int"), path, datetime(2024, 1, 1, hour), "t", "c")
    got = rs.load_latest_results(spark, path).select("v", "run_table", "run_column", "run_date")
    assert rows(got) == [(2, "t", "c", date(2024, 1, 1))]


def test_metrics_history_file(spark):
    path = fresh_dir(spark, "csv")
    spark.createDataFrame([("timestamp,accuracy",), ("2024-01-02 03:04:05,0.5",), ("2024-01-03,0.6",), ("soon,",)], "value string").coalesce(1).write.text(path)
    got = rows(rs.load_metrics_history(spark, path, ["accuracy"]))
    assert got == [(None, None), (datetime(2024, 1, 2, 3, 4, 5), 0.5), (datetime(2024, 1, 3), 0.6)]


def test_a_run_that_is_repeated_is_published_once(spark, monkeypatch):
    """Repeats, and a failure between the metrics and the alerts, leave the rows of one run."""
    folder = fresh_dir(spark, "monitor")

    def run(i, n):
        data = {"a": spark.range(n), "b": spark.range(5)}
        return mo.monitor_run(spark, data, f"{folder}/h", f"{folder}/a", day(i))

    def kept():
        history = spark.read.parquet(f"{folder}/h").select("dataset", "run_ts", "metric", "column_name", "value")
        alerts = rs.load_alerts(spark, f"{folder}/a")
        return rows(history), rows(alerts)

    for i, n in enumerate((10, 12, 90, 10)):
        run(i + 1, n)
    once = kept()
    assert len(once[1]) == 1
    report = rows(run(3, 90))
    assert kept() == once
    publish = mo.publish_alerts
    monkeypatch.setattr(mo, "publish_alerts", lambda *_: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        run(3, 90)
    monkeypatch.setattr(mo, "publish_alerts", publish)
    assert rows(run(3, 90)) == report and kept() == once
    # The run is mended: its alerts go with what caused them.
    run(3, 13)
    assert kept()[1] == [] or all(r[1] != day(3) for r in kept()[1])
    assert len(kept()[0]) == len(once[0])


def test_the_report_of_a_run_equals_its_part_of_the_whole(spark):
    values = [("a", day(i), "total_records", None, float(x)) for i, x in enumerate((10, 12, 11, 90, 12), 1)]
    values += [("a", day(i), "mean", "x", float(i)) for i in range(1, 6)] + [("b", day(4), "total_records", None, 3.0)]
    history = spark.createDataFrame(values, "dataset string, run_ts timestamp_ntz, metric string, column_name string, value double")
    for i in range(1, 6):
        whole = mo.monitor_report(history).where(F.col("run_ts") == F.lit(day(i)).cast("timestamp_ntz"))
        own = mo.run_report(history, day(i))
        columns = ["dataset", "run_ts", "metric", "column_name", "value", F.round("z_score", 9), "is_anomaly"]
        assert rows(own.select(*columns)) == rows(whole.select(*columns))


def test_saved_results_replace_the_same_run_only(spark):
    path = fresh_dir(spark, "results")
    for value, hour, column in ((1, 1, "c"), (2, 1, "d"), (3, 2, "c"), (4, 2, None), (5, 1, "c")):
        rs.save_results(spark.createDataFrame([(value,)], "v int"), path, datetime(2024, 1, 1, hour), "t", column)
    assert rows(rs.load_results(spark, path).select("v")) == [(2,), (3,), (4,), (5,)]
    assert "run_key" not in rs.load_results(spark, path).columns
