"""Streaming jobs against the same computation on a table."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from assay.operators import monitor as mo
from assay.operators.rule_pack import PACK
from assay.operators.rules import Rule
from assay.plans.lineage import fresh_dir
from assay.streaming import metrics as sm
from assay.streaming import validation as sv
from tests.conftest import rows

SCHEMA = "id long, kind string, ts timestamp_ntz, x double"


def wide(df):
    return sm.windowed_metrics(df, "ts", F.col("kind"), "1 hour", "10 minutes", ["x"], ["x"], ["id"])


def feed(spark, folder, rows_):
    spark.createDataFrame(rows_, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_monitor_over_several_batches(spark):
    start = datetime(2024, 1, 1)
    data = [(i, "ab"[i % 2], start + timedelta(minutes=7 * i), None if i % 5 == 0 else float(i)) for i in range(60)]
    source, folder = fresh_dir(spark, "source"), fresh_dir(spark, "stream")
    for part in (data[:20], data[20:40], data[40:]):
        feed(spark, source, part)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        query = sm.start_stream_monitor(wide(stream), f"{folder}/h", f"{folder}/a", f"{folder}/state")
        query.awaitTermination()
    closed = max(r[2] for r in data) - timedelta(minutes=10)
    batch = sm.long_metrics(wide(spark.createDataFrame(data, SCHEMA)))
    expected = rows(
        batch.where(F.col("run_ts") + F.expr("INTERVAL 1 HOUR") <= F.lit(closed))
        .select("dataset", "run_ts", "metric", "column_name", F.round("value", 9))
    )
    got = rows(
        spark.read.schema(sm.HISTORY).parquet(f"{folder}/h").select("dataset", "run_ts", "metric", "column_name", F.round("value", 9))
    )
    assert got == expected and len(got) > 0


def test_monitor_alerts(spark):
    start = datetime(2024, 1, 1)
    data = []
    for hour, n in enumerate((5, 6, 5, 60, 5, 5)):
        data += [(1000 * hour + i, "a", start + timedelta(hours=hour, seconds=i), 1.0) for i in range(n)]
    source, folder = fresh_dir(spark, "source"), fresh_dir(spark, "stream")
    feed(spark, source, data)
    query = sm.start_stream_monitor(
        wide(spark.readStream.schema(SCHEMA).parquet(source)), f"{folder}/h", f"{folder}/a", f"{folder}/state"
    )
    query.awaitTermination()
    alerts = spark.read.parquet(f"{folder}/a")
    assert rows(alerts.select("dataset", "run_ts", "anomalies")) == [("a", start + timedelta(hours=3), 1)]


def test_rule_validation_splits_rows_and_repeats_safely(spark):
    source, folder = fresh_dir(spark, "source"), fresh_dir(spark, "split")
    feed(spark, source, [(1, "GB", None, 5.0), (2, "gb", None, 5.0), (3, "GB", None, None)])
    current = [PACK["addr_002"].on("kind")]

    def run(checkpoint):
        sv.start_rule_validation(
            spark.readStream.schema(SCHEMA).parquet(source),
            lambda: current,
            f"{folder}/ok",
            f"{folder}/bad",
            checkpoint,
        ).awaitTermination()

    def state():
        ok = rows(spark.read.parquet(f"{folder}/ok").select("id"))
        bad = rows(spark.read.parquet(f"{folder}/bad").select("id", F.array_join("failed_rules", ",")))
        return ok, bad

    run(f"{folder}/state")
    assert state() == ([(1,), (3,)], [(2, "addr_002")])
    # A lost checkpoint replays the batch under its number and overwrites its own folder.
    run(f"{folder}/state2")
    assert state() == ([(1,), (3,)], [(2, "addr_002")])
    # Rules are read again at every batch; one that cannot run lets no row pass.
    current += [PACK["dq1"].on("x"), Rule("bad", "nope", "x")]
    feed(spark, source, [(4, "gb", None, None)])
    run(f"{folder}/state")
    assert state()[1] == [(2, "addr_002"), (4, "addr_002,dq1,bad")]


def test_rules_that_fail_on_values_quarantine_the_batch(spark):
    source, folder = fresh_dir(spark, "source"), fresh_dir(spark, "failing")
    feed(spark, source, [(1, "12", None, 1.0), (2, "GB", None, 1.0)])
    sv.start_rule_validation(
        spark.readStream.schema(SCHEMA).parquet(source),
        lambda: [Rule("number", "CAST(column_name AS INT) > 20", "kind"), Rule("low", "x < 2", "x")],
        f"{folder}/ok",
        f"{folder}/bad",
        f"{folder}/state",
        errors_path=f"{folder}/errors",
    ).awaitTermination()
    bad = spark.read.parquet(f"{folder}/bad").select("id", F.array_join("failed_rules", ","))
    assert rows(bad) == [(1, "low,number"), (2, "low,number")]
    assert spark.read.parquet(f"{folder}/ok").isEmpty()
    errors = rows(spark.read.parquet(f"{folder}/errors").select("rule_id", "error"))
    assert [r[0] for r in errors] == ["number"] and "CAST_INVALID_INPUT" in errors[0][1]


def test_no_rules_let_everything_pass(spark):
    assert rows(sv.with_failing_rules(spark.range(1), [])) == [(0, [])]


def test_state_over_batches_judges_as_the_whole_history(spark):
    """Values far from zero, nulls, datasets that begin late or pause: as the windows over all runs."""
    rng = random.Random(2)
    start, values = datetime(2024, 1, 1), []
    for hour in range(40):
        for dataset, metric in (("a", "total_records"), ("a", "approx_duplicates"), ("b", "total_records"), ("c", "total_records")):
            if (dataset, hour % 7) not in (("b", 3), ("c", 1)) and (dataset != "c" or hour > 25):
                value = None if rng.random() < 0.1 else 1e9 + rng.choice([0, 1, 2, 30])
                values.append((dataset, start + timedelta(hours=hour), metric, None, value))
    history = spark.createDataFrame(values, sm.HISTORY).cache()
    state, found = spark.createDataFrame([], sm.STATE), []
    for low, high in ((0, 1), (1, 4), (4, 4), (4, 20), (20, 21), (21, 40)):
        arrived = history.where(
            (F.col("run_ts") >= F.lit(start + timedelta(hours=low)).cast("timestamp_ntz"))
            & (F.col("run_ts") < F.lit(start + timedelta(hours=high)).cast("timestamp_ntz"))
        )
        judged = sm.judged_by_state(state, arrived, 1.5)
        found += judged.select("dataset", "run_ts", "metric", F.round("z_score", 5), "is_anomaly").collect()
        state = spark.createDataFrame(sm.advanced_state(state, arrived).collect(), sm.STATE)
    whole = mo.metric_anomalies(history, 1.5, sm.WATCHED)
    expected = rows(whole.select("dataset", "run_ts", "metric", F.round("z_score", 5), "is_anomaly"))
    assert sorted((tuple(r) for r in found), key=str) == sorted(expected, key=str)
    assert sum(r.is_anomaly for r in found) > 3
    assert state.count() == 4


def test_alerts_over_many_batches_and_after_lost_state(spark):
    start, data = datetime(2024, 1, 1), []
    for hour, n in enumerate((5, 6, 5, 60, 5, 5, 6, 5, 70, 5, 5, 6)):
        data += [(1000 * hour + i, "ab"[i % 2], start + timedelta(hours=hour, seconds=i), 1.0) for i in range(n)]
    source, folder = fresh_dir(spark, "source"), fresh_dir(spark, "stream")
    states = [f"{folder}/s1", f"{folder}/s1", f"{folder}/s2", f"{folder}/s2"]
    for k, state in enumerate(states):
        feed(spark, source, [r for r in data if r[0] // 3000 == k])
        sm.start_stream_monitor(
            wide(spark.readStream.schema(SCHEMA).parquet(source)), f"{folder}/h", f"{folder}/a", f"{folder}/c",
            metrics=("total_records",), state_path=state,
        ).awaitTermination()
    history = spark.read.schema(sm.HISTORY).parquet(f"{folder}/h")
    expected = mo.monitor_alerts(history, metrics=("total_records",))
    got = spark.read.schema("dataset string, run_ts timestamp_ntz, anomalies bigint, messages array<string>").parquet(f"{folder}/a")
    names = ["dataset", "run_ts", "anomalies", "messages"]
    assert rows(got.select(*names)) == rows(expected.select(*names)) and got.count() >= 2
    # A row per dataset and metric, and the mark, in each of the two folders.
    kept = spark.read.parquet(f"{folder}/s2")
    assert kept.groupBy("slot").count().where("count <> 3").isEmpty()
