"""Metrics of an arriving stream per interval, and the monitoring job on top of them."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assay.operators.monitor import alerts_of
from assay.operators.profile import q
from assay.plans.shape import count_where, name, rows_of, text

WATCHED = ("total_records", "approx_duplicates")
HISTORY = "dataset string, run_ts timestamp_ntz, metric string, column_name string, value double"


def windowed_metrics(
    stream: DataFrame,
    ts: str,
    dataset: Column,
    interval: str,
    lateness: str,
    numeric: list[str],
    checked: list[str],
    identity: list[str] | None = None,
) -> DataFrame:
    """Wide metrics per ``(window, dataset)``; works on a stream and on a plain table alike.

    The state is one row of running aggregates per window and dataset, whatever arrives; the
    watermark drops it ``lateness`` after the window has ended. A stream allows no exact
    distinct count, so duplicates are ``records - approx_count_distinct(hash)`` and marked
    approximate by name.
    """
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp"))
    if stream.isStreaming:
        timed = timed.withWatermark("_ts", lateness)
    rows = F.count(F.lit(1))
    distinct = F.approx_count_distinct(F.xxhash64(*[q(c) for c in identity or stream.columns]))
    aggs = [rows.alias("total_records"), F.greatest(F.lit(0), rows - distinct).alias("approx_duplicates")]
    for c in checked:
        aggs.append((count_where(q(c).isNull()).cast("double") / rows).alias(f"missing_pct__{c}"))
    for c in numeric:
        v = q(c).cast("double")
        aggs += [
            F.avg(v).alias(f"mean__{c}"),
            F.stddev_samp(v).alias(f"std__{c}"),
            F.min(v).alias(f"min__{c}"),
            F.max(v).alias(f"max__{c}"),
        ]
    return (
        timed.groupBy(F.window("_ts", interval).alias("w"), dataset.alias("dataset"))
        .agg(*aggs)
        .withColumn("run_ts", F.col("w.start").cast("timestamp_ntz"))
        .drop("w")
    )


def long_metrics(wide: DataFrame) -> DataFrame:
    """``(dataset, run_ts, metric, column_name, value)`` from the wide form."""
    cells = []
    for measure in wide.columns:
        if measure not in ("dataset", "run_ts"):
            metric, _, column = measure.partition("__")
            value = f"CAST({name(measure)} AS DOUBLE)"
            cells.append({"metric": text(metric), "column_name": text(column or None), "value": value})
    return rows_of(wide, cells, keep=["dataset", "run_ts"])


STATE = "dataset string, metric string, n bigint, mean double, m2 double"


def _sums(values: DataFrame) -> DataFrame:
    """Count, mean and sum of squared deviations per dataset and metric; null values count for nothing."""
    return values.groupBy("dataset", "metric").agg(
        F.count("value").alias("n"),
        F.coalesce(F.avg("value"), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop("value") * F.count("value"), F.lit(0.0)).alias("m2"),
    )


def _merged(n: Column, mean: Column, m2: Column, n2: Column, mean2: Column, m22: Column) -> dict[str, Column]:
    """Count, mean and sum of squared deviations of two parts together."""
    both = n + n2
    share = F.coalesce(F.try_divide(n2, both), F.lit(0.0))
    return {
        "n": both,
        "mean": mean + (mean2 - mean) * share,
        "m2": m2 + m22 + (mean2 - mean) * (mean2 - mean) * n * share,
    }


def _or_none(side: str) -> tuple[Column, Column, Column]:
    return (
        F.coalesce(F.col(f"{side}.n"), F.lit(0)),
        F.coalesce(F.col(f"{side}.mean"), F.lit(0.0)),
        F.coalesce(F.col(f"{side}.m2"), F.lit(0.0)),
    )


def advanced_state(state: DataFrame, arrived: DataFrame) -> DataFrame:
    """The state after the values that arrived: one row per dataset and metric, however long the history is."""
    joined = state.alias("s").join(_sums(arrived).alias("a"), ["dataset", "metric"], "full")
    parts = _merged(*_or_none("s"), *_or_none("a"))
    return joined.select("dataset", "metric", *[value.alias(name) for name, value in parts.items()])


def judged_by_state(state: DataFrame, arrived: DataFrame, threshold: float) -> DataFrame:
    """``arrived`` with ``z_score`` and ``is_anomaly`` against all that came before each value.

    What came before is the state and the earlier rows of ``arrived``; the window holds the closed
    intervals of one batch.
    """
    earlier = Window.partitionBy("dataset", "metric").orderBy("run_ts").rowsBetween(Window.unboundedPreceding, -1)
    own = arrived.select(
        "*",
        F.struct(
            F.count("value").over(earlier).alias("n"),
            F.avg("value").over(earlier).alias("mean"),
            (F.var_pop("value").over(earlier) * F.count("value").over(earlier)).alias("m2"),
        ).alias("a"),
    )
    both = own.join(state.alias("s"), ["dataset", "metric"], "left")
    before = _merged(*_or_none("s"), *_or_none("a"))
    std = F.when(before["n"] > 1, F.sqrt(before["m2"] / (before["n"] - 1)))
    z = F.when(std > 0, F.abs(F.col("value") - before["mean"]) / std)
    return both.select(*[F.col(c) for c in arrived.columns], z.alias("z_score")).withColumn(
        "is_anomaly", F.coalesce(F.col("z_score") > threshold, F.lit(False))
    )


def start_stream_monitor(
    wide: DataFrame,
    history_path: str,
    alerts_path: str,
    checkpoint: str,
    threshold: float = 2.0,
    trigger: dict | None = None,
    metrics: tuple[str, ...] = WATCHED,
    state_path: str | None = None,
) -> StreamingQuery:
    """Append closed windows to the history and alerts for those that stand out.

    Each micro-batch owns one folder per table and overwrites it, so a batch that is run
    again after a failure leaves the same rows. What earlier batches held is kept as one row per
    dataset and metric: a batch reads the state that the one before it left in one of two folders and
    writes its own into the other, so neither its cost nor its files grow with the history. Only if that state is
    missing, as after an update, is it made anew from the history. ``trigger`` is the cadence, for example
    ``{"processingTime": "5 minutes"}``; the default takes what is there and stops.
    """
    states = state_path or f"{checkpoint.rstrip('/')}-metrics"

    def state_before(spark: SparkSession, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return spark.createDataFrame([], STATE)
        try:
            kept = spark.read.schema(f"{STATE}, batch_id bigint").parquet(f"{states}/slot={(batch_id - 1) % 2}")
            if kept.where(F.col("batch_id") == batch_id - 1).isEmpty():
                raise LookupError("no state of the batch before")
            return kept.where("metric IS NOT NULL").drop("batch_id")
        except (AnalysisException, LookupError):
            past = spark.read.schema(f"{HISTORY}, batch_id bigint").parquet(history_path)
            return _sums(past.where((F.col("batch_id") < batch_id) & F.col("metric").isin(*metrics)))

    def write(batch: DataFrame, batch_id: int) -> None:
        # Written once and read back, so the stateful part of the batch is not evaluated again.
        spark = batch.sparkSession
        own = f"{history_path}/batch_id={batch_id}"
        long_metrics(batch).write.mode("overwrite").parquet(own)
        arrived = spark.read.schema(HISTORY).parquet(own).where(F.col("metric").isin(*metrics))
        before = state_before(spark, batch_id)
        if not arrived.isEmpty():
            alerts = alerts_of(judged_by_state(before, arrived, threshold))
            alerts.write.mode("overwrite").parquet(f"{alerts_path}/batch_id={batch_id}")
        # A row without a metric says whose state this is, also if it is empty.
        mark = spark.createDataFrame([(None, None, 0, 0.0, 0.0)], STATE)
        after = advanced_state(before, arrived).unionByName(mark).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        after.coalesce(1).write.mode("overwrite").parquet(f"{states}/slot={batch_id % 2}")

    return (
        wide.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
