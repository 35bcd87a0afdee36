"""Rule validation of arriving rows: valid rows go on, violating rows to quarantine."""

import logging
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assay.operators.rules import Rule, failing_rules, rule_errors, run_rules_isolated

log = logging.getLogger(__name__)


def with_failing_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``failed_rules``, the ids of the violated rules; a stateless map."""
    return df.withColumn("failed_rules", failing_rules(rules))


def start_rule_validation(
    stream: DataFrame,
    rules: Callable[[], list[Rule]],
    valid_path: str,
    quarantine_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    errors_path: str | None = None,
) -> StreamingQuery:
    """Split every micro-batch by its violations.

    ``rules`` is asked for the current rules at each batch, so registry changes take effect
    without a restart. No row passes unjudged: a rule that cannot run, by its text or on the
    values of the batch, sends all rows of the batch to quarantine under its id, and its error
    is logged and written to ``errors_path`` as ``(rule_id, column_name, error)``, if given.
    Each batch owns one folder per sink and overwrites it, which makes a repeated batch harmless.
    """

    def split(batch: DataFrame, batch_id: int, usable: list[Rule], broken: list[str]) -> None:
        unjudged = F.array(*[F.lit(b) for b in broken]).cast("array<string>")
        marked = with_failing_rules(batch, usable)
        marked = marked.withColumn("failed_rules", F.concat("failed_rules", unjudged)).persist()
        try:
            bad = F.size("failed_rules") > 0
            marked.where(~bad).drop("failed_rules").write.mode("overwrite").parquet(
                f"{valid_path}/batch_id={batch_id}"
            )
            marked.where(bad).write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={batch_id}")
        finally:
            marked.unpersist()

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        current = rules()
        errors = rule_errors(batch, current)

        def attempt() -> None:
            usable = [r for i, r in enumerate(current) if i not in errors]
            split(batch, batch_id, usable, [current[i].rule_id for i in sorted(errors)])

        try:
            attempt()
        except PySparkException:
            # Which rules fail on the values? If none does, the cause is elsewhere.
            at = [i for i in range(len(current)) if i not in errors]
            found = {}
            for i in at:
                row = run_rules_isolated(batch, [current[i]]).first()
                if row["error"] is not None:
                    found[i] = row["error"]
            if not found:
                raise
            errors.update(found)
            attempt()
        for i, error in errors.items():
            log.error("rule %s cannot run on batch %d: %s", current[i].rule_id, batch_id, error)
        if errors_path is not None:
            failed = [(current[i].rule_id, current[i].column_name, error) for i, error in sorted(errors.items())]
            schema = "rule_id string, column_name string, error string"
            sink = batch.sparkSession.createDataFrame(failed, schema)
            sink.write.mode("overwrite").parquet(f"{errors_path}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
