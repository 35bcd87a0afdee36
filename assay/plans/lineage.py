"""Shared folders and lineage cuts.

Iterative jobs cut their lineage with a reliable checkpoint, and jobs that write
intermediate tables put them in the same shared folder, so that a lost executor
never costs the work of earlier rounds.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's folder from ``spark.checkpoint.dir``; a temporary one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="assay-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is created or overwritten here."""
    return f"{shared_dir(spark)}/assay/{name}-{uuid.uuid4().hex}"


#: Fewest partitions that a table of known size is merged into, and rows per partition above that.
LEAST_PARTS, ROWS_PER_PART = 12, 200_000


def sized(df: DataFrame, rows: int | None, per_part: int = ROWS_PER_PART) -> DataFrame:
    """``df`` in no more partitions than its ``rows`` (at most so many) need; as it is if they aren't known.

    A table of some thousand rows in hundreds of partitions costs a file for each of them.
    """
    return df if rows is None else df.coalesce(max(LEAST_PARTS, -(-rows // per_part)))


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Materialise ``df`` in the shared folder and continue from there; ``rows`` as in :func:`sized`."""
    shared_dir(df.sparkSession)
    return sized(df, rows).checkpoint()
