"""Small helpers that several operators share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.plans.lineage import ROWS_PER_PART, fresh_dir, sized


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """The column of just this name, whatever marks it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def saved(df: DataFrame, name: str, rows: int | None = None, per_part: int = ROWS_PER_PART) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage, survives lost executors.

    ``rows`` and ``per_part`` keep small tables in few files, see :func:`sized`.
    """
    path = fresh_dir(df.sparkSession, name)
    sized(df, rows, per_part).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, most: int) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` are at most ``most``, else as it is."""
    return F.broadcast(df) if rows <= most else df


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is not in ``ids(doc_id)``; rows without an id stay."""
    return docs.join(ids, "doc_id", "left_anti").select(*docs.columns)


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the MD5 of the parts: the same in every run and every SQL engine."""
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
