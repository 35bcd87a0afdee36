"""Equi-joins that stay balanced when one key holds a large share of the rows.

Rows of a heavy key are spread over several salts, and the matching rows of the other
side are copied once per salt. The number of salts follows the exact row count of the
key, so no task gets much more than ``hot_rows`` rows of one key. At most
``rows / hot_rows`` keys can be heavy, which bounds the broadcast list of them: one
million rows per key and 100 billion rows give at most 100,000 pairs of numbers.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000


def heavy_keys(counts: DataFrame, on: list[str], hot_rows: int) -> DataFrame:
    """Key hash and number of salts for keys with more than ``hot_rows`` rows.

    Keys are told apart by hash only: two heavy keys with one hash share their salts,
    which is harmless because the join itself still compares the keys.
    """
    return (
        counts.where(F.col("_n") > hot_rows)
        .groupBy(F.xxhash64(*on).alias("_hash"))
        .agg(F.ceil(F.sum("_n") / F.lit(hot_rows)).cast("int").alias("_salts"))
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    salt_by: list[str],
    how: str = "inner",
    null_safe: bool = False,
    counts: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``left`` to ``right`` on equally named columns, splitting heavy keys of ``left``.

    ``salt_by`` names the columns that tell rows of one key apart (usually a row id). The
    salt is a hash of them, never a random number, so a task that is run again after a
    lost executor sends every row to the same place as before. ``counts`` may hold the
    left row count per key as columns ``on`` + ``_n`` if the caller has it already.
    ``how`` is inner, left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    left_types, right_types = dict(left.dtypes), dict(right.dtypes)
    for name in on:
        if left_types[name] != right_types[name]:
            raise ValueError(
                f"join column {name}: {left_types[name]} on the left, {right_types[name]} on the right"
            )
    if counts is None:
        counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    heavy = F.broadcast(heavy_keys(counts, on, hot_rows))

    spread = (
        left.withColumn("_hash", F.xxhash64(*on))
        .join(heavy, "_hash", "left")
        .withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*salt_by), "_salts"), F.lit(0)).cast("int"))
        .drop("_hash", "_salts")
    )
    copied = (
        right.withColumn("_hash", F.xxhash64(*on))
        .join(heavy, "_hash", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_hash", "_salts")
    )
    if not null_safe:
        return spread.join(copied, [*on, "_salt"], how).drop("_salt")

    renamed = copied.withColumnsRenamed({c: f"_r_{c}" for c in [*on, "_salt"]})
    condition = F.col("_salt") == F.col("_r__salt")
    for name in on:
        condition = condition & F.col(name).eqNullSafe(F.col(f"_r_{name}"))
    joined = spread.join(renamed, condition, how)
    return joined.drop("_salt", *[c for c in renamed.columns if c.startswith("_r_")])
