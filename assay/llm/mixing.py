"""Mixing sources to target weights, in DataFrame operations only.

Sources share a total by weight, none above a multiple of its own size. Words are added up per
source, targets and repetition rates derived, and every document comes floor(rate) times plus
once more if a number made from its id is below the fraction.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assay.llm.common import table, uniform

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2
) -> DataFrame:
    """``source, source_size, target`` from ``sizes(source, source_size)``, one row per source.

    Sources in code-point order, null last, take the weights in turn. A source is full at
    ``most`` times its size, and what it can't take is shared anew by weight. The sources that
    fill first are those with the least capacity per weight, so that one ordered pass finds the
    level at which all others stand: no rounds are needed. The table has one row per source.
    """
    ranked = sizes.withColumn(
        "_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn(
        "_weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    )
    full = F.col("source_size") * F.lit(most)
    by_need = Window.orderBy(full / F.col("_weight"), "_rank")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    open_share = F.lit(share) * total - F.coalesce(F.sum(full).over(before), F.lit(0))
    level = ranked.withColumn("_level", open_share / F.sum("_weight").over(rest)).withColumn(
        "_full", full <= F.col("_level") * F.col("_weight")
    )
    # The first source that stays below its capacity sets the level for all that follow.
    stands = F.min(F.when(~F.col("_full"), F.struct(full / F.col("_weight"), "_rank", "_level"))).over(
        Window.partitionBy()
    )
    target = F.when(
        stands.isNull() | (F.struct(full / F.col("_weight"), "_rank") < F.struct(stands["col1"], stands["_rank"])),
        full.cast("double"),
    ).otherwise(stands["_level"] * F.col("_weight"))
    return level.select("source", "source_size", target.alias("target"))


def _copies(doc_id: Column, target: Column, source_size: Column) -> Column:
    """How often a document is taken: floor(target / source_size), plus once by a number made from its id."""
    rate = F.coalesce(F.try_divide(target, source_size), F.lit(0.0))
    u = uniform(F.lit("mix"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return (F.floor(rate) + (u < rate - F.floor(rate)).cast("long")).cast("long")


def mix(docs: DataFrame, **shares) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` for every row of ``docs``.

    ``copies`` is how often the mix takes the document. Rows of a source with equal doc_id, null
    included, decide alike. Sources without words have target 0 and give no copies.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), **shares)
    # A null source equals a null source here.
    joined = sized.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    copies = _copies(F.col("doc_id"), F.col("target"), F.col("source_size"))
    return joined.select("doc_id", "d.source", "size", "source_size", "target", copies.alias("copies"))


def mixed(docs: DataFrame, **shares) -> DataFrame:
    """Every row of ``docs``, with all its columns, as often as :func:`mix` takes it."""
    sized = docs.select("source", word_count(F.col("text")).alias("size"))
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), **shares)
    # Kept in one column, so that none of the documents' columns clashes.
    targets = targets.select(F.struct("source", "source_size", "target").alias("_mix"))
    joined = docs.join(targets, F.col("source").eqNullSafe(F.col("_mix.source")))
    copies = _copies(F.col("doc_id"), F.col("_mix.target"), F.col("_mix.source_size")).cast("int")
    return joined.withColumn("_time", F.explode(F.array_repeat(F.lit(0), copies))).select(*docs.columns)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    taken = F.col("size") * F.col("copies")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


QUERIES = {"op4_mixing": op4_mixing}

SQL = {
    "op4_mixing": r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM per
), total AS (
  SELECT 1.5 * CAST(sum(source_size) AS DOUBLE) AS t FROM per
), levels AS (
  -- the level if exactly the sources with less capacity per weight than this one are full
  SELECT a.source, a.w, a.source_size,
         ((SELECT t FROM total) - coalesce((SELECT sum(2 * b.source_size) FROM ranked b
            WHERE 2.0 * b.source_size / b.w < 2.0 * a.source_size / a.w), 0))
         / (SELECT sum(b.w) FROM ranked b
            WHERE 2.0 * b.source_size / b.w >= 2.0 * a.source_size / a.w) AS level
  FROM ranked a
), stands AS (
  SELECT arg_min(level, 2.0 * source_size / w) AS level FROM levels WHERE 2.0 * source_size > level * w
), targets AS (
  SELECT r.source, r.source_size,
         CASE WHEN s.level IS NULL OR 2.0 * r.source_size <= s.level * r.w
              THEN CAST(2 * r.source_size AS DOUBLE) ELSE s.level * r.w END AS target
  FROM ranked r CROSS JOIN stands s
), rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size = 0 THEN 0.0 ELSE t.target / t.source_size END AS rate,
         CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
              AS DOUBLE) / 4294967296.0 AS u
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       size * CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM rated
"""
}
