"""Profiles kept per part of a table and merged on reading.

A part, such as a day, is scanned once. What is kept of each of its columns merges exactly (counts, means,
deviations, extremes, lengths) or within known bounds (distinct values and quantiles, as sketches), so a
profile of the whole table after a new part reads the rows of that part and the states of the others.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators.profile import _as_text, column_class
from assay.plans.shape import name, rows_of, text
from assay.sources.results import publish

#: Standard error of a distinct count is about 1.04 / sqrt(2 ** HLL_BITS): 0.8 %.
HLL_BITS = 14
#: A quantile's rank is off by less than 0.3 % of the rows, with 99 % confidence.
KLL_SIZE = 1000

FIELDS = {
    "column_name": "string", "dtype": "string", "column_class": "string", "total": "bigint", "missing": "bigint",
    "numbers": "bigint", "mean": "double", "squares": "double", "min": "double", "max": "double", "quantiles": "binary",
    "distincts": "binary", "characters": "bigint", "max_length": "int", "empty_strings": "bigint",
}
SCHEMA = ", ".join(f"{f} {t}" for f, t in FIELDS.items()) + ", part string"


def profile_states(df: DataFrame, part: Column) -> DataFrame:
    """One row per part and column with mergeable measures, from one scan of ``df``.

    ``part`` names the part of a row, NULL being one of its own. A task sends one set of sketches per part
    that it meets, so parts should follow the layout of the table, as folders do.
    """
    types = dict(df.dtypes)
    aggs, outputs = [F.count(F.lit(1)).alias("total")], []
    for i, column in enumerate(df.columns):
        kind, c = column_class(df, column), name(column)
        measures = {
            "missing": f"count_if({c} IS NULL)",
            # The sketch passes over empty text, so every value gets a mark in front.
            "distincts": f"hll_sketch_agg(concat('=', {_as_text(column, types[column])}), {HLL_BITS})",
        }
        if kind == "numeric":
            v = f"CAST({c} AS DOUBLE)"
            measures |= {
                "numbers": f"count({v})",
                "mean": f"avg({v})",
                "squares": f"var_pop({v}) * count({v})",
                "min": f"min({v})",
                "max": f"max({v})",
                "quantiles": f"kll_sketch_agg_double(CASE WHEN NOT isnan({v}) THEN {v} END, {KLL_SIZE})",
            }
        elif kind == "string":
            measures |= {
                "characters": f"sum(length({c}))",
                "max_length": f"max(length({c}))",
                "empty_strings": f"count_if({c} = '')",
            }
        aggs += [F.expr(agg).alias(f"{m}_{i}") for m, agg in measures.items()]
        known = {"column_name": text(column), "dtype": text(types[column]), "column_class": text(kind), "total": "total"}
        known |= {m: f"{m}_{i}" for m in measures}
        outputs.append({f: f"CAST({known.get(f, 'NULL')} AS {t})" for f, t in FIELDS.items()})
    # The caller's columns may have any name, so the part is named after all of them are in aggregates.
    return rows_of(df.groupBy(part.cast("string").alias("part")).agg(*aggs), outputs, ["part"]).select(*FIELDS, "part")


def store_profile(df: DataFrame, path: str, part: str, only: list | None = None) -> None:
    """Keep the states of the parts of ``df`` (of those in ``only``, if given), in place of earlier ones of the same parts.

    ``part`` is the column that names them. If it is a partition column, ``only`` prunes the scan.
    """
    own = F.col(name(part))
    chosen = df if only is None else df.where(own.isin(only))
    publish(profile_states(chosen, own), path, ["part"])


def load_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def merge_states(states: DataFrame) -> DataFrame:
    """One row per column as ``table_profile`` gives, with approximate ``median`` and ``distinct_values``.

    A column that only some parts have is measured over those. Types that changed between parts
    are listed with a bar between them. The states of a column are combined map-side.
    """
    sums = states.groupBy("column_name").agg(
        F.array_join(F.array_sort(F.collect_set("dtype")), "|").alias("dtype"),
        F.array_join(F.array_sort(F.collect_set("column_class")), "|").alias("column_class"),
        *[F.sum(f).alias(f) for f in ("total", "missing", "numbers", "characters", "empty_strings")],
        F.expr("try_divide(sum(mean * numbers), sum(numbers))").alias("mean"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.max("max_length").alias("max_length"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_sketch_estimate(F.hll_union_agg("distincts")).alias("distinct_values"),
    )
    # Deviations from the common mean: those within the parts and those of the parts' own means.
    apart = states.select("column_name", "numbers", "squares", F.col("mean").alias("own")).join(
        sums.select("column_name", "mean"), "column_name"
    )
    squares = apart.groupBy("column_name").agg(
        F.expr("sum(squares + numbers * (own - mean) * (own - mean))").alias("squares")
    )
    some = "kll_sketch_get_n_double(quantiles) > 0"
    return sums.join(squares, "column_name").selectExpr(
        "column_name",
        "dtype",
        "column_class",
        "missing",
        "total",
        "try_divide(CAST(missing AS DOUBLE), total) AS ratio",
        "mean",
        f"CASE WHEN numbers > 0 AND {some} THEN kll_sketch_get_quantile_double(quantiles, 0.5D) END AS median",
        "CASE WHEN numbers > 1 THEN sqrt(squares / (numbers - 1)) END AS std",
        "min",
        "max",
        "try_divide(CAST(characters AS DOUBLE), CASE WHEN column_class = 'string' THEN total - missing END) AS avg_length",
        "max_length",
        "empty_strings",
        "distinct_values",
    )


def stored_profile(spark: SparkSession, path: str) -> DataFrame:
    """The profile of all parts kept under ``path``; no row of the table is read."""
    return merge_states(load_states(spark, path))
