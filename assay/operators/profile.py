"""Table and column profiling.

Measures of one table share one aggregate, hence one scan, and the single result row is
turned into long rows afterwards. Only exact distinct counts and duplicates need shuffles
that grow with the data.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.functions.gram import gram_correlations
from assay.functions.statistics import exact_medians, pearson
from assay.plans.shape import COLUMNS_PER_PASS, PAIRS_PER_PASS, count_where, name, one_scan, rows_of, text, union_all
from assay.plans.skew import HOT_ROWS, salted_join

# Bytes of the fixed-width types.
WIDTH = {
    "boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8,
    "date": 4, "timestamp": 8, "timestamp_ntz": 8,
}


def q(column: str) -> Column:
    """Column by exact name, dots included."""
    return F.col(name(column))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))]


def column_class(df: DataFrame, column: str) -> str:
    if column in numeric_columns(df):
        return "numeric"
    return "string" if column in string_columns(df) else "other"


def require_column(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise ValueError(f"column {column} not found")


# --- missing values, distinct values, sizes ---------------------------------------------


def missing_by_column(df: DataFrame) -> DataFrame:
    """``(column_name, missing, total, ratio)`` per column from one pass."""

    def fields(column: str):
        return lambda v: {
            "column_name": text(column),
            "missing": v,
            "total": "_total",
            "ratio": f"try_divide(CAST({v} AS DOUBLE), _total)",
        }

    return union_all(one_scan(df, [(f"count_if({name(c)} IS NULL)", fields(c)) for c in df.columns]))


def missing_above_threshold(df: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Columns whose share of nulls is strictly above ``threshold``."""
    return missing_by_column(df).where(F.col("ratio") > threshold)


def _as_text(column: str, dtype: str) -> str:
    """SQL text that is equal for equal values only; both zeros of a floating type are one value."""
    if dtype == "string":
        return name(column)
    if dtype in ("float", "double"):
        return f"CAST({name(column)} + 0{'D' if dtype == 'double' else 'F'} AS STRING)"
    if dtype == "binary":
        return f"hex({name(column)})"
    if dtype.startswith(("array", "map", "struct")):
        return f"CASE WHEN {name(column)} IS NOT NULL THEN to_json(struct({name(column)})) END"
    return f"CAST({name(column)} AS STRING)"


def distinct_by_column(df: DataFrame, columns: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """Non-null distinct values per column.

    The exact count turns the table into ``(column, value)`` pairs in the same scan, combines
    them map-side and shuffles what is left, so a frequent value costs one row per task.
    ``approximate`` keeps a fixed-size sketch per column instead.
    """
    columns = columns or df.columns

    def fields(column: str, v: str) -> dict[str, str]:
        return {"column_name": text(column), "distinct_values": v}

    if approximate:
        return union_all(
            one_scan(df, [(f"approx_count_distinct({name(c)})", lambda v, c=c: fields(c, v)) for c in columns])
        )
    types = dict(df.dtypes)
    cells = rows_of(df, [{"position": str(i), "value": _as_text(c, types[c])} for i, c in enumerate(columns)])
    counts = (
        cells.where("value IS NOT NULL")
        .groupBy("position", "value")
        .agg(F.lit(1).alias("one"))
        .groupBy()
        .agg(*[F.expr(f"count_if(position = {i})").alias(f"d_{i}") for i in range(len(columns))])
    )
    return rows_of(counts, [fields(c, f"d_{i}") for i, c in enumerate(columns)])


def logical_bytes(df: DataFrame) -> str:
    """SQL aggregate: bytes of all values, text by its length, other types by their width."""
    parts = []
    for column, dtype in df.dtypes:
        if dtype in WIDTH:
            parts.append(f"count({name(column)}) * {WIDTH[dtype]}")
        else:
            value = name(column) if dtype in ("string", "binary") else f"to_json(struct({name(column)}))"
            parts.append(f"coalesce(sum(octet_length({value})), 0)")
    return f"CAST({' + '.join(parts)} AS BIGINT)"


def table_basic_stats(df: DataFrame) -> DataFrame:
    """Long ``(section, name, value)``: row, column and byte counts, missing values, types."""

    def fields(section: str, item: str):
        return lambda v: {"section": text(section), "name": text(item), "value": f"CAST({v} AS STRING)"}

    measures = [
        ("count(1)", fields("table", "row_count")),
        (F.lit(len(df.columns)), fields("table", "column_count")),
        (logical_bytes(df), fields("table", "logical_bytes")),
        *[(f"count_if({name(c)} IS NULL)", fields("missing_values", c)) for c in df.columns],
    ]
    types = df.sparkSession.createDataFrame(
        [("dtypes", c, t) for c, t in df.dtypes], "section string, name string, value string"
    )
    return union_all([*one_scan(df, measures), types])


# --- duplicates -------------------------------------------------------------------------


def duplicate_count(df: DataFrame, subset: list[str] | None = None, by_hash: bool = False) -> DataFrame:
    """One row: rows that repeat an earlier row (null equals null).

    ``by_hash`` shuffles two 64-bit hashes per row instead of whole wide rows; a collision
    of both could over-count, so it is off by default.
    """
    columns = [q(c) for c in subset or df.columns]
    if by_hash:
        columns = [F.xxhash64(F.lit(1), *columns).alias("h1"), F.xxhash64(F.lit(2), *columns).alias("h2")]
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_records"))


def duplicate_rows(df: DataFrame, subset: list[str], key: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """All rows of groups with more than one row (null equals null).

    Group sizes are counted with map-side combine; the join back is salted by ``key``, so
    a value shared by a third of the table is spread over many tasks.
    """
    groups = df.groupBy(*[q(c) for c in subset]).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return salted_join(
        df, groups.drop("_n"), subset, key, "left_semi", null_safe=True, counts=groups, hot_rows=hot_rows
    )


# --- numeric and string measures ----------------------------------------------------------


def numeric_column_stats(
    df: DataFrame, columns: list[str] | None = None, median: str = "exact"
) -> DataFrame:
    """``(column_name, mean, median, std, min, max)`` per numeric column.

    ``median="approximate"`` stays in the one shared pass; ``"exact"`` adds bounded
    counting passes (see ``exact_medians``).
    """
    columns = columns or numeric_columns(df)
    exact = exact_medians(df, columns) if median == "exact" else None
    return _per_column(df, columns, lambda c, i: _numeric_parts(c, i, exact))


def _per_column(df: DataFrame, columns: list[str], parts) -> DataFrame:
    """One row per column from ``parts(column, position)`` = (aggregates, output fields).

    Columns share a scan, up to the number that generated code can hold; each scan reads
    its own columns only.
    """
    frames = []
    for start in range(0, len(columns), COLUMNS_PER_PASS):
        chunk = columns[start : start + COLUMNS_PER_PASS]
        planned = [parts(c, i) for i, c in enumerate(chunk)]
        values = df.agg(F.count(F.lit(1)).alias("total"), *[a for aggs, _ in planned for a in aggs])
        frames.append(
            rows_of(values, [{"column_name": text(c), **fields} for c, (_, fields) in zip(chunk, planned)])
        )
    return union_all(frames)


NUMERIC_FIELDS = ["mean", "median", "std", "min", "max"]


def _numeric_parts(column: str, i: int, exact: dict[str, float | None] | None) -> tuple[list[Column], dict[str, str]]:
    """Aggregates and output fields of a numeric column; the median is approximate without ``exact``."""
    v = f"CAST({name(column)} AS DOUBLE)"
    aggs = {
        f"mean_{i}": f"avg({v})",
        f"std_{i}": f"stddev_samp({v})",
        f"min_{i}": f"min({v})",
        f"max_{i}": f"max({v})",
    }
    fields = {field: f"{field}_{i}" for field in NUMERIC_FIELDS}
    if exact is None:
        aggs[f"median_{i}"] = f"percentile_approx({v}, 0.5, 10000)"
    else:
        middle = exact[column]
        fields["median"] = f"CAST({'NULL' if middle is None else text(repr(middle))} AS DOUBLE)"
    return [F.expr(agg).alias(alias) for alias, agg in aggs.items()], fields


def _string_parts(column: str, i: int) -> tuple[list[Column], dict[str, str]]:
    """Aggregates and output fields of a string column."""
    aggs = {
        f"avg_{i}": f"avg(length({name(column)}))",
        f"longest_{i}": f"max(length({name(column)}))",
        f"empty_{i}": f"count_if({name(column)} = '')",
    }
    fields = {"avg_length": f"avg_{i}", "max_length": f"longest_{i}", "empty_strings": f"empty_{i}"}
    return [F.expr(agg).alias(alias) for alias, agg in aggs.items()], fields


def string_column_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column_name, avg_length, max_length, empty_strings)`` per string column."""
    columns = columns or string_columns(df)
    return _per_column(df, columns, _string_parts)


def top_values(df: DataFrame, columns: list[str] | None = None, k: int = 5) -> DataFrame:
    """The ``k`` most frequent non-null values per column, ties by value.

    Values are counted with map-side combine; the rank filter is applied per partition
    before the ranks of a column meet in one place.
    """
    columns = columns or df.columns
    long = rows_of(df, [{"column_name": text(c), "value": f"CAST({name(c)} AS STRING)"} for c in columns])
    counts = long.where("value IS NOT NULL").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("frequency"))
    order = Window.partitionBy("column_name").orderBy(F.desc("frequency"), "value")
    return counts.withColumn("position", F.row_number().over(order)).where(F.col("position") <= k)


def sample_values(df: DataFrame, column: str, key: str, k: int = 5) -> DataFrame:
    """The column in the first ``k`` rows by ``key``: a top-k, not a full sort."""
    require_column(df, column)
    return df.select(key, q(column).cast("string").alias("value")).orderBy(key).limit(k)


# --- relationships ------------------------------------------------------------------------


def pairs(columns: list[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]


def _correlations(df: DataFrame, columns: list[str], diagonal: bool) -> DataFrame:
    """``(column1, column2, correlation)`` for each pair, in the order of ``columns``, in one scan.

    A few pairs are plain aggregates; more than a scan can hold of them come out of matrices.
    """
    if len(pairs(columns)) > PAIRS_PER_PASS:
        names = F.array(*[F.lit(c) for c in columns])
        found = gram_correlations(df, columns)
        return found.where("true" if diagonal else "i < j").select(
            names[F.col("i")].alias("column1"), names[F.col("j")].alias("column2"), "correlation"
        )

    def fields(a: str, b: str):
        return lambda r: {"column1": text(a), "column2": text(b), "correlation": r}

    measures = [(pearson(a, b), fields(a, b)) for a, b in pairs(columns)]
    if diagonal:
        one = "CASE WHEN stddev_pop(CAST({0} AS DOUBLE)) > 0 THEN 1D END"
        measures += [(one.format(name(c)), fields(c, c)) for c in columns]
    return union_all(one_scan(df, measures, len(measures)))


def correlation_pairs(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column1, column2, correlation)`` for each pair, all in one scan."""
    columns = columns or numeric_columns(df)
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], "column1 string, column2 string, correlation double")
    return _correlations(df, columns, False)


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Both directions of every pair; the diagonal is 1, or NULL for a constant column."""
    columns = columns or numeric_columns(df)
    if len(columns) < 2:
        return correlation_pairs(df, columns)
    both = rows_of(
        _correlations(df, columns, True),
        [
            {"column1": "column1", "column2": "column2", "correlation": "correlation", "mirrored": "false"},
            {"column1": "column2", "column2": "column1", "correlation": "correlation", "mirrored": "true"},
        ],
    )
    return both.where("NOT mirrored OR column1 <> column2").drop("mirrored")


def strength(correlation: Column) -> Column:
    """strong above 0.7, moderate above 0.3, otherwise (NULL included) weak."""
    return (
        F.when(F.abs(correlation) > 0.7, "strong").when(F.abs(correlation) > 0.3, "moderate").otherwise("weak")
    )


def relationship_strength(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per pair of numeric columns with its strength class."""
    return correlation_pairs(df, columns).withColumn("relationship", strength(F.col("correlation")))


# --- distribution ---------------------------------------------------------------------------


def column_histogram(df: DataFrame, column: str, buckets: int = 20) -> DataFrame:
    """``(bucket, lower, upper, frequency)`` over equal-width buckets, empty ones included."""
    bounds = df.agg(F.min(q(column)).cast("double").alias("low"), F.max(q(column)).cast("double").alias("high"))
    low, high = bounds.select("low").scalar(), bounds.select("high").scalar()
    v = q(column).cast("double")
    position = F.try_divide((v - low) * buckets, high - low)
    counts = (
        df.where(v.isNotNull())
        .select(F.least(F.coalesce(F.floor(position), F.lit(0)), F.lit(buckets - 1)).cast("int").alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )
    frame = rows_of(
        bounds,
        [
            {
                "bucket": str(i),
                "lower": f"low + (high - low) * {i} / {buckets}",
                "upper": f"low + (high - low) * {i + 1} / {buckets}",
            }
            for i in range(buckets)
        ],
    )
    return frame.join(counts, "bucket", "left").withColumn("frequency", F.coalesce("frequency", F.lit(0)))


# --- bundles ----------------------------------------------------------------------------------


def table_profile(
    df: DataFrame, median: str = "exact", approximate_distinct: bool = False
) -> DataFrame:
    """One row per column: type, class, missing, distinct, numeric and string measures.

    Each column is read once for everything but its distinct count, which needs a shuffle of
    its own, and its exact median, which is located beforehand.
    """
    exact = exact_medians(df, numeric_columns(df)) if median == "exact" else None
    blank_numbers = dict.fromkeys(NUMERIC_FIELDS, "CAST(NULL AS DOUBLE)")
    blank_strings = {
        "avg_length": "CAST(NULL AS DOUBLE)",
        "max_length": "CAST(NULL AS INT)",
        "empty_strings": "CAST(NULL AS BIGINT)",
    }
    types = dict(df.dtypes)

    def parts(column: str, i: int):
        kind = column_class(df, column)
        fields = {
            "dtype": text(types[column]),
            "column_class": text(kind),
            "missing": f"missing_{i}",
            "total": "total",
            "ratio": f"try_divide(CAST(missing_{i} AS DOUBLE), total)",
            **blank_numbers,
            **blank_strings,
        }
        aggs, own = [], {}
        if kind == "numeric":
            aggs, own = _numeric_parts(column, i, exact)
        elif kind == "string":
            aggs, own = _string_parts(column, i)
        return [F.expr(f"count_if({name(column)} IS NULL)").alias(f"missing_{i}"), *aggs], fields | own

    return _per_column(df, df.columns, parts).join(
        distinct_by_column(df, approximate=approximate_distinct), "column_name"
    )


def table_assessment(df: DataFrame) -> DataFrame:
    """Long ``(section, name, value)``: counts, missing values, duplicates, correlations."""

    def fields(section: str, item: str):
        return lambda v: {"section": text(section), "name": text(item), "value": f"CAST({v} AS DOUBLE)"}

    measures = [
        ("count(1)", fields("basic_stats", "row_count")),
        (F.lit(len(df.columns)), fields("basic_stats", "column_count")),
        *[(f"count_if({name(c)} IS NULL)", fields("missing_values", c)) for c in df.columns],
    ]
    related = correlation_pairs(df).select(
        F.lit("correlations").alias("section"),
        F.concat_ws("~", "column1", "column2").alias("name"),
        F.col("correlation").alias("value"),
    )
    duplicates = rows_of(duplicate_count(df), [fields("basic_stats", "duplicates")("duplicate_records")])
    return union_all([*one_scan(df, measures), related, duplicates])


def column_assessment(df: DataFrame, column: str, key: str | None = None) -> DataFrame:
    """Long ``(section, name, value)`` for one column; unknown columns raise before any work."""
    require_column(df, column)
    one = df.select(q(column).alias(column))

    def facts(frame: DataFrame, section: str, names: list[str]) -> DataFrame:
        return rows_of(
            frame, [{"section": text(section), "name": text(n), "value": f"CAST({n} AS STRING)"} for n in names]
        )

    frames = [
        facts(
            missing_by_column(one).withColumn("dtype", F.lit(dict(df.dtypes)[column])),
            "basic_stats",
            ["dtype", "missing"],
        ),
        facts(distinct_by_column(one), "basic_stats", ["distinct_values"]),
    ]
    kind = column_class(df, column)
    if kind == "numeric":
        measures = ["mean", "median", "std", "min", "max"]
        stats = numeric_column_stats(one)
        frames.append(facts(stats.withColumns({m: F.round(m, 6) for m in measures}), "numeric_stats", measures))
    elif kind == "string":
        stats = string_column_stats(one).withColumn("avg_length", F.round("avg_length", 6))
        frames.append(facts(stats, "string_stats", ["avg_length", "max_length", "empty_strings"]))
    if key is not None:
        sample = sample_values(df, column, key).withColumn("section", F.lit("sample_values"))
        frames.append(sample.select("section", F.col(key).cast("string").alias("name"), "value"))
    return union_all(frames)


def quality_dimensions(
    df: DataFrame,
    group: list[Column],
    cells: list[str],
    violations: list[Column],
    lag_seconds: Column,
    limit_seconds: float,
) -> DataFrame:
    """Completeness, accuracy and timeliness per group, each between 0 and 1.

    completeness = non-null cells / cells; accuracy = rows that break no rule / rows;
    timeliness = rows whose lag is known and at most the limit / rows.
    """
    filled = F.lit(0)
    for c in cells:
        filled = filled + F.when(q(c).isNotNull(), 1).otherwise(0)
    clean = F.lit(True)
    for violation in violations:
        clean = clean & ~F.coalesce(violation, F.lit(False))
    rows = F.count(F.lit(1))
    return df.groupBy(*group).agg(
        rows.alias("rows"),
        (F.sum(filled).cast("double") / (rows * len(cells))).alias("completeness"),
        (count_where(clean).cast("double") / rows).alias("accuracy"),
        (count_where(lag_seconds <= limit_seconds).cast("double") / rows).alias("timeliness"),
    )
