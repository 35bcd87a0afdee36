"""Many measures in one aggregate, and the wide result turned into long rows.

Output rows are given as SQL text per field. One text for the whole reshape is parsed by
Spark in one go, which is much quicker to plan than building every literal by API calls.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Aggregates per scan. Above some 40 the generated method outgrows what the JVM compiles and
# rows cost ten times as much. Every scan reads only the columns of its own aggregates, so
# splitting by column hardly reads more.
PER_PASS = 32
PAIRS_PER_PASS = 10  # correlations, each worth several aggregates
COLUMNS_PER_PASS = 8  # columns with four or five measures each

Fields = dict[str, str]


def text(value: str | None) -> str:
    """SQL literal of a string."""
    if value is None:
        return "CAST(NULL AS STRING)"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def name(column: str) -> str:
    """Quoted identifier."""
    escaped = column.replace("`", "``")
    return f"`{escaped}`"


def rows_of(df: DataFrame, rows: list[Fields], keep: list[str] = ()) -> DataFrame:
    """One output row per entry and input row, with the kept columns in front."""
    structs = ", ".join(
        "named_struct(" + ", ".join(f"{text(field)}, {value}" for field, value in row.items()) + ")" for row in rows
    )
    return df.selectExpr(*[name(c) for c in keep], f"inline(array({structs}))")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name of a non-empty list."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def count_where(condition: Column) -> Column:
    """Number of rows for which ``condition`` is true, as BIGINT."""
    return F.count_if(condition)


def percent(part: str, whole: str, if_empty: float) -> str:
    """SQL text: ``part / whole * 100``, or ``if_empty`` for an empty table."""
    return f"CASE WHEN {whole} = 0 THEN {if_empty}D ELSE ({part}) / nullif({whole}, 0) * 100 END"


def one_scan(
    df: DataFrame, measures: list[tuple[Column | str, Callable[[str], Fields]]], per_pass: int = PER_PASS
) -> list[DataFrame]:
    """Many aggregates of one table in one scan (one per ``per_pass`` aggregates).

    Each measure is an aggregate and a function from the name of its value to the fields of
    its output row, which may also use ``_total``, the row count.
    """
    frames = []
    for start in range(0, len(measures), per_pass):
        chunk = measures[start : start + per_pass]
        values = df.agg(
            F.count(F.lit(1)).alias("_total"),
            *[(F.expr(m) if isinstance(m, str) else m).alias(f"_v{i}") for i, (m, _) in enumerate(chunk)],
        )
        frames.append(rows_of(values, [fields(f"_v{i}") for i, (_, fields) in enumerate(chunk)]))
    return frames
