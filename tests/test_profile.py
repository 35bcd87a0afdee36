"""Profiling on small frames with nulls, blanks, constants and no rows."""

import math

import pytest
from pyspark.sql import functions as F

from assay.operators import profile as pr
from assay.sources.tables import nan_to_null
from tests.conftest import executed, rows

SCHEMA = "id long, a double, b int, c string, d date"


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [
            (1, 1.0, 5, "x", None),
            (2, 2.0, 5, "", None),
            (3, None, 5, None, None),
            (4, 4.0, 5, "xyz", None),
            (5, 4.0, 5, "x", None),
        ],
        SCHEMA,
    )


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_missing(df, empty):
    got = {r["column_name"]: (r["missing"], r["total"], r["ratio"]) for r in pr.missing_by_column(df).collect()}
    assert got == {"id": (0, 5, 0.0), "a": (1, 5, 0.2), "b": (0, 5, 0.0), "c": (1, 5, 0.2), "d": (5, 5, 1.0)}
    assert {r["ratio"] for r in pr.missing_by_column(empty).collect()} == {None}


def test_missing_threshold_is_strict(df):
    names = {r["column_name"] for r in pr.missing_above_threshold(df, 0.2).collect()}
    assert names == {"d"}
    assert {r["column_name"] for r in pr.missing_above_threshold(df, 0.1).collect()} == {"a", "c", "d"}


def test_distinct_skips_nulls(df):
    got = dict(rows(pr.distinct_by_column(df)))
    assert got == {"id": 5, "a": 3, "b": 1, "c": 3, "d": 0}
    assert dict(rows(pr.distinct_by_column(df, ["c"], approximate=True))) == {"c": 3}


def test_basic_stats(df):
    got = {(r["section"], r["name"]): r["value"] for r in pr.table_basic_stats(df).collect()}
    assert got["table", "row_count"] == "5"
    assert got["table", "column_count"] == "5"
    assert got["table", "logical_bytes"] == str(5 * 8 + 4 * 8 + 5 * 4 + 5)
    assert got["missing_values", "d"] == "5"
    assert got["dtypes", "b"] == "int"


def test_duplicates_treat_null_as_equal(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (2, "a", None), (3, None, None), (4, None, None), (5, None, None), (6, "b", 1)],
        "id long, x string, y int",
    )
    assert pr.duplicate_count(df, ["x", "y"]).first()[0] == 3
    assert pr.duplicate_count(df, ["x", "y"], by_hash=True).first()[0] == 3
    assert pr.duplicate_count(df).first()[0] == 0
    for hot_rows in (1, 100):
        got = rows(pr.duplicate_rows(df, ["x", "y"], ["id"], hot_rows=hot_rows).select("id"))
        assert got == [(1,), (2,), (3,), (4,), (5,)]


def test_duplicates_of_empty_table(empty):
    assert pr.duplicate_count(empty).first()[0] == 0


def test_numeric_stats(df):
    got = {r["column_name"]: r for r in pr.numeric_column_stats(df).collect()}
    assert got["a"]["median"] == 3.0
    assert got["a"]["mean"] == 2.75
    assert got["b"]["std"] == 0.0
    approximate = {r["column_name"]: r for r in pr.numeric_column_stats(df, median="approximate").collect()}
    assert approximate["b"]["median"] == 5.0


def test_std_of_one_row_is_null(df):
    one = pr.numeric_column_stats(df.where("id = 1"), ["a"]).first()
    assert one["std"] is None
    assert one["median"] == 1.0


def test_numeric_stats_of_empty_table(empty):
    row = pr.numeric_column_stats(empty, ["a"]).first()
    assert tuple(row) == ("a", None, None, None, None, None)


def test_string_stats(df):
    row = pr.string_column_stats(df).first()
    assert tuple(row) == ("c", 1.25, 3, 1)


def test_top_values_break_ties_by_value(df):
    got = rows(pr.top_values(df, ["c", "b"], 2).select("column_name", "position", "value", "frequency"))
    assert got == [("b", 1, "5", 5), ("c", 1, "x", 2), ("c", 2, "", 1)]


def test_top_values_limits_before_the_shuffle(spark, sf):
    customers = spark.read.parquet(f"{sf}/customer.parquet")
    assert executed(pr.top_values(customers, ["c_name"], 5)).count("WindowGroupLimit") >= 2


def test_sample_values_is_a_top_k(df):
    sample = pr.sample_values(df, "c", "id", 2)
    assert rows(sample) == [(1, "x"), (2, "")]
    assert "TakeOrderedAndProject" in executed(sample)


def test_correlations(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 7, 1), (2.0, 4.0, 7, 3), (3.0, 6.0, 7, 1), (4.0, None, 7, 3)], "a double, b double, c int, d int"
    )
    got = {(r["column1"], r["column2"]): r for r in pr.relationship_strength(df).collect()}
    assert len(got) == 6
    assert got["a", "b"]["relationship"] == "strong"
    assert got["a", "c"]["correlation"] is None
    assert got["a", "c"]["relationship"] == "weak"
    assert got["a", "d"]["relationship"] == "moderate"
    matrix = {(r["column1"], r["column2"]): r["correlation"] for r in pr.correlation_matrix(df).collect()}
    assert len(matrix) == 16
    assert matrix["b", "a"] == matrix["a", "b"] == pytest.approx(1.0)
    assert matrix["a", "a"] == 1.0
    assert matrix["c", "c"] is None


def test_no_correlation_of_a_single_column(df):
    assert pr.correlation_matrix(df, ["a"]).count() == 0


def test_histogram_covers_all_values(df, spark):
    got = rows(pr.column_histogram(df, "a", 3).select("bucket", "lower", "upper", "frequency"))
    assert got == [(0, 1.0, 2.0, 1), (1, 2.0, 3.0, 1), (2, 3.0, 4.0, 2)]
    constant = rows(pr.column_histogram(df, "b", 2).select("bucket", "frequency"))
    assert constant == [(0, 5), (1, 0)]


def test_profile_has_one_row_per_column(df):
    got = {r["column_name"]: r for r in pr.table_profile(df).collect()}
    assert set(got) == set(df.columns)
    assert got["a"]["column_class"] == "numeric" and got["a"]["median"] == 3.0
    assert got["c"]["column_class"] == "string" and got["c"]["empty_strings"] == 1
    assert got["d"]["column_class"] == "other" and got["d"]["missing"] == 5


def test_assessments(df):
    table = {(r["section"], r["name"]): r["value"] for r in pr.table_assessment(df).collect()}
    assert table["basic_stats", "row_count"] == 5
    assert ("correlations", "id~a") in table
    column = {(r["section"], r["name"]): r["value"] for r in pr.column_assessment(df, "a", "id").collect()}
    assert column["numeric_stats", "median"] == "3.0"
    assert column["sample_values", "2"] == "2.0"
    with pytest.raises(ValueError, match="column nope not found"):
        pr.column_assessment(df, "nope")


def test_quality_dimensions(spark):
    df = spark.createDataFrame(
        [("p", 1, "a", 10), ("p", None, "b", 500), ("q", 3, None, None)], "g string, x int, y string, lag int"
    )
    got = rows(
        pr.quality_dimensions(
            df, [F.col("g")], ["x", "y"], [F.col("x") > 2], F.col("lag"), 100
        )
    )
    assert got == [("p", 2, 0.75, 1.0, 0.5), ("q", 1, 0.5, 0.0, 0.0)]


def test_nan_is_missing(spark):
    df = nan_to_null(spark.createDataFrame([(math.nan, "a"), (1.0, None)], "x double, `y.z` string"))
    assert rows(df) == [(None, "a"), (1.0, None)]
