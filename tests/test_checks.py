"""Default checks, expectations, validators and dataset runs."""

import pytest
from pyspark.sql import functions as F

from assay.functions import predicates as p
from assay.operators import checks as ck
from assay.operators import datasets as ds
from assay.operators import expectations as ex
from tests.conftest import executed, rows


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [
            (1, 5.0, "plain text 1", None),
            (2, 0.0, "\t ", None),
            (3, -1.0, "", None),
            (4, None, None, None),
            (5, 7.0, "café", None),
            (6, 7.0, "line\n", None),
        ],
        "id long, n double, s string, d date",
    )


def outcome(frame):
    return {(r["column_name"], r["check_name"]): (r["success"], r["failed_rows"]) for r in frame.collect()}


def test_default_checks_by_type(df):
    got = outcome(ck.default_column_checks(df))
    assert got == {
        ("id", "missing_values"): (True, 0),
        ("id", "negative_values"): (True, 0),
        ("id", "zero_values"): (True, 0),
        ("n", "missing_values"): (False, 1),
        ("n", "negative_values"): (False, 2),  # null fails
        ("n", "zero_values"): (False, 1),  # null passes
        ("s", "missing_values"): (False, 1),
        ("s", "empty_strings"): (False, 3),  # blanks, empty, null
        ("s", "special_characters"): (False, 1),  # accent; null passes, a final newline is white space
        ("d", "missing_values"): (False, 6),
    }


def test_default_checks_share_one_scan(spark, sf):
    customers = spark.read.parquet(f"{sf}/customer.parquet")
    assert executed(ck.default_column_checks(customers)).count("FileScan") == 1


def test_checks_of_an_empty_table_pass(spark, df):
    assert all(ok for ok, _ in outcome(ck.default_column_checks(df.limit(0))).values())


def test_check_that_does_not_fit_is_an_error_row(df):
    bad = ck.Check("bad", "uses a missing column", lambda c: c > F.col("nope"))
    got = {r["check_name"]: r for r in ck.run_column_checks(df, {"n": [bad, ck.ZERO_VALUES]}).collect()}
    assert not got["bad"]["success"] and "nope" in got["bad"]["error"]
    assert got["zero_values"]["failed_rows"] == 1 and got["zero_values"]["error"] is None


def test_unknown_column(df):
    with pytest.raises(ValueError, match="column nope not found"):
        ck.default_column_checks(df, ["nope"])


def test_report_rows_summary_and_filter(df):
    checks = {"n": [ck.NEGATIVE_VALUES], "s": [ck.EMPTY_STRINGS]}
    report = ck.passfail_rows(df, checks, "id")
    assert report.count() == 12
    assert "Exchange" not in executed(report)
    summary = rows(ck.passfail_summary(df, checks))
    assert summary == [("n", "negative_values", 6, 4, 2), ("s", "empty_strings", 6, 3, 3)]
    for column, name, _, passed, failed in summary:
        by_status = dict(rows(report.where(F.col("check_name") == name).groupBy("status").count()))
        assert by_status == {"Passed": passed, "Failed": failed}
    only = ck.passfail_rows(df, checks, "id", status="Failed", check_name="negative_values")
    assert rows(only.select("id")) == [(3,), (4,)]
    with pytest.raises(ValueError, match="no check named"):
        ck.passfail_rows(df, checks, "id", check_name="nope")


def test_expectations(df):
    assert tuple(ex.expect_not_null(df, "n").first())[1:] == (False, 6, 1, pytest.approx(100 / 6))
    assert tuple(ex.expect_unique(df, "n").first())[1:] == (False, 6, 2, 4, pytest.approx(200 / 6))
    assert tuple(ex.expect_in_range(df, "n", 0, 5).first())[1:] == (False, 5, 3, 60.0, -1.0, 7.0, None)
    assert tuple(ex.expect_in_range(df, "n", min_value=-1).first())[1:4] == (True, 5, 0)
    assert tuple(ex.expect_in_range(df, "n", max_value=5).first())[1:4] == (False, 5, 2)
    assert tuple(ex.expect_in_range(df, "n").first())[1:] == (True, *[None] * 5, "No range specified")
    assert tuple(ex.expect_in_range(df, "s", 0, 1).first())[1:] == (False, *[None] * 5, "Column is not numeric")


def test_expectations_of_an_empty_table(df):
    empty = df.limit(0)
    assert tuple(ex.expect_not_null(empty, "n").first())[1:] == (True, 0, 0, 0.0)
    assert tuple(ex.expect_unique(empty, "n").first())[1:] == (True, 0, 0, 0, 0.0)
    assert tuple(ex.expect_in_range(empty, "n", 0, 1).first())[1:5] == (True, 0, 0, 0.0)


@pytest.mark.parametrize(
    ("text", "valid"),
    [
        ("2024-01-05", True),
        ("2024-1-5", True),
        ("2024-02-29", True),
        ("2023-02-29", False),
        ("2024-02-30", False),
        ("2024-13-01", False),
        ("20240105", False),
        ("24-01-05", False),
        ("2024-01-05 10:00", False),
        ("2024-01-05 ", False),
        ("2024-01-05\n", False),
        ("", False),
        (None, None),
    ],
)
def test_dates(spark, text, valid):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(p.is_date(F.col("x"))).first()[0] is valid


@pytest.mark.parametrize(
    ("text", "valid"),
    [("AB123456C", True), ("QQ123456C", False), ("AB123456E", False), ("AB12345C", False), ("AB123456C\n", False)],
)
def test_nino(spark, text, valid):
    assert spark.createDataFrame([(text,)], "x string").select(p.is_nino(F.col("x"))).first()[0] is valid


@pytest.mark.parametrize(
    ("text", "valid"), [("a.b+c@ex-1.org", True), ("a@b", False), ("a b@c.de", False), ("a@b.c1", False)]
)
def test_email(spark, text, valid):
    assert spark.createDataFrame([(text,)], "x string").select(p.is_email(F.col("x"))).first()[0] is valid


def test_range_is_inclusive_and_skips_null(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "x int")
    assert [r[0] for r in df.select(p.in_range(F.col("x"), 2, 3)).collect()] == [False, True, True, False]


def test_dataset_run_and_report(spark):
    people = spark.createDataFrame(
        [("a@b.cd", "AB123456C", "2024-01-01"), (None, "XX", "2024-02-30"), ("a@b.cd", "AB123456C", "2024-01-01")],
        "email string, nino string, Birth_Date string",
    )
    other = spark.createDataFrame([(1, "x"), (2, "y")], "id int, email string")
    got = {(r["dataset"], r["check_name"], r["column_name"]): r["value"] for r in ds.quality_checks({"people": people, "other": other}).collect()}
    assert got == {
        ("people", "missing_values", "email"): pytest.approx(1 / 3),
        ("people", "duplicates", None): 1.0,
        ("people", "invalid_dates", "Birth_Date"): 1.0,
        ("people", "invalid_emails", "email"): 1.0,
        ("people", "invalid_ninos", "nino"): 1.0,
        ("other", "duplicates", None): 0.0,
    }
    report = ds.quality_report(ds.quality_checks({"people": people, "other": other}))
    assert {r["dataset"] for r in report.collect()} == {"people"}


def test_no_date_columns(spark):
    assert ds.invalid_dates(spark.createDataFrame([(1,)], "date_id int")).count() == 0


def test_suite(spark):
    suite = ds.CheckSuite().add_quality_check("n", lambda d: d.agg(F.count(F.lit(1)).alias("n")))
    assert rows(suite.run_quality_checks(spark.range(3))) == [("n", 3)]
    with pytest.raises(ValueError):
        ds.CheckSuite().run_quality_checks(spark.range(3))


def test_row_checks_of_a_suite_share_a_scan(spark):
    df = spark.range(100).selectExpr("id", "IF(id % 10 = 0, NULL, id % 7) AS x").repartition(3)
    suite = ds.CheckSuite()
    for i in range(20):
        suite.add_row_check(f"c{i}", f"x = {i}")
    suite.add_row_check("column", F.col("x").isNull()).add_row_check("function", lambda t: t["id"] < 5)
    found = suite.run_quality_checks(df)
    assert executed(found).count("Range (0, 100") == 1
    got = dict(rows(found))
    assert got["column"] == 10 and got["function"] == 5 and got["c19"] == 0
    assert sum(got[f"c{i}"] for i in range(20)) == 90
    suite.add_quality_check("groups", lambda t: t.groupBy("x").count().agg(F.count(F.lit(1)).alias("found")))
    assert dict(rows(suite.run_quality_checks(df)))["groups"] == 8
    assert dict(rows(suite.run_quality_checks(df.limit(0))))["column"] == 0
