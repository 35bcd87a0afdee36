"""Profiles merged from parts against profiles of the whole table."""

import random
import statistics

import pytest

from assay.operators import profile as pr
from assay.operators import stored_profile as sp
from assay.plans.lineage import fresh_dir

EXACT = ["dtype", "column_class", "missing", "total", "ratio", "mean", "std", "min", "max", "avg_length", "max_length", "empty_strings"]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(6)
    rows = []
    for i in range(20_000):
        day = f"2024-01-0{1 + i % 5}"
        x = None if i % 9 == 0 else 1e6 + rng.gauss(i % 5, 1)
        rows.append((i, x, rng.choice(["", "a", "bcd", None]), None, i % 3 == 0, day))
    path = fresh_dir(spark, "parts")
    spark.createDataFrame(rows, "id bigint, x double, `s.t` string, none int, flag boolean, day string").write.partitionBy("day").parquet(path)
    return spark.read.schema("id bigint, x double, `s.t` string, none int, flag boolean, day string").parquet(path)


def check(got, want):
    got = {r.column_name: r for r in got.collect()}
    want = {r.column_name: r for r in want.collect()}
    assert got.keys() == want.keys()
    for column, r in want.items():
        for field in EXACT:
            assert got[column][field] == (pytest.approx(r[field], rel=1e-9) if isinstance(r[field], float) else r[field]), (column, field)
        # Five standard errors.
        assert got[column].distinct_values == pytest.approx(r.distinct_values, rel=0.04), column


def test_merged_parts_equal_the_whole(spark, table):
    path = fresh_dir(spark, "profile")
    sp.store_profile(table, path, "day")
    merged = sp.stored_profile(spark, path)
    check(merged, pr.table_profile(table))
    got = {r.column_name: r.median for r in merged.collect()}
    for column in ("id", "x"):
        values = sorted(r[0] for r in table.select(column).where(f"{column} IS NOT NULL").collect())
        below = sum(v < got[column] for v in values) / len(values)
        assert abs(below - 0.5) < 0.003
    assert got["none"] is None and got["s.t"] is None


def test_a_new_part_reads_that_part_only(spark, table):
    path = fresh_dir(spark, "profile")
    first = ["2024-01-01", "2024-01-02"]
    sp.store_profile(table, path, "day", first)
    check(sp.stored_profile(spark, path), pr.table_profile(table.where(table.day.isin(first))))
    chosen = table.where(table.day.isin(["2024-01-03"]))
    plan = sp.profile_states(chosen, table.day)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "PartitionFilters: [isnotnull(day" in plan
    sp.store_profile(table, path, "day", ["2024-01-03"])
    # A part that is stored again is not counted twice.
    sp.store_profile(table, path, "day", ["2024-01-02"])
    check(sp.stored_profile(spark, path), pr.table_profile(table.where(table.day <= "2024-01-03")))
    assert "FileScan" in sp.stored_profile(spark, path)._jdf.queryExecution().executedPlan().toString()


def test_empty_tables_null_parts_and_clashing_names(spark):
    schema = "part string, total double, mean int, missing string"
    empty = spark.createDataFrame([], schema)
    assert sp.profile_states(empty, empty.part).count() == 0
    assert sp.merge_states(sp.profile_states(empty, empty.part)).count() == 0
    df = spark.createDataFrame([(None, float("nan"), 1, "x"), (None, 2.0, None, None), ("p", None, 3, "yy")], schema)
    got = {r.column_name: r for r in sp.merge_states(sp.profile_states(df, df.part)).collect()}
    assert (got["part"].missing, got["part"].total, got["part"].distinct_values) == (2, 3, 1)
    assert (got["mean"].mean, got["mean"].std, got["mean"].missing) == (2.0, statistics.stdev([1, 3]), 1)
    assert got["total"].median == 2.0 and got["missing"].avg_length == 1.5


def test_a_column_of_some_parts_only(spark):
    one = spark.createDataFrame([("a", 1)], "part string, x int")
    two = spark.createDataFrame([("b", 2.5, "n"), ("b", 3.5, None)], "part string, x double, extra string")
    states = sp.profile_states(one, one.part).unionByName(sp.profile_states(two, two.part))
    got = {r.column_name: r for r in sp.merge_states(states).collect()}
    assert (got["x"].dtype, got["x"].total, got["x"].max) == ("double|int", 3, 3.5)
    assert (got["extra"].total, got["extra"].missing) == (2, 1)
