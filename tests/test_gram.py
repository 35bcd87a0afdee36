"""Correlations out of matrices against plain aggregates."""

import math

import numpy as np
import pytest

from assay.functions.gram import batch_moments, merged
from assay.functions.statistics import pearson
from assay.operators import profile as pr
from tests.conftest import executed

COLUMNS = ["a", "b", "c", "far", "unit", "thin", "none", "part", "odd`name", "whole"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(3000):
        a = rng.normal()
        b = None if rng.random() < 0.3 else a * 2 + rng.normal()
        c = None if rng.random() < 0.3 else rng.lognormal(0, 3)
        # ``part`` is constant wherever ``thin`` is present.
        thin = float(rng.normal()) if i % 50 == 0 else None
        part = 0.1 if i % 50 == 0 else float(rng.normal())
        rows.append((float(a), b if b is None else float(b), c if c is None else float(c), 1e9 + a, 0.1, thin, None, part, -a, i % 7))
    types = ["double"] * 9 + ["bigint"]
    schema = ", ".join(f"`{c.replace('`', '``')}` {t}" for c, t in zip(COLUMNS, types, strict=True))
    return spark.createDataFrame(rows, schema).repartition(7)


def plain(df, columns):
    got = {}
    for a, b in pr.pairs(columns):
        got[a, b] = df.selectExpr(f"{pearson(a, b)} AS r").first()["r"]
    return got


def test_matrices_equal_aggregates(table):
    got = {(r.column1, r.column2): r.correlation for r in pr.correlation_pairs(table, COLUMNS).collect()}
    want = plain(table, COLUMNS)
    assert got.keys() == want.keys()
    for pair, r in want.items():
        assert (got[pair] is None) == (r is None), pair
        if r is not None:
            assert got[pair] == pytest.approx(r, abs=1e-6 if "far" in pair else 1e-12), pair
    assert got["part", "odd`name"] is not None and got["thin", "part"] is None


def test_matrix_has_both_directions_and_a_diagonal(table):
    got = {(r.column1, r.column2): r.correlation for r in pr.correlation_matrix(table, COLUMNS).collect()}
    assert len(got) == len(COLUMNS) ** 2
    assert [got[c, c] for c in COLUMNS] == [1, 1, 1, 1, None, 1, None, 1, 1, 1]
    assert all(got[a, b] == got[b, a] for a, b in got)


def test_empty_table_and_values_that_are_not_finite(spark):
    columns = [f"x{i}" for i in range(6)]
    schema = ", ".join(f"{c} double" for c in columns)
    empty = pr.correlation_pairs(spark.createDataFrame([], schema)).collect()
    assert len(empty) == 15 and {r.correlation for r in empty} == {None}
    rows = [(1.0, 2.0, math.nan, 1.0, None, 5.0), (2.0, 1.0, 3.0, math.inf, 1.0, 5.0), (3.0, 5.0, None, 1.0, 2.0, 5.0)]
    df = spark.createDataFrame(rows, schema)
    got = {(r.column1, r.column2): r.correlation for r in pr.correlation_pairs(df).collect()}
    want = plain(df, columns)
    for pair, r in want.items():
        assert str(got[pair]) == str(r) or got[pair] == pytest.approx(r), pair


def test_two_hundred_columns_take_one_scan(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 200)) + rng.normal(size=(400, 1))
    df = spark.createDataFrame(x.tolist(), ", ".join(f"x{i} double" for i in range(200))).repartition(4)
    found = pr.correlation_pairs(df)
    assert executed(found).count("Scan ExistingRDD") == 1
    got = {(r.column1, r.column2): r.correlation for r in found.collect()}
    want = np.corrcoef(x.T)
    assert len(got) == 19_900
    assert all(abs(r - want[int(a[1:]), int(b[1:])]) < 1e-9 for (a, b), r in got.items())


def test_merging_does_not_depend_on_the_cut():
    rng = np.random.default_rng(1)
    x = rng.normal(1e6, 1, size=(500, 4))
    present = rng.random((500, 4)) < 0.6
    whole = batch_moments(x, present)
    parts = [batch_moments(x[a:b], present[a:b]) for a, b in ((0, 3), (3, 120), (120, 500))]
    total = parts[0]
    for part in parts[1:]:
        total = merged(total, part, (total["mean"].T, part["mean"].T))
    for field in whole:
        np.testing.assert_allclose(total[field], whole[field], rtol=1e-8, atol=1e-6)
