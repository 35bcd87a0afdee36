"""Plan shapes: salted joins, components, the exact median."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from assay.functions.statistics import exact_medians, pearson
from assay.plans.components import connected_components
from assay.plans.lineage import cut, fresh_dir, shared_dir
from assay.plans.shape import one_scan
from assay.plans.skew import salted_join
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """60 rows, a third of them under key 7, some without a key."""
    data = [(i, 7 if i % 3 == 0 else (None if i % 10 == 1 else i % 8)) for i in range(60)]
    return spark.createDataFrame(data, "id long, k long")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [3, 1000])
def test_salted_join_equals_plain_join(spark, skewed, how, hot_rows):
    right = spark.createDataFrame([(7, "a"), (2, "b"), (None, "c"), (99, "d")], "k long, v string")
    salted = salted_join(skewed, right, ["k"], ["id"], how, hot_rows=hot_rows)
    plain = skewed.join(right, "k", how)
    assert rows(salted.select(*plain.columns)) == rows(plain)


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_salted_join_null_safe(spark, skewed, how):
    right = spark.createDataFrame([(7,), (None,)], "k long")
    got = salted_join(skewed, right, ["k"], ["id"], how, null_safe=True, hot_rows=3)
    keep = {7, None}
    expected = [r for r in rows(skewed) if (r[1] in keep) == (how == "left_semi")]
    assert rows(got.select("id", "k")) == expected


def test_salted_join_null_safe_inner_keeps_right_columns(spark, skewed):
    right = spark.createDataFrame([(7, "a"), (None, "n")], "k long, v string")
    got = salted_join(skewed, right, ["k"], ["id"], null_safe=True, hot_rows=3)
    expected = [(i, k, "a" if k == 7 else "n") for i, k in rows(skewed) if k in (7, None)]
    assert rows(got.select("id", "k", "v")) == sorted(expected, key=lambda r: [(x is not None, x) for x in r])


def test_salted_join_spreads_the_hot_key(spark):
    left = spark.range(0, 4000).withColumn("k", F.lit(1))
    right = spark.createDataFrame([(1, "a")], "k int, v string")
    joined = salted_join(left, right, ["k"], ["id"], hot_rows=100)
    assert joined.count() == 4000
    spread = left.withColumn("s", F.pmod(F.xxhash64("id"), F.lit(40))).groupBy("s").count()
    assert spread.agg(F.max("count")).first()[0] < 200


def test_salted_join_refuses_unequal_types(spark, skewed):
    right = spark.createDataFrame([(7,)], "k int")
    with pytest.raises(ValueError, match="bigint on the left, int on the right"):
        salted_join(skewed, right, ["k"], ["id"])
    with pytest.raises(ValueError, match="unsupported"):
        salted_join(skewed, skewed, ["k"], ["id"], "full")


def components_by_hand(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return sorted((x, find(x)) for x in parent)


@pytest.mark.parametrize("hot_rows", [5, 1_000_000])
def test_components(spark, hot_rows):
    rng = random.Random(5)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(45)]  # random
    edges += [(1000 + i, 1001 + i) for i in range(40)]  # chain
    edges += [(2000, 2001 + i) for i in range(60)]  # hub
    edges += [(3005, 3001), (3001, 3005)]  # both directions
    edges = [(a, b) for a, b in edges if a != b]
    got = connected_components(spark.createDataFrame(edges, "src long, dst long"), hot_rows=hot_rows)
    assert rows(got.select("node", "component")) == components_by_hand(edges)


def test_components_of_no_edges(spark):
    empty = spark.createDataFrame([], "src long, dst long")
    assert connected_components(empty).count() == 0


@pytest.mark.parametrize("bins", [8, 64, 4096])
def test_exact_medians(spark, bins):
    rng = random.Random(2)
    columns = {
        "even": [rng.uniform(-5, 5) for _ in range(200)],
        "odd": [float(rng.randrange(1000)) for _ in range(199)] + [None],
        "hot": [3.0] * 150 + [rng.gauss(0, 100) for _ in range(50)],
        "far": [1e300, -1e300, 0.5, 0.25] + [rng.random() for _ in range(196)],
        "ends": [float("inf")] * 3 + [float("-inf")] * 3 + [float(i) for i in range(194)],
        "none": [None] * 200,
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    got = exact_medians(df, list(columns), bins=bins)
    for name, values in columns.items():
        values = [x for x in values if x is not None]
        assert got[name] == (statistics.median(values) if values else None), name


@pytest.mark.parametrize("bins", [8, 40])
def test_exact_medians_over_many_passes(spark, monkeypatch, bins):
    # A coarse sketch and few values brought back stand for a table of very many rows.
    monkeypatch.setattr("assay.functions.statistics.SKETCH", 50)
    monkeypatch.setattr("assay.functions.statistics.KEEP", 5)
    rng = random.Random(3)
    columns = {
        "normal": [rng.gauss(0, 1) for _ in range(4000)],
        "tail": [rng.lognormvariate(0, 8) for _ in range(3999)] + [None],
        "steps": [float(rng.randrange(40)) for _ in range(4000)],
        "halves": [1.0] * 2000 + [2.0] * 2000,
        "one": [7.0] + [None] * 3999,
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(5)
    got = exact_medians(df, list(columns), bins)
    assert got == {c: statistics.median([x for x in xs if x is not None]) for c, xs in columns.items()}


def test_pearson_of_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5), (2.0, 4.5, 5), (3.0, None, 5)], "a double, b double, c int")
    row = df.selectExpr(f"{pearson('a', 'c')} AS ac", f"{pearson('a', 'b')} AS ab").first()
    assert row["ac"] is None
    assert row["ab"] == pytest.approx(1.0)


def test_one_scan_chunks(spark):
    df = spark.range(10)
    measures = [
        (F.sum(F.col("id") + i), lambda s, i=i: {"i": str(i), "n": "_total", "s": s})
        for i in range(5)
    ]
    frames = one_scan(df, measures, per_pass=2)
    assert len(frames) == 3
    assert [tuple(r) for f in frames for r in f.collect()] == [(i, 10, 45 + 10 * i) for i in range(5)]


def test_shared_folder_and_cut(spark):
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")
    assert fresh_dir(spark, "x").startswith(shared_dir(spark))
    kept = cut(spark.range(5).withColumn("y", F.col("id") * 2))
    assert rows(kept) == [(i, 2 * i) for i in range(5)]
    assert "Scan ExistingRDD" in kept._jdf.queryExecution().executedPlan().toString()


def test_medians_ignore_nan_and_bear_infinities(spark):
    rows = [(float(x),) for x in ("nan", "inf", "-inf", "1", "2", "1e300", "nan")]
    assert exact_medians(spark.createDataFrame(rows, "x double"), ["x"]) == {"x": 2.0}
    assert exact_medians(spark.createDataFrame([(float("nan"),)], "x double"), ["x"]) == {"x": None}
