"""Identity fraud: numbers, cross reference, places, networks."""

import math
import random

import pytest

from assay.operators import identity as idn
from tests.conftest import executed, rows
from tests.test_plans import components_by_hand


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [
            (1, "AB000009C"), (2, "AB000010C"), (3, "AB123456C"), (4, "AB123456C"), (5, None), (6, None),
            (7, "QQ123457C"), (8, "ABxxxxxxC"), (9, "AB000009C"), (10, ""),
        ],
        "id long, nino string",
    )


def test_numbers(df):
    assert rows(idn.invalid_ninos(df).select("id")) == [(5,), (6,), (7,), (8,), (10,)]
    for hot_rows in (1, 100):
        assert rows(idn.shared_ninos(df, hot_rows=hot_rows).select("id")) == [(1,), (3,), (4,), (9,)]
    # Leading zeros count as numbers: 000009 is followed by 000010.
    assert rows(idn.sequential_ninos(df).select("id")) == [(1,), (3,), (4,), (9,)]


def test_flags(df):
    got = rows(idn.nino_fraud_flags(df))
    assert got == sorted(
        [(i, "invalid_format") for i in (5, 6, 7, 8, 10)]
        + [(i, "duplicates") for i in (1, 3, 4, 9)]
        + [(i, "sequential_numbers") for i in (1, 3, 4, 9)]
    )


def test_sequential_numbers_do_not_shuffle_rows(df):
    plan = executed(idn.sequential_ninos(df))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("hot_rows", [1, 100])
def test_cross_reference(spark, hot_rows):
    mine = spark.createDataFrame(
        [(1, "a", 10), (2, "b", 20), (3, "c", 30), (4, "d", None), (5, "e", None), (6, None, 1), (7, "a", 11), (8, "a", 10)],
        "id long, nino string, dept int",
    )
    register = spark.createDataFrame(
        [("a", 10), ("a", 12), ("b", 21), ("b", None), ("d", None), ("d", None), ("e", 5), (None, 1)], "nino string, dept int"
    )
    got = rows(idn.cross_reference(mine, register, "nino", "dept", hot_rows=hot_rows).select("id", "finding"))
    assert got == [(2, "mismatch"), (3, "unknown"), (5, "mismatch"), (7, "mismatch")]


def test_time_patterns(spark):
    df = spark.createDataFrame([("x", "2024"), ("x", "2024"), (None, "2024"), ("y", None)], "nino string, day string")
    assert rows(idn.registration_clusters(df, "day")) == [("2024", 3)]
    assert rows(idn.activity_patterns(df, "nino", "day")) == [("x", "2024", 2)]


def clusters_by_hand(points, eps):
    edges = [
        (a[0], b[0])
        for i, a in enumerate(points)
        for b in points[i + 1 :]
        if math.sqrt((a[1] - b[1]) * (a[1] - b[1]) + (a[2] - b[2]) * (a[2] - b[2])) <= eps
    ]
    label = dict(components_by_hand(edges))
    return sorted((p[0], label.get(p[0], -1)) for p in points)


def check_clusters(spark, points, eps, **options):
    df = spark.createDataFrame(points, "id long, latitude double, longitude double")
    assert rows(idn.geo_clusters(df, eps=eps, **options)) == clusters_by_hand(points, eps)


def test_clusters_edge_cases(spark):
    points = [
        (1, 0.0, 0.0), (2, 0.5, 0.0),  # exactly eps apart
        (3, 5.0, 5.0), (4, 5.4, 5.0), (5, 5.8, 5.0),  # a chain
        (6, -5.0, -5.0), (7, -5.3, -5.3),  # negative, over a cell border
        (8, 20.0, 20.0), (9, 30.0, 30.0), (10, 30.0, 30.0),  # alone, and twice the same place
        (11, 40.0, 40.0), (12, 40.51, 40.0),  # just too far
        (13, 0.0, -60.0), (14, 0.36, -60.36),  # too far over the corner
    ]
    check_clusters(spark, points, 0.5)


@pytest.mark.parametrize("leaf", [0, 3])
def test_clusters_of_dense_cells_are_refined(spark, leaf):
    rng = random.Random(4)
    points = []
    # Two dense clouds with a gap close to eps, and a sparse rest.
    for i in range(60):
        points.append((i, rng.uniform(0, 0.2), rng.uniform(0, 0.2)))
        points.append((100 + i, rng.uniform(0.68, 0.88), rng.uniform(0, 0.2)))
    points += [(300 + i, rng.uniform(0, 6), rng.uniform(0, 6)) for i in range(60)]
    check_clusters(spark, points, 0.5, leaf=leaf, hot_rows=20)


def test_points_without_a_place_are_left_out(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0), (2, None, 1.0), (3, 1.1, 1.0)], "id long, latitude double, longitude double")
    assert rows(idn.geo_clusters(df)) == [(1, 1), (3, 1)]


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_network(spark, hot_rows):
    df = spark.createDataFrame(
        [(5, "n1", "s1", 1), (2, "n1", "s2", 2), (7, None, "s2", 2), (8, "n3", "s2", 3), (9, "n4", None, None), (3, "n5", "s9", 1), (4, "n5", "s8", 1)],
        "id long, nino string, street string, house int",
    )
    got = rows(idn.relationship_network(df, [["nino"], ["street", "house"]], hot_rows=hot_rows))
    assert got == [(2, 2), (3, 3), (4, 3), (5, 2), (7, 2)]


def density_by_hand(points, eps, least):
    near = {
        a[0]: [b[0] for b in points if math.sqrt((a[1] - b[1]) * (a[1] - b[1]) + (a[2] - b[2]) * (a[2] - b[2])) <= eps]
        for a in points
    }
    core = {k for k, found in near.items() if len(found) >= least}
    label = {k: k for k in core} | dict(components_by_hand([(a, b) for a in core for b in near[a] if b in core and a < b]))
    got = []
    for k, found in near.items():
        cluster = label[k] if k in core else min((label[b] for b in found if b in core), default=-1)
        got.append((k, cluster, k in core))
    return sorted(got)


@pytest.mark.parametrize("least", [1, 2, 5, 20])
def test_density_clusters_equal_brute_force(spark, least):
    rng = random.Random(least)
    middles = [(rng.uniform(-4, 4), rng.uniform(-4, 4)) for _ in range(14)]
    points = [(i, rng.gauss(x, 0.2), rng.gauss(y, 0.2)) for i, (x, y) in enumerate(rng.choices(middles, k=500))]
    # A crowd at one place, with points around that only it makes core, and scattered ones.
    points += [(1000 + i, 6.0, 6.0) for i in range(30)]
    points += [(2000 + i, 6 + rng.uniform(-0.6, 0.6), 6 + rng.uniform(-0.6, 0.6)) for i in range(25)]
    points += [(3000 + i, rng.uniform(-9, 9), rng.uniform(-9, 9)) for i in range(60)]
    df = spark.createDataFrame(points + [(9001, None, 1.0), (9002, math.nan, 1.0)], "id long, latitude double, longitude double")
    got = rows(idn.density_clusters(df, eps=0.3, min_samples=least, leaf=8, hot_rows=20 if least == 5 else 1_000_000))
    want = density_by_hand(points, 0.3, least)
    assert got == want
    assert len({c for _, c, _ in want}) > 2
    if least == 2:
        assert rows(idn.geo_clusters(df.where("NOT isnan(latitude)"), eps=0.3)) == [(k, c) for k, c, _ in want]


def test_density_clusters_of_no_rows(spark):
    df = spark.createDataFrame([], "id long, latitude double, longitude double")
    assert idn.density_clusters(df, min_samples=5).count() == 0
