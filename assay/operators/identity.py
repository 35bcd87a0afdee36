"""Identity-fraud detection on identifiers, dates, places and shared attributes."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.functions import predicates as p
from assay.operators.profile import q
from assay.plans.components import connected_components
from assay.plans.lineage import cut
from assay.plans.shape import union_all
from assay.plans.skew import HOT_ROWS, salted_join

# --- identifiers ----------------------------------------------------------------------------


def invalid_ninos(df: DataFrame, nino: str = "nino") -> DataFrame:
    """Rows whose number has the wrong shape or is missing."""
    return df.where(~p.null_fails(p.is_nino(q(nino))))


def shared_ninos(df: DataFrame, nino: str = "nino", key: str = "id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """All rows that share their (non-null) number with another row."""
    present = df.where(q(nino).isNotNull())
    groups = present.groupBy(nino).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return salted_join(
        present, groups.select(nino), [nino], [key], "left_semi", counts=groups, hot_rows=hot_rows
    )


def _digits(nino: str) -> Column:
    """The six digits as a number; null if they are none."""
    middle = F.substring(q(nino), 3, 6)
    return F.when(middle.rlike(r"^[0-9]{6}\z"), middle.try_cast("int"))


def sequential_ninos(df: DataFrame, nino: str = "nino") -> DataFrame:
    """Rows whose six digits plus one occur on some row.

    Six digits give at most one million distinct numbers, whatever the table size, so the
    set of predecessors is small enough to broadcast and the rows are not shuffled.
    """
    predecessors = (
        df.select((_digits(nino) - 1).alias("_number")).where("_number IS NOT NULL").distinct()
    )
    return df.withColumn("_number", _digits(nino)).join(F.broadcast(predecessors), "_number", "left_semi").drop("_number")


def nino_fraud_flags(df: DataFrame, nino: str = "nino", key: str = "id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(key, pattern)``: one row per record and suspicious pattern.

    The table is read once for the counts per number, which also give the set of
    predecessors, and once to mark its rows.
    """
    slim = df.select(key, nino)
    counts = slim.groupBy(nino).agg(F.count(F.lit(1)).alias("_n"))
    shared = counts.where((F.col("_n") > 1) & q(nino).isNotNull()).select(nino, F.lit(True).alias("_shared"))
    predecessors = (
        counts.select((_digits(nino) - 1).alias("_number"))
        .where("_number IS NOT NULL")
        .distinct()
        .withColumn("_sequential", F.lit(True))
    )
    marked = salted_join(
        slim.withColumn("_number", _digits(nino)), shared, [nino], [key], "left", counts=counts, hot_rows=hot_rows
    ).join(F.broadcast(predecessors), "_number", "left")
    patterns = F.array_compact(
        F.array(
            F.when(~p.null_fails(p.is_nino(q(nino))), "invalid_format"),
            F.when(F.col("_shared"), "duplicates"),
            F.when(F.col("_sequential"), "sequential_numbers"),
        )
    )
    return marked.select(key, F.explode(patterns).alias("pattern"))


def cross_reference(
    df: DataFrame,
    external: DataFrame,
    on: str,
    attribute: str,
    key: str = "id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``(key, on, finding)`` for records the external source does not confirm.

    ``unknown`` if the identifier does not occur there, ``mismatch`` if it does but never with
    the same attribute (null equals null). Both sides are first combined to distinct pairs of
    identifier and attribute, so a repeated pair is one row; only the unconfirmed pairs then
    meet the records again.
    """
    mine = df.select(key, on, attribute).where(q(on).isNotNull())
    theirs = external.select(on, attribute).where(q(on).isNotNull())
    pairs = (
        mine.select(on, attribute, F.lit(1).alias("_mine"), F.lit(0).alias("_theirs"))
        .unionByName(theirs.select(on, attribute, F.lit(0).alias("_mine"), F.lit(1).alias("_theirs")))
        .groupBy(on, attribute)
        .agg(F.sum("_mine").alias("_n"), F.max("_theirs").alias("_theirs"))
    )
    unconfirmed = pairs.where("_n > 0 AND _theirs = 0")
    known = pairs.groupBy(on).agg(F.max("_theirs").alias("_known")).where("_known = 1")
    judged = salted_join(
        unconfirmed.select(on, attribute), known, [on], [attribute], "left", hot_rows=hot_rows
    ).select(on, attribute, F.when(F.col("_known") == 1, "mismatch").otherwise("unknown").alias("finding"))
    return salted_join(
        mine, judged, [on, attribute], [key], null_safe=True, counts=unconfirmed, hot_rows=hot_rows
    ).select(key, on, "finding")


# --- time -----------------------------------------------------------------------------------


def registration_clusters(df: DataFrame, date: str = "registration_date") -> DataFrame:
    """Rows per registration date; rows without a date are left out."""
    return df.where(q(date).isNotNull()).groupBy(date).agg(F.count(F.lit(1)).alias("registrations"))


def activity_patterns(df: DataFrame, identity: str = "nino", date: str = "activity_date") -> DataFrame:
    """Rows per identity and activity date; rows lacking either are left out."""
    return (
        df.where(q(identity).isNotNull() & q(date).isNotNull())
        .groupBy(identity, date)
        .agg(F.count(F.lit(1)).alias("activities"))
    )


# --- places ---------------------------------------------------------------------------------

REACH = 2  # cells to each side that can hold a point within eps
LEAF = 32  # cells with at most this many places are compared place by place


def _far(low_a: Column, high_a: Column, low_b: Column, high_b: Column) -> Column:
    return F.greatest(F.abs(high_a - low_b), F.abs(high_b - low_a))


def _near(low_a: Column, high_a: Column, low_b: Column, high_b: Column) -> Column:
    return F.greatest(F.lit(0.0), low_b - high_a, low_a - high_b)


def _length(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def _cells(places: DataFrame, side: float, names: tuple[str, str]) -> DataFrame:
    """Occupied cells of the grid with their number of places and tight bounding box."""
    return places.groupBy(
        F.floor(F.col("x") / side).alias(names[0]), F.floor(F.col("y") / side).alias(names[1])
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("x").alias("x0"),
        F.max("x").alias("x1"),
        F.min("y").alias("y0"),
        F.max("y").alias("y1"),
    )


BOX = ["n", "x0", "x1", "y0", "y1"]


def _end(df: DataFrame, end: str, names: tuple[str, str], keep: list[str]) -> DataFrame:
    """Columns of one end of a pair, prefixed with its letter."""
    return df.select(*[F.col(c).alias(f"{end}_{c}") for c in [*names, *keep]])


def _judged(pairs: DataFrame, eps: float) -> DataFrame:
    """Adds the verdict on each pair of boxes: near, far or open."""
    a = [F.col(f"a_{c}") for c in BOX]
    b = [F.col(f"b_{c}") for c in BOX]
    far = _length(_far(a[1], a[2], b[1], b[2]), _far(a[3], a[4], b[3], b[4]))
    near = _length(_near(a[1], a[2], b[1], b[2]), _near(a[3], a[4], b[3], b[4]))
    return pairs.withColumn(
        "verdict", F.when(far <= eps, "near").when(near > eps, "far").otherwise("open")
    )


def linked_cells(places: DataFrame, eps: float, side: float, leaf: int = LEAF) -> DataFrame:
    """Pairs of neighbouring cells that hold two places within ``eps``: ``(a_i, a_j, b_i, b_j)``.

    Two dense cells are never compared place by place. Their bounding boxes settle most
    pairs; undecided pairs with few places on both ends are compared directly, at most
    ``leaf`` to ``leaf``; all others are cut into quarters, and the quarters are judged in the
    next round. A cell pair leaves the search as soon as one of its quarters is near.
    """
    root = ("i", "j")
    cells = cut(_cells(places, side, root))
    offsets = [
        (di, dj) for di in range(0, REACH + 1) for dj in range(-REACH, REACH + 1) if di > 0 or dj > 0
    ]
    neighbours = F.array(
        *[
            F.struct((F.col("a_i") + di).alias("b_i"), (F.col("a_j") + dj).alias("b_j"))
            for di, dj in offsets
        ]
    )
    ends = ["a_i", "a_j", "b_i", "b_j"]
    found = cut(
        _judged(
            _end(cells, "a", root, BOX)
            .select("*", F.inline(neighbours))
            .join(_end(cells, "b", root, BOX), ["b_i", "b_j"]),
            eps,
        )
    )
    links = [found.where("verdict = 'near'").select(*ends)]
    # ``u``/``v`` number the cells of the current level, ``a_i`` to ``b_j`` stay the cells of level 0.
    open_pairs = found.where("verdict = 'open'").select(
        *ends,
        F.col("a_i").alias("a_u"), F.col("a_j").alias("a_v"), F.col("b_i").alias("b_u"), F.col("b_j").alias("b_v"),
        "a_n", "b_n",
    )
    level_side = side
    while True:
        small = (F.col("a_n") <= leaf) & (F.col("b_n") <= leaf)
        links.append(_compared(places, open_pairs.where(small), eps, level_side, ends))
        deeper = open_pairs.where(~small)
        if deeper.isEmpty():
            break
        inside = _inside(places, deeper, level_side).select("x", "y")
        level_side /= 2
        # Halving is exact in binary, so quarters never straddle the border of their parent.
        quarters = _cells(inside, level_side, ("cu", "cv")).withColumns(
            {"u": F.floor(F.col("cu") / 2), "v": F.floor(F.col("cv") / 2)}
        )
        judged = cut(
            _judged(
                deeper.drop("a_n", "b_n")
                .join(_end(quarters, "a", ("u", "v"), ["cu", "cv", *BOX]), ["a_u", "a_v"])
                .join(_end(quarters, "b", ("u", "v"), ["cu", "cv", *BOX]), ["b_u", "b_v"]),
                eps,
            )
        )
        near = judged.where("verdict = 'near'").select(*ends).distinct()
        links.append(near)
        open_pairs = (
            judged.where("verdict = 'open'")
            .join(near, ends, "left_anti")
            .select(
                *ends,
                F.col("a_cu").alias("a_u"), F.col("a_cv").alias("a_v"),
                F.col("b_cu").alias("b_u"), F.col("b_cv").alias("b_v"),
                "a_n", "b_n",
            )
        )
    return union_all(links).distinct()


def _both_ends(u: str, v: str) -> Column:
    return F.array(
        *[F.struct(F.col(f"{e}_{u}").alias(u), F.col(f"{e}_{v}").alias(v)) for e in ("a", "b")]
    )


def _inside(places: DataFrame, pairs: DataFrame, side: float) -> DataFrame:
    """Places in cells ``(u, v)`` that occur in ``pairs``; crowded cells are spread while looking up."""
    wanted = pairs.select(F.inline(_both_ends("u", "v"))).distinct()
    located = places.withColumns({"u": F.floor(F.col("x") / side), "v": F.floor(F.col("y") / side)})
    return salted_join(located, wanted, ["u", "v"], ["x", "y"], "left_semi")


def _compared(places: DataFrame, pairs: DataFrame, eps: float, side: float, ends: list[str]) -> DataFrame:
    """Cell pairs with few places on both ends, settled place by place."""
    located = _inside(places, pairs, side)

    def end(e: str) -> DataFrame:
        return located.select(*[F.col(c).alias(f"{e}_{c}") for c in located.columns])

    distance = _length(F.col("a_x") - F.col("b_x"), F.col("a_y") - F.col("b_y"))
    return (
        pairs.join(end("a"), ["a_u", "a_v"])
        .join(end("b"), ["b_u", "b_v"])
        .where(distance <= eps)
        .select(*ends)
        .distinct()
    )


def geo_clusters(
    df: DataFrame,
    key: str = "id",
    latitude: str = "latitude",
    longitude: str = "longitude",
    eps: float = 0.3,
    leaf: int = LEAF,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``(key, cluster)``: density clusters with at least two points, -1 for noise.

    With two points a cluster is a connected component of points within ``eps`` (Euclidean
    distance in degrees). Cells have a diagonal just below ``eps``, so all points of a cell
    belong together, and the graph has cells as nodes: a cell with a third of all points is
    one node, and equal coordinates are merged before anything else. The label is the
    smallest key of the cluster.
    """
    side = eps / math.sqrt(2) * (1 - 1e-9)
    points = df.select(
        F.col(key).alias("key"), q(latitude).cast("double").alias("x"), q(longitude).cast("double").alias("y")
    ).where("x IS NOT NULL AND y IS NOT NULL")
    i, j = F.floor(F.col("x") / side), F.floor(F.col("y") / side)
    places = cut(points.groupBy("x", "y").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("points")))
    # Cells are numbered by their smallest key: unique, because each key lies in one cell.
    cells = cut(
        places.select("*", i.alias("i"), j.alias("j"))
        .groupBy("i", "j")
        .agg(F.min("key").alias("cell"), F.sum("points").alias("points"))
    )
    number = cells.select("i", "j", "cell")

    def numbered(e: str) -> DataFrame:
        return number.select(*[F.col(c).alias(f"{e}_{c}") for c in number.columns])

    edges = (
        linked_cells(places.select("x", "y"), eps, side, leaf)
        .join(numbered("a"), ["a_i", "a_j"])
        .join(numbered("b"), ["b_i", "b_j"])
        .select(F.col("a_cell").alias("src"), F.col("b_cell").alias("dst"))
    )
    components = connected_components(edges, hot_rows=hot_rows).withColumnRenamed("node", "cell")
    labels = cells.join(components, "cell", "left").select(
        "i",
        "j",
        F.coalesce("component", F.when(F.col("points") > 1, F.col("cell")), F.lit(-1)).alias("cluster"),
    )
    located = points.select("key", i.alias("i"), j.alias("j"))
    return salted_join(located, labels, ["i", "j"], ["key"], hot_rows=hot_rows).select(
        F.col("key").alias(key), "cluster"
    )


def _beside(sparse: DataFrame, places: DataFrame, eps: float, keep: list[str], hot_rows: int) -> DataFrame:
    """Pairs of a place of ``sparse`` and one of ``places`` in a cell beside its own, within ``eps``.

    ``(key, keep...)`` with the key of the sparse place. Crowded cells are spread; what is copied for that are
    the few sparse places around them.
    """
    offsets = [(di, dj) for di in range(-REACH, REACH + 1) for dj in range(-REACH, REACH + 1) if di or dj]
    around = F.array(*[F.struct((F.col("i") + di).alias("n_i"), (F.col("j") + dj).alias("n_j")) for di, dj in offsets])
    asked = sparse.select(F.col("key").alias("s_key"), F.col("x").alias("s_x"), F.col("y").alias("s_y"), F.inline(around))
    asked = asked.withColumnsRenamed({"n_i": "i", "n_j": "j"})
    met = salted_join(places, asked, ["i", "j"], ["x", "y"], "inner", hot_rows=hot_rows)
    distance = _length(F.col("x") - F.col("s_x"), F.col("y") - F.col("s_y"))
    return met.where(distance <= eps).select(F.col("s_key").alias("key"), *keep)


def density_clusters(
    df: DataFrame,
    key: str = "id",
    latitude: str = "latitude",
    longitude: str = "longitude",
    eps: float = 0.3,
    min_samples: int = 2,
    leaf: int = LEAF,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``(key, cluster, core)``: density clusters for any ``min_samples``; cluster -1 is noise.

    A point is core if at least ``min_samples`` points, itself included, lie within ``eps`` of it. Core points
    within ``eps`` of each other share a cluster, named by its smallest core key; another point
    within ``eps`` of a core point belongs to the cluster of the smallest name among those it reaches.
    Rows without both coordinates (NULL or NaN) are left out.

    All points of a grid cell are within ``eps``, so in a cell of ``min_samples`` points all are core.
    Only places in cells with fewer are compared with the cells around, at most ``min_samples - 1`` per
    cell, so work grows with rows times ``min_samples``, however crowded a cell is.
    """
    side = eps / math.sqrt(2) * (1 - 1e-9)
    points = df.select(
        F.col(key).alias("key"), q(latitude).cast("double").alias("x"), q(longitude).cast("double").alias("y")
    ).where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    places = points.groupBy("x", "y").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("points"))
    places = cut(places.withColumns({"i": F.floor(F.col("x") / side), "j": F.floor(F.col("y") / side)}))
    held = places.groupBy("i", "j").agg(F.sum("points").alias("held"))
    sparse = places.join(held.where(F.col("held") < min_samples), ["i", "j"])
    beside = _beside(sparse, places, eps, ["points"], hot_rows).groupBy("key").agg(F.sum("points").alias("beside"))
    reached = F.col("held") + F.coalesce("beside", F.lit(0))
    judged = cut(sparse.join(beside, "key", "left").withColumn("core", reached >= min_samples).drop("held", "beside"))
    dense = salted_join(places, held.where(F.col("held") >= min_samples).drop("held"), ["i", "j"], ["x", "y"], "left_semi", hot_rows=hot_rows)
    core = cut(dense.unionByName(judged.where("core").drop("core")))
    cells = cut(core.groupBy("i", "j").agg(F.min("key").alias("cell")))

    def numbered(e: str) -> DataFrame:
        return cells.select(*[F.col(c).alias(f"{e}_{c}") for c in cells.columns])

    edges = (
        linked_cells(core.select("x", "y"), eps, side, leaf)
        .join(numbered("a"), ["a_i", "a_j"])
        .join(numbered("b"), ["b_i", "b_j"])
        .select(F.col("a_cell").alias("src"), F.col("b_cell").alias("dst"))
    )
    components = connected_components(edges, hot_rows=hot_rows).withColumnRenamed("node", "cell")
    labels = cells.join(components, "cell", "left").select("i", "j", F.coalesce("component", "cell").alias("cluster"))
    labelled = cut(salted_join(core, labels, ["i", "j"], ["x", "y"], "inner", hot_rows=hot_rows))
    others = judged.where("NOT core")
    # A border place may share its cell with core places, or reach them in the cells around.
    own = others.join(labels, ["i", "j"]).select("key", "cluster")
    border = own.unionByName(_beside(others, labelled, eps, ["cluster"], hot_rows)).groupBy("key").agg(F.min("cluster").alias("cluster"))
    rest = others.join(border, "key", "left").select(
        "x", "y", F.coalesce("cluster", F.lit(-1)).alias("cluster"), F.lit(False).alias("core")
    )
    known = labelled.select("x", "y", "cluster", F.lit(True).alias("core")).unionByName(rest)
    return salted_join(points, known, ["x", "y"], ["key"], "inner", hot_rows=hot_rows).select(
        F.col("key").alias(key), "cluster", "core"
    )


# --- networks -------------------------------------------------------------------------------


def relationship_network(
    df: DataFrame, attributes: list[list[str]], key: str = "id", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``(key, network)`` for records linked through equal attributes, directly or in a chain.

    ``attributes`` lists groups of columns that must all be equal and non-null. Each shared
    value links its records to the smallest key among them: one edge per record and value
    instead of all pairs.
    """
    edges = []
    for columns in attributes:
        present = df.select(F.col(key).alias("key"), *columns)
        for c in columns:
            present = present.where(q(c).isNotNull())
        hubs = (
            present.groupBy(*columns)
            .agg(F.min("key").alias("hub"), F.count(F.lit(1)).alias("_n"))
            .where("_n > 1")
        )
        linked = salted_join(present, hubs.drop("_n"), columns, ["key"], counts=hubs, hot_rows=hot_rows)
        edges.append(linked.select(F.col("key").alias("src"), F.col("hub").alias("dst")))
    return connected_components(union_all(edges), hot_rows=hot_rows).select(
        F.col("node").alias(key), F.col("component").alias("network")
    )
