"""Connected components by alternating star contraction.

Every round hooks the neighbours of each node to the smallest node they know, once for
larger neighbours and once for smaller ones, until all edges point at the smallest node
of their component. Rounds grow with the logarithm of the component size. Hub nodes may
own a third of all edges: minima are pre-aggregated before the shuffle, and the join
that hands them back is salted.
"""

import logging

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from assay.plans.lineage import cut
from assay.plans.skew import HOT_ROWS, salted_join

log = logging.getLogger(__name__)


def _state(edges: DataFrame) -> Row:
    """Number and fingerprint of the edges: equal before and after a round when nothing moved."""
    return edges.agg(
        F.count(F.lit(1)).alias("edges"),
        F.bit_xor(F.xxhash64("node", "other")).alias("print1"),
        F.bit_xor(F.xxhash64("other", "node")).alias("print2"),
    ).first()


def _lowest(edges: DataFrame) -> DataFrame:
    """Per node: the smallest of itself and its neighbours, and how many edges it has."""
    return edges.groupBy("node").agg(
        F.least("node", F.min("other")).alias("low"), F.count(F.lit(1)).alias("_n")
    )


def _edges(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """One edge (node, other) per row and pair of columns. Without a union, few partitions stay few."""
    return df.select(F.inline(F.array(*[F.struct(F.col(a).alias("node"), F.col(b).alias("other")) for a, b in pairs])))


def _lowered(edges: DataFrame, lowest: DataFrame, crowded: bool, hot_rows: int) -> DataFrame:
    """Each edge (node, other) with ``low``, the lowest neighbour of node."""
    values = lowest.select("node", "low")
    if crowded:
        return salted_join(edges, values, ["node"], ["other"], counts=lowest, hot_rows=hot_rows)
    return edges.join(values, "node")


def connected_components(
    edges: DataFrame, max_rounds: int = 100, hot_rows: int = HOT_ROWS, rows: int | None = None
) -> DataFrame:
    """``(node, component)`` for every node of the edge list ``(src, dst)``; component = least node.

    ``rows``: the number of edges or more, if it is known; few edges are then kept in few files.
    """
    current = cut(
        edges.where("src <> dst")
        .select(F.greatest("src", "dst").alias("node"), F.least("src", "dst").alias("other"))
        .distinct(),
        rows,
    )
    state = _state(current)
    for round_no in range(1, max_rounds + 1):
        # No node can have more edges than there are; below that the joins need no salt.
        crowded = 2 * state["edges"] > hot_rows
        both = _edges(current, ("node", "other"), ("other", "node"))
        larger = _lowered(both.where("other > node"), _lowest(both), crowded, hot_rows)
        larger = _edges(larger, ("other", "low")).distinct()

        smaller = _lowered(larger, _lowest(larger), crowded, hot_rows)
        smaller = _edges(smaller, ("other", "low"), ("node", "low"))
        # Two edges at most come out of one.
        current = cut(smaller.where("node <> other").distinct(), 2 * state["edges"])

        before, state = state, _state(current)
        log.info("components round %d: %d edges", round_no, state["edges"])
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return _edges(current, ("node", "other"), ("other", "other")).withColumnRenamed("other", "component").distinct()
