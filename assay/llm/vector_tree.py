"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first search.

Largest inner product becomes smallest distance by one more coordinate: with m the largest norm,
x is lengthened by sqrt(m^2 - |x|^2) and a query by 0. The tree is fitted on a bounded sample;
every row is then put into a leaf. A query walks the tree by a priority queue, nearest branch
first, and so ranks the leaves. How many leaves it visits is calibrated: some queries are compared
with all rows, and visits are widened until the wanted recall is reached.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assay.llm.common import saved, table

BLOCK = 2048


@dataclass
class Node:
    center: np.ndarray
    children: list["Node"] = field(default_factory=list)
    leaf: int = -1


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centres; the first ones are far from each other, and none is empty."""
    centers = [x.mean(axis=0)]
    distance = np.full(len(x), np.inf)
    for _ in range(k):
        distance = np.minimum(distance, ((x - centers[-1]) ** 2).sum(axis=1)) if len(centers) > 1 else ((x - centers[0]) ** 2).sum(axis=1)
        if distance.max() <= 1e-12:
            break
        centers.append(x[int(distance.argmax())])
    centers = np.array(centers[1:] or centers)
    for _ in range(rounds):
        home = (((centers**2).sum(axis=1)) - 2 * x @ centers.T).argmin(axis=1)
        used = np.unique(home)
        moved = np.array([x[home == i].mean(axis=0) for i in used])
        if moved.shape == centers.shape and np.allclose(moved, centers):
            break
        centers = moved
    return centers


class Tree:
    """A tree over sample vectors; ``branch`` children per node, leaves of at most ``leaf_size``."""

    def __init__(self, sample: np.ndarray, branch: int = 8, leaf_size: int = 64):
        self.branch, self.leaf_size = branch, leaf_size
        self.leaves: list[Node] = []
        self.root = self._grow(sample)

    def _grow(self, x: np.ndarray) -> Node:
        node = Node(x.mean(axis=0))
        centers = k_means(x, self.branch) if len(x) > self.leaf_size else []
        if len(centers) > 1:
            home = (((centers**2).sum(axis=1)) - 2 * x @ centers.T).argmin(axis=1)
            parts = [x[home == i] for i in np.unique(home)]
            if len(parts) > 1:
                node.children = [self._grow(part) for part in parts]
                return node
        node.leaf = len(self.leaves)
        self.leaves.append(node)
        return node

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child at every level."""
        out = np.zeros(len(x), dtype=np.int32)
        waiting = [(self.root, np.arange(len(x)))]
        while waiting:
            node, rows = waiting.pop()
            if not node.children:
                out[rows] = node.leaf
                continue
            centers = np.array([c.center for c in node.children])
            home = (((centers**2).sum(axis=1)) - 2 * x[rows] @ centers.T).argmin(axis=1)
            waiting += [(c, rows[home == i]) for i, c in enumerate(node.children) if (home == i).any()]
        return out

    def visits(self, query: np.ndarray, least: int, rows: dict[int, int] | None = None, wanted: int = 0) -> list[int]:
        """The first ``least`` leaves, best bin first, and on until their ``rows`` are ``wanted``."""
        queue, found, count, held = [(0.0, 0, self.root)], [], 0, 0
        while queue and (len(found) < least or held < wanted):
            _, _, node = heapq.heappop(queue)
            if not node.children:
                found.append(node.leaf)
                held += rows.get(node.leaf, 0) if rows else 0
            for child in node.children:
                count += 1
                heapq.heappush(queue, (float(((child.center - query) ** 2).sum()), count, child))
        return found


def usable(embedding: str) -> Column:
    """Vectors without null or non-finite components that are not zero."""
    v = F.col(embedding)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _lengthened(x: np.ndarray, largest: float) -> np.ndarray:
    last = np.sqrt(np.maximum(largest**2 - (x**2).sum(axis=1), 0))
    return np.column_stack([x, last])


def _best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of each query's k best scores, ties to the smaller id, in order."""
    order = np.lexsort((vec, -score, query))
    q = query[order]
    start = np.concatenate([[0], np.flatnonzero(q[1:] != q[:-1]) + 1]) if len(q) else np.array([], dtype=int)
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.concatenate([start, [len(q)]])))
    return order[rank < k]


def _top(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int):
    """Each query's k best vectors of this block (others than itself): query rows, vector rows, scores."""
    scores = queries @ vectors.T
    scores[query_ids[:, None] == ids[None, :]] = -np.inf
    if scores.shape[1] > k:
        # Everything that ties with the k-th best stays until ids decide.
        bar = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        rows, columns = np.nonzero((scores >= bar) & np.isfinite(scores))
    else:
        rows, columns = np.nonzero(np.isfinite(scores))
    found = scores[rows, columns]
    kept = _best(rows, ids[columns], found, k)
    return rows[kept], columns[kept], found[kept]


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    recall: float = 0.98,
    sample_rows: int = 16_384,
    calibration: int = 256,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of ``vectors(vec_id, embedding)`` per query.

    ``queries`` says which rows are queries; a query is no candidate of its own. Scores are inner
    products of the original vectors in double precision; ties go to the smaller vec_id. Vectors
    null, zero, or with null or non-finite components take no part, nor do rows without vec_id or
    with another length than most vectors. Repeated rows count once. The tree is fitted on at most
    ``sample_rows`` rows, visits are calibrated with at most ``calibration`` queries against all rows.
    """
    spark = vectors.sparkSession
    clean = vectors.where(usable("embedding") & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("v"),
        F.coalesce(queries, F.lit(False)).alias("is_query"),
    )
    clean = clean.dropDuplicates(["vec_id"])
    sizes = clean.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    clean = saved(clean.where(F.size("v") == sizes["n"]), "vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    largest = clean.agg(F.max(norm)).first()[0]
    by_hash = clean.orderBy(F.xxhash64("vec_id"), "vec_id")
    sample = np.array([r.v for r in by_hash.limit(sample_rows).select("v").collect()])
    # Its size is bounded by the sample's.
    tree = Tree(_lengthened(sample, largest))

    def with_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _lengthened(_matrix(batch.column("v")), largest) if len(batch) else np.zeros((0, 1))
            leaf = pa.array(tree.assign(x) if len(batch) else np.zeros(0, np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, leaf], names=[*batch.schema.names, "leaf"])

    indexed = saved(
        clean.mapInArrow(with_leaf, "vec_id long, v array<double>, is_query boolean, leaf int"), "indexed"
    )
    trial = by_hash.where("is_query").limit(calibration).select("vec_id", "v").collect()
    if not trial:
        return spark.createDataFrame([], schema)
    visits = _calibrated(indexed, tree, trial, k, recall)
    return _searched(indexed, tree, k, visits)


def _calibrated(indexed: DataFrame, tree: Tree, trial: list, k: int, recall: float) -> int:
    """The fewest leaf visits with which the trial queries find ``recall`` of their true neighbours."""
    spark = indexed.sparkSession
    asked = spark.sparkContext.broadcast(
        (np.array([r.vec_id for r in trial]), np.array([r.v for r in trial], dtype=np.float64))
    )

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = asked.value
        for batch in batches:
            for start in range(0, len(batch), BLOCK):
                part = batch.slice(start, BLOCK)
                found = part.column("vec_id").to_numpy()
                rows, columns, scores = _top(_matrix(part.column("v")), found, q, ids, k)
                leaf = part.column("leaf").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[rows]), pa.array(found[columns]), pa.array(leaf[columns]), pa.array(scores)],
                    names=["query_id", "vec_id", "leaf", "score"],
                )

    near = indexed.mapInArrow(exact, "query_id long, vec_id long, leaf int, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    truth = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "leaf").collect()
    position = {}
    for r in trial:
        q = np.append(np.array(r.v), 0.0)
        position[r.vec_id] = {leaf: i + 1 for i, leaf in enumerate(tree.visits(q, len(tree.leaves)))}
    needed = np.sort([position[r.query_id][r.leaf] for r in truth])
    if not len(needed):
        return 1
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)])


def _searched(indexed: DataFrame, tree: Tree, k: int, visits: int) -> DataFrame:
    """The k best of the visited leaves. Leaves and their queries meet in blocks of bounded size.

    A query whose first leaves are small goes on until they hold k rows besides itself.
    """
    # Bounded by the number of leaves: rows and queries of each leaf.
    rows = {r.leaf: r["count"] for r in indexed.groupBy("leaf").count().collect()}

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = [tree.visits(np.append(q, 0.0), visits, rows, k + 1) for q in (_matrix(batch.column("v")) if len(batch) else [])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(leaves, pa.list_(pa.int32()))],
                names=["vec_id", "v", "leaves"],
            )

    asked = indexed.where("is_query").select("vec_id", "v").mapInArrow(
        ranked, "vec_id long, v array<double>, leaves array<int>"
    )
    asked = asked.select("vec_id", "v", F.explode("leaves").alias("leaf"))

    calls = {r.leaf: r["count"] for r in asked.groupBy("leaf").count().collect()}
    blocks = [
        (leaf, max(1, -(-rows.get(leaf, 0) // BLOCK)), max(1, -(-n // BLOCK))) for leaf, n in calls.items() if leaf in rows
    ]
    plan = F.broadcast(indexed.sparkSession.createDataFrame(blocks, "leaf int, vector_blocks int, query_blocks int"))

    def block(n: str) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    held = indexed.join(plan, "leaf").withColumn("i", block("vector_blocks")).withColumn("j", every("query_blocks"))
    sought = asked.join(plan, "leaf").withColumn("j", block("query_blocks")).withColumn("i", every("vector_blocks"))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"}
            )
        ids, query_ids = left.vec_id.to_numpy(), right.vec_id.to_numpy()
        r, c, s = _top(np.stack(left.v.to_numpy()), ids, np.stack(right.v.to_numpy()), query_ids, k)
        return pd.DataFrame({"query_id": query_ids[r], "vec_id": ids[c], "score": s})

    cells = held.select("leaf", "i", "j", "vec_id", "v").groupBy("leaf", "i", "j")
    met = cells.cogroup(sought.select("leaf", "i", "j", "vec_id", "v").groupBy("leaf", "i", "j")).applyInPandas(
        meet, "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranks = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranks.select("query_id", "rank", "vec_id", "score")


def op8_vector_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {"op8_vector_tree": op8_vector_tree}
