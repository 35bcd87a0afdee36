"""Correlations of all pairs of many columns in one scan.

A task adds up, for each pair of columns, the moments of the rows in which both are present: their
number, both means, both sums of squared deviations and the sum of products. With k columns these are
k x k matrices, products of the value and presence matrices of an Arrow batch. Moments of batches and
tasks are merged by the pairwise update of means and deviations, which doesn't cancel digits.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.plans.shape import name

#: Moments of a pair whose deviations are this small beside the centred squares are computed anew, in two steps.
CANCELLED = 1e-6
FIELDS = ["n", "mean", "squares", "products", "broken"]
SCHEMA = "i int, task int, " + ", ".join(f"{f} array<double>" for f in FIELDS)

#: Per pair (i, j): rows, mean and squared deviations of i, products of deviations, rows with a value that isn't finite.
Moments = dict[str, np.ndarray]


def batch_moments(x: np.ndarray, present: np.ndarray) -> Moments:
    """Moments of all pairs of the columns of ``x`` (rows by columns)."""
    finite = np.isfinite(x) & present
    broken = (present & ~finite).astype(np.float64)
    low, high = np.where(finite, x, np.inf).min(axis=0), np.where(finite, x, -np.inf).max(axis=0)
    rows = finite.sum(axis=0)
    middle = np.where(finite, x, 0.0).sum(axis=0) / np.maximum(rows, 1)
    # A constant column is centred by its value, so that its deviations are exactly zero.
    centre = np.where(low == high, low, np.where(rows > 0, middle, 0.0))
    y = np.where(finite, x - centre, 0.0)
    m = finite.astype(np.float64)
    n = m.T @ m
    safe = np.maximum(n, 1)
    sums, raw = y.T @ m, (y * y).T @ m
    squares = raw - sums * sums / safe
    products = y.T @ y - sums * sums.T / safe
    mean = centre[:, None] + sums / safe
    cancelled = (squares <= CANCELLED * raw) & (raw > 0)
    for i, j in zip(*np.nonzero(cancelled | cancelled.T), strict=True):
        both = finite[:, i] & finite[:, j]
        a, b = x[both, i], x[both, j]
        mean[i, j] = a[0] if a.min() == a.max() else a.mean()
        da = a - mean[i, j]
        squares[i, j] = da @ da
        products[i, j] = da @ (b - (b[0] if b.min() == b.max() else b.mean()))
    bad = broken.T @ present.astype(np.float64)
    return {"n": n, "mean": mean, "squares": np.maximum(squares, 0), "products": products, "broken": bad + bad.T}


def merged(a: Moments, b: Moments, mean_of_other: tuple[np.ndarray, np.ndarray]) -> Moments:
    """Moments of the rows of both; ``mean_of_other`` are the means of j over the pairs (i, j), of ``a`` and ``b``."""
    n = a["n"] + b["n"]
    share = b["n"] / np.maximum(n, 1)
    some = (a["n"] > 0) & (b["n"] > 0)
    off = np.where(some, b["mean"] - a["mean"], 0.0)
    off_other = np.where(some, mean_of_other[1] - mean_of_other[0], 0.0)
    return {
        "n": n,
        "mean": np.where(a["n"] > 0, a["mean"] + off * share, b["mean"]),
        "squares": a["squares"] + b["squares"] + off * off * a["n"] * share,
        "products": a["products"] + b["products"] + off * off_other * a["n"] * share,
        "broken": a["broken"] + b["broken"],
    }


def _task_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    total = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]
        present = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
        now = batch_moments(np.column_stack(columns), present)
        total = now if total is None else merged(total, now, (total["mean"].T, now["mean"].T))
    if total is not None:
        k = len(total["n"])
        task = TaskContext.get().partitionId()
        # The means of the other column go along, as the merge of row i needs them.
        arrays = [pa.array(range(k), pa.int32()), pa.array([task] * k, pa.int32())]
        arrays += [pa.array(list(total[f]), pa.list_(pa.float64())) for f in FIELDS]
        arrays.append(pa.array(list(total["mean"].T), pa.list_(pa.float64())))
        yield pa.RecordBatch.from_arrays(arrays, names=["i", "task", *FIELDS, "other"])


def _merge_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Correlations of column i with all, from the rows of tasks sorted by i; one sum is held at a time."""
    column, total, other = None, None, None

    def result() -> pa.RecordBatch:
        # The squared deviations of j over the pairs (i, j) stand in row j: pairs are put together later.
        values = [pa.array([column], pa.int32())]
        values += [pa.array([total[f]], pa.list_(pa.float64())) for f in ("squares", "products", "broken")]
        return pa.RecordBatch.from_arrays(values, names=["i", "squares", "products", "broken"])

    for batch in batches:
        for r in range(batch.num_rows):
            i = batch.column("i")[r].as_py()
            now = {f: batch.column(f)[r].values.to_numpy() for f in FIELDS}
            now_other = batch.column("other")[r].values.to_numpy()
            if i != column:
                if column is not None:
                    yield result()
                column, total, other = i, now, now_other
                continue
            n = total["n"] + now["n"]
            next_other = np.where(
                total["n"] > 0,
                other + np.where(now["n"] > 0, now_other - other, 0.0) * now["n"] / np.maximum(n, 1),
                now_other,
            )
            total, other = merged(total, now, (other, now_other)), next_other
    if column is not None:
        yield result()


def gram_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(i, j, correlation)`` of all pairs of positions in ``columns``, i <= j, in one scan.

    Pairwise complete; NULL where either column is constant over the rows of the pair or there is no
    such row, NaN where the pair holds a value that isn't finite; a column with itself is 1, or NULL if
    constant. Per task k x k numbers are shuffled, and they are merged one after the other, so memory does
    not depend on rows or tasks.
    """
    values = df.select(*[F.col(name(c)).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    parts = values.mapInArrow(_task_moments, SCHEMA + ", other array<double>")
    dealt = parts.repartition("i").sortWithinPartitions("i", "task")
    sums = dealt.mapInArrow(_merge_tasks, "i int, squares array<double>, products array<double>, broken array<double>")
    cells = sums.select("i", F.posexplode(F.arrays_zip("squares", "products", "broken")).alias("j", "m")).select("i", "j", "m.*")
    # Both halves of a pair meet under its positions.
    half = cells.groupBy(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).agg(
        F.min("squares").alias("least"), F.max("squares").alias("most"), F.max("products").alias("products"), F.max("broken").alias("broken")
    )
    # A table without partitions has no sums, but pairs.
    k = len(columns)
    grid = df.sparkSession.range(k * k).selectExpr(f"CAST(id DIV {k} AS INT) AS i", f"CAST(id % {k} AS INT) AS j")
    every = grid.where("i <= j").join(half, ["i", "j"], "left")
    spread = F.sqrt("least") * F.sqrt("most")
    itself = F.when((spread > 0) | (F.col("broken") > 0), F.lit(1.0))
    other = F.when(F.col("broken") > 0, F.lit(float("nan"))).otherwise(F.try_divide("products", spread))
    return every.select("i", "j", F.when(F.col("i") == F.col("j"), itself).otherwise(other).alias("correlation"))
