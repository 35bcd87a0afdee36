"""Links within groups of candidates, without all pairs.

Rows that share a key are candidates of each other, and a key may be shared by very many. In each
round every key compares its rows with one of them only, the leader. The first leaders are those
that share most with others, as the original of many copies does, and each row meets the best of
the leaders of its keys; later leaders, up to eight per key and round, are those whose comparisons so far succeeded most often,
and rows meet all of them that aren't in their component yet. A key is done when all its rows are in
one component. Work per round grows with the number of rows under keys, whatever the size of a group.

Rounds only make components large. When one links few of the pairs it looked at, as among strangers
that share a passage, or few pairs are left, all pairs of rows of different components under the
keys still open are compared in blocks, by the number of traits that they share; those that share
enough are verified. So no pair of rows that share a key is left out, unless both are in one
component already, and the components don't depend on the number of rounds. Of keys that hold the
same rows one is searched.
"""

import logging
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.common import saved
from assay.plans.components import connected_components

log = logging.getLogger(__name__)


#: Leaders per key and round after the first; each is the best of its part of the rows.
LEADERS = 8
#: Pairs that one task verifies, at most if there is one pair per membership.
PAIRS_PER_PART = 10_000
#: Rows and traits of one side of a block, about; columns of shared traits that are counted at once.
BLOCK_ROWS, BLOCK_TRAITS, COLUMNS = 1024, 1 << 19, 2048
#: With so many pairs left, and so many more per row under an open key, they are compared without another round.
FEW_PAIRS, FEW_PER_ROW = 1_000_000, 20
#: Rows whose traits are unpacked at once.
UNPACKED_ROWS = 1024
#: Cells of at most so many rows are compared together.
SMALL_CELL = 16
#: In place of the second part of a cell that holds all rows of a key.
WHOLE = -1
#: A round that links fewer than one in so many pairs is the last one.
PAIRS_PER_LINK = 10

Verify = Callable[[DataFrame], DataFrame]
#: Lengths and flat numbers of the sets that a column of traits stands for.
Unpack = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def _leaders(members: DataFrame, rank: DataFrame, led: DataFrame | None) -> DataFrame:
    """``key, leader``: per key the rows of highest rank that have not led it before."""
    standing = members.join(rank, "node", "left").withColumn("rank", F.coalesce("rank", F.lit(0.5)))
    parts = ["key"]
    if led is not None:
        standing = standing.join(led, ["key", "node"], "left_anti")
        standing = standing.withColumn("part", F.pmod(F.xxhash64("node"), F.lit(LEADERS)))
        parts = ["key", "part"]
    top = standing.groupBy(*parts).agg(F.max(F.struct("rank", "node")).alias("top"))
    return top.select("key", F.col("top.node").alias("leader"), F.col("top.rank").alias("leader_rank"))


def _pairs(members: DataFrame, leaders: DataFrame, apart: bool) -> DataFrame:
    """``a < b``: each row with the best of its keys' leaders; ``apart``: with all in other components."""
    joined = members.join(leaders, "key")
    if not apart:
        # A row that leads some key itself still meets a better leader of another key.
        best = joined.groupBy("node").agg(F.max(F.struct("leader_rank", "leader")).alias("top"))
        joined = best.select("node", F.col("top.leader").alias("leader")).where("node <> leader")
    else:
        joined = joined.where("node <> leader AND component <> home")
    return joined.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def _sorted(lengths: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers and rows of all sets by number and row, each once, and how often each row repeats one of its numbers."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    order = np.argsort(flat, kind="stable")
    value, owner = flat[order], owner[order]
    again = np.concatenate([[False], (value[1:] == value[:-1]) & (owner[1:] == owner[:-1])])[: len(value)]
    return value[~again], owner[~again], np.bincount(owner[again], minlength=len(lengths))


def _needed(x: np.ndarray, y: np.ndarray, lengths: np.ndarray, again: np.ndarray, threshold: float, halves: bool) -> np.ndarray:
    """How many numbers the rows ``x`` and ``y`` have to share."""
    if not halves:
        lengths, again = lengths - again, np.zeros_like(again)
    return np.ceil(threshold / (1 + threshold) * (lengths[x] + lengths[y]) - 1e-9) - again[x] - again[y]


def close_pairs(
    sides: list[np.ndarray], lengths: np.ndarray, flat: np.ndarray, threshold: float, halves: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all pairs, one of each of the two ``sides``, whose sets have the Jaccard similarity ``threshold``.

    ``flat`` holds the sets one after the other. A number that stands in a set more than once may be that of several
    elements, if numbers are ``halves`` of hashes, and lets further pairs pass; else it is one element.
    """
    value, owner, again = _sorted(lengths, flat)
    code = np.cumsum(np.concatenate([[False], value[1:] != value[:-1]])[: len(value)])
    shared_by = np.bincount(code)
    met = shared_by > 1
    code, owner = (np.cumsum(met) - 1)[code][met[code]], owner[met[code]]
    left, right = sides
    shared = np.zeros((len(left), len(right)), dtype=np.float32)
    for first in range(0, int(code[-1]) + 1 if len(code) else 0, COLUMNS):
        start, end = np.searchsorted(code, [first, first + COLUMNS])
        held = np.zeros((len(lengths), int(code[end - 1]) - first + 1), dtype=np.float32)
        held[owner[start:end], code[start:end] - first] = 1
        shared += held[left] @ held[right].T
    rows, columns = np.nonzero(shared >= _needed(left[:, None], right[None, :], lengths, again, threshold, halves))
    return left[rows], right[columns]


def shared_in_cells(cell: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All rows ``x < y`` of one cell that share numbers, how many, and how often each row repeats one of its numbers.

    Rows of a cell stand together.
    """
    value, owner, again = _sorted(lengths, flat)
    width = int(np.unique(cell, return_counts=True)[1].max(initial=1))
    place, found = cell[owner], [np.array([], dtype=np.int64)]
    for step in range(1, width):
        # Rows of a cell that share a number follow each other.
        same = (value[step:] == value[:-step]) & (place[step:] == place[:-step])
        if not same.any():
            break
        x = owner[:-step][same]
        found.append(x * width + owner[step:][same] - x)
    shared = np.bincount(np.concatenate(found))
    pairs = np.flatnonzero(shared)
    x = pairs // width
    return x, x + pairs % width, shared[pairs], again


def lists(sets: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The sets of a column of arrays."""
    return sets.value_lengths().to_numpy(), sets.flatten().to_numpy()


def _compared(batches: Iterator[pa.RecordBatch], threshold: float, unpack: Unpack, halves: bool) -> Iterator[pa.RecordBatch]:
    """Close pairs ``a, b`` of different components in each cell; rows come sorted by cell.

    The cell of a key that is not cut holds all its rows, and part 0 meets them all.
    """

    def named(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    def small(cell: np.ndarray, node: np.ndarray, component: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Pairs of many cells that are not cut, about so many traits at once as a block has."""
        ends = np.cumsum(lengths)
        start = 0
        while start < len(cell):
            base = ends[start] - lengths[start]
            end = int(np.searchsorted(ends, base + BLOCK_TRAITS, "right"))
            # Up to the end of a cell.
            end = int(np.searchsorted(cell, cell[max(end, start + 1) - 1], "right"))
            rows = slice(start, end)
            x, y, shared, again = shared_in_cells(cell[rows], lengths[rows], flat[base : ends[end - 1]])
            close = shared >= _needed(x, y, lengths[rows], again, threshold, halves)
            close &= component[rows][x] != component[rows][y]
            yield named(node[rows][x[close]], node[rows][y[close]])
            start = end

    def pairs(key: tuple, parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        part, node, component, lengths, flat = map(np.concatenate, zip(*parts, strict=True))
        sides = [np.flatnonzero(part == key[1]), np.arange(len(part)) if key[2] == WHOLE else np.flatnonzero(part == key[2])]
        x, y = close_pairs(sides, lengths, flat, threshold, halves) if all(map(len, sides)) else (part[:0], part[:0])
        apart = component[x] != component[y]
        # Two rows of one part meet twice.
        apart &= (part[x] != part[y]) | (x < y)
        return named(node[x[apart]], node[y[apart]])

    current, parts = None, []
    for batch in batches:
        # Traits may take far more room unpacked.
        for at in range(0, len(batch), UNPACKED_ROWS):
            rows = batch.slice(at, UNPACKED_ROWS)
            key, i, j, *columns = (rows.column(c).to_numpy() for c in ("key", "i", "j", "part", "node", "component"))
            lengths, flat = unpack(rows.column("traits"))
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            cells = np.column_stack([key, i, j])
            edges = np.concatenate([[0], np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1, [len(rows)]])
            sizes = np.diff(edges)
            # The first cell may have begun before, and the last one may go on.
            together = (sizes <= SMALL_CELL) & (j[edges[:-1]] == WHOLE)
            together[[0, -1]] = False
            if together.any():
                of = np.repeat(together, sizes)
                numbers = np.repeat(np.arange(len(sizes)), sizes)[of]
                yield from small(numbers, columns[1][of], columns[2][of], lengths[of], flat[np.repeat(of, lengths)])
            for start, end in zip(edges[:-1][~together].tolist(), edges[1:][~together].tolist(), strict=True):
                cell = tuple(cells[start].tolist())
                if current is not None and cell != current:
                    yield pairs(current, parts)
                    parts = []
                current = cell
                parts.append([*(x[start:end] for x in (*columns, lengths)), flat[offsets[start] : offsets[end]]])
    if current is not None:
        yield pairs(current, parts)


def _homes(members: DataFrame) -> DataFrame:
    """``key, home, at_home, others``: per key its largest component, the rows in it and those outside."""
    per = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    top = per.groupBy("key").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"))
    return top.select("key", F.col("top.component").alias("home"), F.col("top.n").alias("at_home"), (F.col("all") - F.col("top.n")).alias("others"))


def _left(homes: DataFrame) -> int:
    """Pairs that :func:`_remaining` compares, at most."""
    return int(homes.agg(F.sum(F.expr("others * (others - 1) / 2 + others * at_home"))).first()[0] or 0)


def _remaining(members: DataFrame, homes: DataFrame, traits: DataFrame, threshold: float, unpack: Unpack, halves: bool) -> DataFrame:
    """All pairs ``a < b`` in different components that share a key of ``members(key, node, component)`` and are close.

    The rows of a key are cut into parts, those of its largest component apart from the others, and
    each part of the others meets every part once. Cells are laid with numbers only; traits come to
    them last, so they are shuffled once per cell.
    """
    size = F.size if traits.schema["traits"].dataType.typeName() == "array" else F.length
    full = members.join(traits.select("node", size("traits").alias("w")), "node").join(homes, "key")
    full = full.withColumn("out", F.col("component") != F.col("home"))
    weight = full.groupBy("key").agg(F.sum(F.when(F.col("out"), F.col("w"))).alias("w_out"), F.sum(F.when(~F.col("out"), F.col("w"))).alias("w_home"))

    def cuts(rows: str, size: str) -> Column:
        return F.greatest(F.ceil(F.col(rows) / BLOCK_ROWS), F.ceil(F.coalesce(F.col(size), F.lit(0)) / BLOCK_TRAITS), F.lit(1)).cast("int")

    full = full.join(weight, "key").withColumn("p_out", cuts("others", "w_out")).withColumn("p_home", cuts("at_home", "w_home"))
    hashed = F.xxhash64("node")
    part = F.when(F.col("out"), F.pmod(hashed, "p_out")).otherwise(F.col("p_out") + F.pmod(hashed, "p_home")).cast("int")
    whole = (F.col("p_out") == 1) & (F.col("p_home") == 1)
    met = F.sequence(F.lit(0), F.col("p_out") - 1 + F.when(F.col("out"), F.col("p_home")).otherwise(0))
    cells = full.withColumn("part", part).withColumn("with", F.explode(F.when(whole, F.array(F.lit(WHOLE))).otherwise(met)))
    cells = cells.select(
        "key",
        F.when(whole, F.lit(0)).otherwise(F.least("part", "with")).alias("i"),
        F.when(whole, F.lit(WHOLE)).otherwise(F.greatest("part", "with")).alias("j"),
        "part",
        "node",
        "component",
    )
    dealt = cells.join(traits, "node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(lambda batches: _compared(batches, threshold, unpack, halves), "a long, b long").distinct()


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows ``key, node`` whose key another row has; rows come sorted by key."""
    last, met = None, False
    for batch in batches:
        if not len(batch):
            continue
        keys = batch.column("key").to_numpy()
        same = keys[1:] == keys[:-1]
        before = last is not None and last.column("key")[0].as_py() == keys[0]
        if last is not None and (met or before):
            yield last
        # The last row waits for the one after it.
        keep = np.concatenate([[before], same[:-1]]) | same if len(same) else same
        if keep.any():
            yield batch.slice(0, len(batch) - 1).filter(pa.array(keep))
        last, met = batch.slice(len(batch) - 1), bool(same[-1]) if len(same) else before
    if last is not None and met:
        yield last


def _unlike(members: DataFrame) -> DataFrame:
    """``key, weight``: one of the keys that hold the same nodes, and the number of nodes under all of them.

    Sets of nodes are told apart by their size and two fingerprints of 64 bits.
    """
    h = F.xxhash64("node")
    # Sums of halves can't overflow, and count a node that a key repeats.
    parts = {"high": F.sum(F.shiftrightunsigned(h, 32)), "low": F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), "mixed": F.bit_xor(F.xxhash64("node", F.lit(1)))}
    sets = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), *[v.alias(k) for k, v in parts.items()])
    same = sets.groupBy("size", *parts).agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("keys"))
    return same.select("key", (F.col("size") * F.col("keys")).alias("weight"))


def star_components(
    keyed: DataFrame, verifier: Callable[[DataFrame], tuple[Verify, Verify]], threshold: float, unpack: Unpack = lists, halves: bool = True
) -> tuple[DataFrame | None, DataFrame | None]:
    """``(node, component)`` of linked nodes and all verified pairs ``(a, b, similar)``.

    ``keyed(key, node)`` gives the keys of each node, both numbers. ``verifier`` gets all
    ``(node)`` that can come up and returns two functions: one adds the column ``similar`` to pairs
    ``(a, b)``; the other gives ``(node, traits)``, a set of numbers, for some ``(node)``. Only pairs
    whose traits have the Jaccard similarity ``threshold`` may be similar. Traits of another kind than
    sets are made into sets by ``unpack`` where they are compared. A trait that a set repeats is one trait, unless traits are
    ``halves`` of hashes. Both results are None if no two nodes share a key.
    """
    # Most keys have one row; the others are found in one shuffle.
    dealt = keyed.select("key", "node").repartition("key").sortWithinPartitions("key")
    members = saved(dealt.mapInArrow(_shared, "key long, node long"), "members")
    size = members.count()
    if not size:
        return None, None
    verify, traits_of = verifier(members.select("node").distinct())
    unlike = saved(_unlike(members), "unlike", size)
    members = saved(members.join(unlike, "key").select("key", "node", "weight"), "members", size)
    rank = members.groupBy("node").agg(F.sum("weight").cast("double").alias("rank"))
    members = members.select("key", "node")
    size = members.count()
    tried = led = components = None
    links_found = 0
    while size:
        first_round = tried is None
        if first_round:
            pairs = _pairs(members, _leaders(members, rank, None), False)
        else:
            homes = components.select(F.col("node").alias("leader"), F.col("component").alias("home"))
            leaders = _leaders(members.select("key", "node"), rank, led).join(homes, "leader", "left")
            leaders = saved(leaders.withColumn("home", F.coalesce("home", "leader")), "leaders", size)
            pairs = _pairs(members, leaders, True).join(tried, ["a", "b"], "left_anti")
            led = led.unionByName(leaders.select("key", F.col("leader").alias("node")))
        # Verifying takes time, so a task gets few pairs.
        result = saved(verify(pairs), "verified", size, PAIRS_PER_PART)
        looked, found = result.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("similar").cast("int")), F.lit(0))).first()
        links_found += found
        log.info("round of stars: %d new links from %d pairs", found, looked)
        tried = result if first_round else tried.unionByName(result)
        if first_round:
            # In the first round a leader hasn't met all rows of its keys yet.
            led = members.where("false").select("key", "node")
        components = _linked(tried, links_found)
        now = members.select("key", "node").join(components, "node", "left")
        now = now.withColumn("component", F.coalesce("component", "node"))
        still = now.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
        members = saved(now.join(still.where("x <> y").select("key"), "key", "left_semi"), "members", size)
        size = members.count()
        homes = saved(_homes(members), "homes", size)
        left = _left(homes)
        log.info("open: %d rows under keys, %d pairs at most", size, left)
        poor = not first_round and found * PAIRS_PER_LINK <= looked
        if size and (poor or left <= FEW_PAIRS + FEW_PER_ROW * size):
            traits = saved(traits_of(members.select("node").distinct()), "traits")
            pairs = _remaining(members, homes, traits, threshold, unpack, halves).join(tried, ["a", "b"], "left_anti")
            result = saved(verify(saved(pairs, "remaining")), "verified")
            found = result.where("similar").count()
            log.info("all remaining pairs: %d new links", found)
            tried = tried.unionByName(result)
            return _linked(tried, links_found + found) if found else components, tried
        ends = tried.select(F.explode(F.array("a", "b")).alias("node"), F.col("similar").cast("int").alias("hit"))
        rank = ends.groupBy("node").agg(((F.sum("hit") + 1) / (F.count("hit") + 2)).alias("rank"))
    return components, tried


def _linked(tried: DataFrame, links: int) -> DataFrame:
    """``(node, component)`` of the ``links`` found so far."""
    return connected_components(tried.where("similar").select(F.col("a").alias("src"), F.col("b").alias("dst")), rows=links)
