"""Shards of near-equal bytes by histogram sort.

Every row has a 64-bit key: the upper half from its text, so that equal texts stand together,
the lower half from its id, so that a text with very many copies can still be divided. Exact
bytes and rows are counted between probes that divide the key range evenly; where a boundary
of two shards falls between two probes that are too far apart, or where very much lies between
two probes, the gap gets probes of its own, until all are close enough. Then the boundaries are
known, and each row moves once.
"""

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assay.llm.common import quoted, saved, table

FIRST_BITS, MORE_BITS, KEY_BITS = 12, 8, 64
#: Key ranges with more than this part of all bytes or rows are divided further.
HEAVY = 1 / 2048


def sort_key(doc_id: Column, text: Column) -> Column:
    """64 bits in signed order: text first, then id; nulls have a hash of their own."""
    # Spark's hash leaves nulls out, so the flag keeps them apart from other values.
    upper = F.shiftright(F.xxhash64(text.isNull(), text), 32)
    lower = F.xxhash64(F.lit("id"), doc_id.isNull(), doc_id).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftleft(upper, 32).bitwiseOR(lower)


def _prefix(bits: int) -> Column:
    """The upper ``bits`` of the key, with its sign."""
    return F.shiftright("key", KEY_BITS - bits)


class Ranges:
    """Consecutive key ranges with exact bytes and rows, refined by rounds of counting."""

    def __init__(self, keys: DataFrame, shards: int, tolerance: float):
        self.keys, self.shards = keys, shards
        total = keys.agg(F.sum("size"), F.count("size")).first()
        self.bytes, self.rows = total[0] or 0, total[1]
        self.close = tolerance * self.bytes / shards
        # [first key, bits of the prefix, prefix, bytes, rows], in order of keys
        self.found: list[tuple[int, int, int, int, int]] = []

    def count(self, bits: int, within: list[int] | None, step: int = 0) -> list[tuple[int, int, int, int, int]]:
        """Bytes and rows between the probes of one round; ``within``: prefixes shorter by ``step`` bits."""
        rows = self.keys.withColumn("probe", _prefix(bits))
        if within is not None:
            gaps = self.keys.sparkSession.createDataFrame([(p,) for p in within], "gap long")
            rows = rows.join(F.broadcast(gaps), F.shiftright("probe", step) == F.col("gap"), "left_semi")
        counted = rows.groupBy("probe").agg(F.sum("size"), F.count("size")).collect()
        return [(p << (KEY_BITS - bits), bits, p, b, n) for p, b, n in counted]

    def refine(self) -> None:
        """Count until no boundary lies in a wide gap and no gap is heavy.

        At most ``shards`` gaps hold a boundary and 2 / HEAVY are heavy, so what a round brings to
        the driver is bounded by constants, whatever the table's size.
        """
        bits, ranges = FIRST_BITS, self.count(FIRST_BITS, None) if self.rows else []
        while True:
            ranges.sort()
            open_gaps, below = [], 0
            for start, depth, prefix, size, rows in ranges:
                cut = self.splits(below, below + size)
                wide = size > self.close and cut
                if depth == bits and rows > 1 and (wide or size > HEAVY * self.bytes or rows > HEAVY * self.rows):
                    open_gaps.append(prefix)
                below += size
            if not open_gaps or bits >= KEY_BITS:
                break
            divided = set(open_gaps)
            ranges = [r for r in ranges if not (r[1] == bits and r[2] in divided)]
            step = min(MORE_BITS, KEY_BITS - bits)
            bits += step
            ranges += self.count(bits, open_gaps, step)
        self.found = ranges

    def splits(self, low: float, high: float) -> bool:
        """Whether a boundary between two shards lies strictly between two byte counts."""
        step = self.bytes / self.shards
        return step > 0 and math.floor(high / step) != math.floor(low / step) and low < self.bytes

    def dealt(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First key, shard, and rows before it within its shard, of every range."""
        starts = [r[0] for r in self.found]
        edges = np.concatenate([[0], np.cumsum([r[3] for r in self.found], dtype=np.float64)])
        # Each boundary goes to the nearest edge; equal distances to the lower one.
        cuts = []
        for i in range(1, self.shards):
            wanted = self.bytes * i / self.shards
            at = min(bisect_left(edges, wanted), len(edges) - 1)
            if at and wanted - edges[at - 1] <= edges[at] - wanted:
                at -= 1
            cuts.append(at)
        shard = np.searchsorted(np.array(cuts), np.arange(len(starts)), side="right")
        rows = np.concatenate([[0], np.cumsum([r[4] for r in self.found], dtype=np.int64)])
        first = np.searchsorted(shard, shard, side="left")
        before = rows[: len(starts)] - rows[first]
        return np.array(starts, dtype=np.int64), shard.astype(np.int32), before.astype(np.int64)


def shard_documents(docs: DataFrame, shards: int = 24, tolerance: float = 0.001) -> DataFrame:
    """``docs`` with ``size, shard, slot``; own columns of these names are replaced.

    Size is the UTF-8 bytes of the text (null: none) plus 8. Shards are consecutive key ranges
    whose bytes differ from an equal share by ``tolerance`` of it and one row at most; slots
    number the rows of a shard from 0 in key order. Rows that agree in id and text stand side
    by side, in the order of a hash of the whole row. Empty tables give no rows.
    """
    plain = docs.drop("size", "shard", "slot")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    key = sort_key(F.col("doc_id"), F.col("text"))
    ranges = Ranges(saved(docs.select(key.alias("key"), size.alias("size")), "keys"), shards, tolerance)
    ranges.refine()
    starts, shard, before = ranges.dealt()
    shared = docs.sparkSession.sparkContext.broadcast((starts, shard, before))

    @F.pandas_udf("_range int, shard int, _before long")
    def place(keys: pd.Series) -> pd.DataFrame:
        starts, shard, before = shared.value
        at = np.searchsorted(starts, keys.to_numpy(), side="right") - 1
        return pd.DataFrame({"_range": at.astype(np.int32), "shard": shard[at], "_before": before[at]})

    # Maps have no hash; their JSON has.
    whole = [F.to_json(F.struct(quoted(c))) if "map<" in kind else quoted(c) for c, kind in plain.dtypes]
    order = Window.partitionBy("_at._range").orderBy("_key", "doc_id", F.xxhash64(*whole))
    placed = plain.withColumn("size", size).withColumn("_key", key).withColumn("_at", place("_key"))
    slot = F.col("_at._before") + F.row_number().over(order) - 1
    return placed.withColumns({"shard": F.col("_at.shard"), "slot": slot.cast("long")}).drop("_key", "_at")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    # The text itself stays where it is: only its checksum and size move.
    narrow = docs.withColumn("text_crc32", crc)
    return shard_documents(narrow).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op3_sharding": op3_sharding}
