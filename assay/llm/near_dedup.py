"""Near-duplicate documents by order min-hash.

A document is the sequence of its five-word shingles, each labelled with how often it occurred
before. A sketch takes the shingles with the smallest hashes and keeps them in the order of the
text, so that two documents share a sketch only if they share shingles in the same order. Each
sketch gives a key for its 2 smallest shingles; a key for more of them would be shared only by
documents that share this one too. Candidates are verified by a banded alignment of the shingle sequences: the similarity of
a and b is m / (a + b - m), m being the most shingles that match in order.
"""

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import saved, small_side, table
from assay.llm.stars import Verify, star_components

WORD = re.compile(r"\w+")
SHINGLE = 5
THRESHOLD = 0.8
SKETCHES = 8
#: Shingles of a sketch in its key, and in the outline of a document.
DEPTH, OUTLINE = 2, 8
KNOWN_WORDS = 500_000

U = np.uint64


def mixed(h: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit number for each number."""
    h = h ^ (h >> U(31))
    h = h * U(0x7FB5D329728EA185)
    h = h ^ (h >> U(27))
    h = h * U(0x81DADEF4BC2DD44D)
    return h ^ (h >> U(33))


class Words:
    """64-bit hashes of words; each distinct word is hashed once per task."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        known, found = self.known, []
        for word in WORD.findall((text or "").lower()):
            code = known.get(word)
            if code is None:
                code = known[word] = xxhash.xxh3_64_intdigest(word.encode(errors="replace"))
            found.append(code)
        return np.array(found, dtype=U)


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of each run of ``size`` words; a shorter text is one shingle."""
    size = min(size, len(words))
    if not size:
        return words
    n = len(words) - size + 1
    h = np.full(n, size, dtype=U)
    for i in range(size):
        h = mixed(h * U(0x9E3779B97F4A7C15) + words[i : i + n])
    return h


def labelled(h: np.ndarray) -> np.ndarray:
    """Each shingle combined with its number of earlier occurrences in the text."""
    order = np.argsort(h, kind="stable")
    same = np.concatenate([[False], h[order][1:] == h[order][:-1]])
    if not same.any():
        return h
    at = np.arange(len(h))
    start = np.maximum.accumulate(np.where(same, 0, at))
    out = np.empty_like(h)
    out[order] = mixed(h[order] + (at - start).astype(U) * U(0xD1342543DE82EF95))
    return out


def sketch_keys(h: np.ndarray) -> list[int]:
    """Keys of the order min-hash sketches of labelled shingles; none below two shingles."""
    if len(h) < 2:
        return []
    keys = []
    for i in range(SKETCHES):
        v = mixed(h ^ U((i + 1) * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF))
        low = np.argpartition(v, DEPTH - 1)[:DEPTH]
        in_order = h[np.sort(low)]
        keys.append(xxhash.xxh3_64_intdigest(in_order.tobytes(), seed=i * 100 + DEPTH) - (1 << 63))
    return keys


def alike(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> bool:
    """Whether two shingle sequences have the similarity ``threshold`` in order."""
    need = math.ceil(threshold / (1 + threshold) * (len(a) + len(b)) - 1e-9)
    if need > min(len(a), len(b)) or not need:
        return False
    # Matches in order are at most the shared shingles with their labels.
    if len(np.intersect1d(labelled(a), labelled(b))) < need:
        return False
    return banded_matches(a, b, len(a) + len(b) - 2 * need) >= need


def banded_matches(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Most matches in order with positions at most ``band`` apart: rows of the alignment as bits.

    Memory is that of the two sequences and of the ``2 * band + 1`` diagonals of one row.
    """
    same = min(len(a), len(b))
    front = int((a[:same] != b[:same]).argmax()) if (a[:same] != b[:same]).any() else same
    a, b = a[front:], b[front:]
    same = min(len(a), len(b))
    if not same:
        return front
    differ = a[::-1][:same] != b[::-1][:same]
    back = int(differ.argmax()) if differ.any() else same
    a, b = a[: len(a) - back], b[: len(b) - back]
    if not len(a) or not len(b):
        return front + back
    # Where the shingles of a stand in b: parts of one list of places.
    by_value = np.argsort(b, kind="stable")
    first, last = (np.searchsorted(b[by_value], a, side).tolist() for side in ("left", "right"))
    places = by_value.tolist()
    # ``row`` holds the columns from ``low`` to ``top``. Those before the band don't change any more and are
    # counted; those behind it have not been met and are ones.
    found, low, top, row, full = 0, 0, 0, 0, 0
    step_size = max(64, band // 4)
    for i in range(len(a)):
        if i % step_size == 0:
            gone = min(max(0, i - band), top) - low
            if gone > 0:
                found += gone - (row & ((1 << gone) - 1)).bit_count()
                row, low = row >> gone, low + gone
            until = max(top, min(len(b), i + step_size + band))
            row |= ((1 << until - top) - 1) << top - low
            top = until
            full = (1 << top - low) - 1
        start, end = first[i], last[i]
        if end - start > 1:
            start, end = bisect_left(places, i - band, start, end), bisect_right(places, i + band, start, end)
        elif end > start and abs(places[start] - i) > band:
            continue
        if end - start > 32:
            marks = np.zeros(top - low, dtype=np.uint8)
            marks[by_value[start:end] - low] = 1
            hits = int.from_bytes(np.packbits(marks, bitorder="little").tobytes(), "little")
        else:
            hits = 0
            for j in places[start:end]:
                hits |= 1 << j - low
        if hits:
            step = row & hits
            row = ((row + step) | (row - step)) & full
    return front + back + found + (top - low) - row.bit_count()


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, exact, keys``: ``exact`` is equal for equal word sequences, null without text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            texts, exact, keys = batch.column("text"), [], []
            for i in range(len(texts)):
                text = texts[i].as_py()
                w = words.of(text)
                # Texts without any word are equal if all their characters are.
                plain = w.tobytes() if len(w) else (text or "").encode(errors="replace")
                exact.append(xxhash.xxh3_128_digest(plain, seed=int(len(w) > 0)) if plain else None)
                keys.append(sketch_keys(labelled(shingles(w))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(exact, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "exact", "keys"],
            )

    return docs.mapInArrow(run, "doc_id long, exact binary, keys array<long>")


def outline(h: np.ndarray) -> np.ndarray:
    """The smallest hashes of labelled shingles under each sketch, 32 bits of each."""
    parts = []
    for i in range(SKETCHES):
        v = mixed(h ^ U((i + 1) * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF))
        parts.append((np.partition(v, OUTLINE - 1)[:OUTLINE] if len(v) > OUTLINE else v) >> U(32))
    return np.unique(np.concatenate(parts)).astype(np.uint32).view(np.int32)


def _verifier(docs: DataFrame, nodes: DataFrame) -> tuple[Verify, Verify]:
    """Functions that add ``similar`` to ``pairs(a, b)`` of ``nodes`` and give labelled shingles as their traits.

    Outlines are compared first: two texts of similarity 0.8 share 51 of 64 hashes on average, give
    or take 3, and pairs that share less than half are not aligned.
    """
    ids = saved(nodes.select(F.col("node").alias("doc_id")), "ids")
    named = docs.join(small_side(ids, ids.count(), 2_000_000), "doc_id", "left_semi")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            texts = batch.column("text")
            h = [shingles(words.of(texts[i].as_py())) for i in range(len(texts))]
            outlines = pa.array([outline(labelled(x)) for x in h], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), outlines, pa.array([x.tobytes() for x in h], pa.binary())],
                names=["doc_id", "outline", "h"],
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = lru_cache(64)(lambda raw: np.frombuffer(raw, dtype=U))
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            similar = [alike(read(x[i].as_py()), read(y[i].as_py())) for i in range(len(x))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(similar, pa.bool_())], names=["a", "b", "similar"]
            )

    schema = "doc_id long, outline array<int>, h binary"
    shingled = saved(named.mapInArrow(hashed, schema).dropDuplicates(["doc_id"]), "shingles")

    def side(node: str, column: str, name: str) -> DataFrame:
        return shingled.select(F.col("doc_id").alias(node), F.col(column).alias(name))

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.join(side("a", "outline", "x"), "a").join(side("b", "outline", "y"), "b")
        close = F.size(F.array_intersect("x", "y")) * 2 >= F.least(F.size("x"), F.size("y"))
        looked = both.select("a", "b", close.alias("close"))
        # Both parts read the same exchanges.
        near = looked.where("close").select("a", "b").join(side("a", "h", "x"), "a").join(side("b", "h", "y"), "b")
        far = looked.where("NOT close").select("a", "b", F.lit(False).alias("similar"))
        return near.mapInArrow(compare, "a long, b long, similar boolean").unionByName(far)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Half of each hash is enough to find close pairs; equal halves in a text are allowed for.
            sets = [(labelled(np.frombuffer(x.as_py(), dtype=U)) >> U(32)).astype(np.uint32).view(np.int32) for x in batch.column("h")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sets, pa.list_(pa.int32()))], names=["node", "traits"]
            )

    def traits(some: DataFrame) -> DataFrame:
        wanted = shingled.join(some.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
        return wanted.select("doc_id", "h").mapInArrow(label, "node long, traits array<int>")

    return verify, traits


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id`` for every row of ``docs(doc_id, text, ...)``.

    A class holds all documents joined by links of similarity 0.8 or more, and is named after its
    smallest doc_id. Words are compared without case and punctuation. Texts with equal words are
    copies; null and empty texts are alike to none; rows without doc_id have no class (null).
    Repeated rows each give a row. Other columns are ignored.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = narrow.where("doc_id IS NOT NULL")
    all_sketches = saved(sketches(known), "sketches")
    # One document stands for all with the same words; equal words have equal keys.
    first = all_sketches.where("exact IS NOT NULL").groupBy("exact")
    first = saved(first.agg(F.min("doc_id").alias("node"), F.any_value("keys").alias("keys")), "first")
    keyed = first.select("node", F.explode("keys").alias("key"))
    components, _ = star_components(keyed, lambda nodes: _verifier(known, nodes), THRESHOLD)
    first = first.select("exact", "node")
    classes = first.withColumn("class_id", F.col("node"))
    if components is not None:
        classes = first.join(components, "node", "left").select(
            "exact", "node", F.coalesce("component", "node").alias("class_id")
        )
    # Only words shared by two documents need a look at the classes; hot copies are divided by Spark.
    joined = all_sketches.select("doc_id", "exact").join(classes.select("exact", "class_id"), "exact", "left")
    result = joined.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    nameless = narrow.where("doc_id IS NULL").select("doc_id", F.lit(None).cast("long").alias("class_id"))
    return result.unionByName(nameless)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op9_near_dedup": op9_near_dedup}
