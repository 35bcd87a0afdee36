"""Fuzzy line dedup: min-hash over character shingles, exact Jaccard, union-find.

Lines are compared without case and with single blanks. Equal lines have equal hashes; for the
others, signatures of 40 min-hashes are cut into ten keys of four, candidates share a key, and
pairs are verified by the exact Jaccard similarity of their shingle sets. Of each component of
linked lines the first occurrence stays.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import quoted, saved, small_side, table
from assay.llm.stars import UNPACKED_ROWS, Verify, shared_in_cells, star_components

SHINGLE = 8
THRESHOLD = 0.8
BANDS, ROWS = 10, 4
#: Fixed odd factors, one per min-hash.
FACTORS = np.random.default_rng(7).integers(1 << 31, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
CHUNK = 1 << 16
#: Columns of the keys of a line. In columns of their own Spark groups them by hash, which it can't do with arrays.
KEYS = [f"key{band}" for band in range(BANDS)]
#: Most lines whose places are broadcast to all documents.
FEW_LINES = 1_000_000

U = np.uint64


def plain(line: str) -> str:
    line = line.lower()
    # Of all white space only the blank is printable, so most lines need no cutting.
    if line.isprintable() and "  " not in line and line[:1] != " " and line[-1:] != " ":
        return line
    return " ".join(line.split())


def line_hash(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line.encode(errors="replace")) - (1 << 63)


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all character shingles of all lines, and where each line's begin.

    A line shorter than a shingle is one shingle.
    """
    padded = [line.ljust(SHINGLE, "\0") for line in lines]
    points = np.frombuffer("".join(padded).encode("utf-32-le", errors="replace"), dtype=np.uint32)
    h, span = points * np.uint32(0x9E3779B1), 1
    while span < SHINGLE:
        # The hash of a run of 2n characters from those of its halves.
        left, right = h[:-span], h[span:]
        h = (left ^ (left >> np.uint32(15))) * np.uint32(0x85EBCA77) + right * np.uint32(0xC2B2AE3D + 2 * span)
        span *= 2
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x27D4EB2F)
    h ^= h >> np.uint32(15)
    lengths = np.array([len(line) for line in padded])
    ends = np.cumsum(lengths)
    counts = lengths - SHINGLE + 1
    # Shingles that reach into the next line are left out.
    inside = np.ones(len(h), dtype=bool)
    for back in range(1, SHINGLE):
        over = ends[:-1] - back
        inside[over[over < len(h)]] = False
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    return h[inside], starts


def signatures(lines: list[str]) -> np.ndarray:
    """A row of BANDS keys per line."""
    hashes, starts = shingle_hashes(lines)
    lowest = np.empty((BANDS * ROWS, len(lines)), dtype=np.uint32)
    product = np.empty_like(hashes)
    for i, factor in enumerate(FACTORS):
        np.multiply(hashes, factor, out=product)
        np.minimum.reduceat(product, starts, out=lowest[i])
    keys = np.empty((len(lines), BANDS), dtype=np.int64)
    for band in range(BANDS):
        key = np.full(len(lines), band + 1, dtype=np.uint64)
        for row in lowest[band * ROWS : (band + 1) * ROWS]:
            key = (key ^ row) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
        keys[:, band] = key.view(np.int64)
    return keys


def shingle_set(line: str) -> np.ndarray:
    return np.unique(np.array([line_hash(line[i : i + SHINGLE]) for i in range(max(1, len(line) - SHINGLE + 1))]))


def shingle_sets(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number and 64-bit hashes of the character shingles of each line, one line after the other.

    A shingle that a line repeats is there as often. Lines are taken a few at a time, so that they stay in the cache.
    """
    counts, found, first = np.array([max(1, len(line) - SHINGLE + 1) for line in lines], dtype=np.int64), [], 0
    while first < len(lines):
        last, held = first, 0
        while last < len(lines) and (held < CHUNK or last == first):
            held, last = held + len(lines[last]), last + 1
        padded = [line.ljust(SHINGLE, "\0") for line in lines[first:last]]
        h = np.frombuffer("".join(padded).encode("utf-32-le", errors="replace"), dtype=np.uint32).astype(U)
        span = 1
        while span < SHINGLE:
            h = (h ^ (h >> U(29))) * U(0x9E3779B97F4A7C15)
            h ^= h >> U(32)
            h = h[:-span] * U(0xBF58476D1CE4E5B9) + h[span:] * U(0x94D049BB133111EB + 2 * span)
            span *= 2
        h ^= h >> U(31)
        lengths = np.array([len(line) for line in padded])
        ends = np.cumsum(lengths)
        inside = np.arange(len(h)) + SHINGLE <= np.repeat(ends, lengths)[: len(h)]
        h = h[inside]
        # A line shorter than a shingle differs from one that ends in what it is padded with.
        short = np.array([max(0, SHINGLE - len(line)) for line in lines[first:last]], dtype=U)
        if short.any():
            starts = np.cumsum(counts[first:last]) - counts[first:last]
            h[starts] += short * U(0xD6E8FEB86659FD93)
        found.append(h.view(np.int64))
        first = last
    return counts, np.concatenate(found) if found else np.array([], dtype=np.int64)


def line_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """:func:`shingle_sets` of a column."""
    return shingle_sets(texts.to_pylist())


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def occurrences(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, line_no, line`` and ``KEYS`` of every line that isn't blank; ``line`` is the hash of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            keys = signatures(lines)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(texts, pa.int64()),
                    pa.array(numbers, pa.int32()),
                    pa.array([line_hash(line) for line in lines], pa.int64()),
                    *[pa.array(np.ascontiguousarray(keys[:, band])) for band in range(BANDS)],
                ],
                names=["doc_id", "text_key", "line_no", "line", *KEYS],
            )

        for batch in batches:
            ids, texts, numbers, lines, held = [], [], [], [], 0
            keys_of = batch.column("text_key").to_pylist()
            for doc_id, key, text in zip(batch.column("doc_id").to_pylist(), keys_of, batch.column("text"), strict=True):
                for number, line in enumerate((text.as_py() or "").split("\n")):
                    line = plain(line)
                    if line:
                        ids.append(doc_id)
                        texts.append(key)
                        numbers.append(number)
                        lines.append(line)
                        held += len(line)
                # A megabyte at a time keeps the hashes in the processor's cache.
                if held > CHUNK * 4:
                    yield flush()
                    ids, texts, numbers, lines, held = [], [], [], [], 0
            if lines:
                yield flush()

    return docs.mapInArrow(run, "doc_id long, text_key long, line_no int, line long, " + ", ".join(f"{k} long" for k in KEYS))


def similar_lines(x: list[str], y: list[str]) -> list[bool]:
    """Whether the lines of each pair have the similarity ``THRESHOLD``."""
    lines = {line: i for i, line in enumerate(dict.fromkeys(x + y))}
    counts, flat = shingle_sets(list(lines))
    starts, similar, first = np.cumsum(counts) - counts, [], 0
    pairs = np.array([(lines[a], lines[b]) for a, b in zip(x, y, strict=True)], dtype=np.int64).reshape(-1, 2)
    ends = np.cumsum(counts[pairs].sum(axis=1))
    while first < len(pairs):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + CHUNK * 4, "right")))
        # Each pair is a cell of two rows.
        rows = pairs[first:last].reshape(-1)
        lengths = counts[rows]
        at = np.arange(lengths.sum()) + np.repeat(starts[rows] - (np.cumsum(lengths) - lengths), lengths)
        left, _, found, again = shared_in_cells(np.arange(len(rows)) // 2, lengths, flat[at])
        shared = np.zeros(last - first, dtype=np.int64)
        shared[left // 2] = found
        both = (lengths - again).reshape(-1, 2).sum(axis=1)
        similar += (shared / (both - shared) >= THRESHOLD).tolist()
        first = last
    return similar


def _verifier(docs: DataFrame, nodes: DataFrame, found: DataFrame | None = None) -> tuple[Verify, Verify]:
    """Functions that add ``similar`` to ``pairs(a, b)`` of line hashes and give lines as traits, see :func:`line_sets`.

    ``found``: the :func:`occurrences` of ``docs``, if they are known. Each line is read at one of its places.
    """
    wanted = saved(nodes.select(F.col("node").alias("line")), "wanted")
    n = wanted.count()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, lines = [], []
            for text, places in zip(batch.column("text"), batch.column("places").to_pylist(), strict=True):
                parts = text.as_py().split("\n")
                for place in places:
                    line = plain(parts[place["line_no"]]) if place["line_no"] < len(parts) else ""
                    # Unlike texts may share an id and the hash of the text.
                    if line and line_hash(line) == place["line"]:
                        hashes.append(place["line"])
                        lines.append(line)
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(lines, pa.string())], names=["line", "text"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = []
            for at in range(0, len(batch), UNPACKED_ROWS):
                similar += similar_lines(*(batch.column(c).slice(at, UNPACKED_ROWS).to_pylist() for c in ("x", "y")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(similar, pa.bool_())], names=["a", "b", "similar"]
            )

    every = (occurrences(docs) if found is None else found).select("doc_id", "text_key", "line_no", "line")
    places = every.join(small_side(wanted, n, 2_000_000), "line", "left_semi").dropDuplicates(["line"])
    places = places.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("line_no", "line")).alias("places"))
    held = docs.join(small_side(places, n, FEW_LINES), ["doc_id", "text_key"]).select("text", "places")
    named = saved(held.mapInArrow(texts, "line long, text string").groupBy("line").agg(F.first("text").alias("text")), "lines")
    one = named.select(F.col("line").alias("a"), F.col("text").alias("x"))
    other = named.select(F.col("line").alias("b"), F.col("text").alias("y"))

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.join(one, "a").join(other, "b")
        return both.mapInArrow(compare, "a long, b long, similar boolean")

    def traits(some: DataFrame) -> DataFrame:
        # A line is an eighth of its shingles, which are made where lines are compared.
        wanted = named.join(some.select(F.col("node").alias("line")), "line", "left_semi")
        return wanted.select(F.col("line").alias("node"), F.col("text").alias("traits"))

    return verify, traits


def text_key(text: Column) -> Column:
    """Tells rows apart that share a doc_id and not the text."""
    return F.xxhash64(text)


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, line_no`` of every line that repeats an earlier one, equal or similar.

    Lines are numbered from 0 within a text; blank lines, null and empty texts repeat nothing.
    The first occurrence, by doc_id, line number and hash of the text, of each component stays. A row is
    known by its doc_id and :func:`text_key`: rows that share an id and not the text are judged apart,
    rows that repeat an id with its text repeat its lines at the same place and are not dropped for
    that; rows without doc_id are left out.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")
    narrow = narrow.where("doc_id IS NOT NULL")
    found = saved(occurrences(narrow), "occurrences")
    distinct = found.groupBy("line").agg(*[F.min(k).alias(k) for k in KEYS])
    # A line's keys differ from each other, as the number of the band is hashed with them.
    keyed = distinct.select(F.col("line").alias("node"), F.explode(F.array(*KEYS)).alias("key"))
    components, _ = star_components(keyed, lambda nodes: _verifier(narrow, nodes, found), THRESHOLD, line_sets, halves=False)
    where = found.select("doc_id", "text_key", "line_no", "line")
    if components is not None:
        where = where.join(components.withColumnRenamed("node", "line"), "line", "left")
        where = where.select("doc_id", "text_key", "line_no", F.coalesce("component", "line").alias("line"))
    # The whole place in one comparable value, so that the smallest needs no sorting.
    place = F.struct("doc_id", "line_no", "text_key")
    first = where.groupBy("line").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = where.join(first, "line")
    return joined.where(place != F.col("first")).select("doc_id", "text_key", "line_no")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated lines in ``text``; see :func:`repeated_lines`. All rows and columns stay."""
    dropped = repeated_lines(docs).groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("dropped"))
    # Columns of the caller stay in a struct, so that none of theirs can clash with these.
    own = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"))
    own = own.withColumns({"doc_id": F.col("row.doc_id").cast("long"), "text_key": text_key(F.col("row.text"))})
    kept = F.filter(F.split(F.col("row.text"), "\n"), lambda _, i: ~F.array_contains("dropped", i))
    text = F.when(F.col("dropped").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    return own.join(dropped, ["doc_id", "text_key"], "left").select(
        *[(text if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns]
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document with repeated lines: their number and their places in order."""
    docs = table(spark, sf_dir, "documents")
    lines = F.array_sort(F.collect_set("line_no"))
    per = repeated_lines(docs).groupBy("doc_id", "text_key").agg(lines.alias("dropped_lines"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"))
    return own.join(per, ["doc_id", "text_key"], "left").select(
        "doc_id",
        F.coalesce(F.size("dropped_lines"), F.lit(0)).alias("n_dropped"),
        F.coalesce("dropped_lines", F.array().cast("array<int>")).alias("dropped_lines"),
    )


QUERIES = {"op7_line_dedup": op7_line_dedup}
