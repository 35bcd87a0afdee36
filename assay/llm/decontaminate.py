"""Benchmark decontamination by SimHash over windows of an item's size, in DataFrame operations only.

Windows have as many words as a benchmark item. A window that is similar to an item shares most
of its shingles with it, so of all windows those are fingerprinted that hold as many shingles of
items of their size as the threshold needs; which items they were is then forgotten. Fingerprints of windows and items meet in a
multi-index: eight blocks of eight bits, the items entered under all values within two bits. Two
fingerprints that differ in 23 bits or less must agree within two bits in one block, so none within
the radius is missed. The weighted shingle similarity of window and item decides.
"""

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import saved, small_side, table

SHINGLE = 5
THRESHOLD = 0.8
BITS, BLOCKS, SLACK = 64, 8, 2
RADIUS = (SLACK + 1) * BLOCKS - 1
#: Shingles and index entries of the items that a task may hold: 16 bytes each.
MOST_HELD = 4_000_000


def once(column: Column) -> Column:
    """``column`` worked out once per row: the optimizer copies no expression past a generator.

    Without it, a list used inside a lambda would be made anew for every element.
    """
    return F.explode(F.array(column))


def words(text: str) -> Column:
    """Lower-case words; punctuation and blanks only separate them. Null: none."""
    parts = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{M}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def shingles(words: Column, size: Column) -> Column:
    """64-bit hash of each run of ``size`` words; ``size`` is at most the number of words."""
    starts = F.sequence(F.lit(1), F.size(words) - size + 1)
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, size)))


def five_word_shingles(words: Column) -> Column:
    """:func:`shingles` of size five without slices: for the pass over all documents."""
    starts = F.sequence(F.lit(0), F.size(words) - SHINGLE)
    return F.transform(starts, lambda i: F.xxhash64(F.array(*(F.get(words, i + k) for k in range(SHINGLE)))))


def simhash(shingles: Column) -> Column:
    """Fingerprint: each bit is the majority over the shingles, each as often as it occurs."""
    bits = F.transform(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        lambda b: F.aggregate(
            shingles,
            F.lit(0),
            lambda votes, h: votes + F.getbit(h, b).cast("int") * 2 - 1,
        ),
    )
    ones = F.transform(bits, lambda votes, b: F.when(votes > 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(ones, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def _blocks(fingerprint: Column) -> Column:
    return F.array(
        *(F.shiftright(fingerprint, b * BITS // BLOCKS).bitwiseAND(F.lit(255)).cast("int") for b in range(BLOCKS))
    )


def _flips() -> list[int]:
    """All changes of at most SLACK bits of a block."""
    width = BITS // BLOCKS
    return [sum(1 << b for b in c) for n in range(SLACK + 1) for c in combinations(range(width), n)]


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two shingle lists; the weight of a shingle is how often it occurs."""

    def times(of: Column, x: Column) -> Column:
        return F.size(F.filter(of, lambda y: y == x))

    # Each shared shingle adds the smaller of its two weights.
    shared = F.aggregate(
        F.array_intersect(a, b), F.lit(0), lambda total, x: total + F.least(times(a, x), times(b, x))
    )
    return shared / (F.size(a) + F.size(b) - shared)


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``item_id, n_words, k, shingles, fingerprint`` of items with words; short items have one shingle."""
    split = benchmark.select(F.col("item_id").cast("long").alias("item_id"), once(words("text")).alias("w"))
    sized = split.where(F.size("w") > 0).withColumn("n_words", F.size("w")).withColumn(
        "k", F.least("n_words", F.lit(SHINGLE))
    )
    listed = sized.select("item_id", "n_words", "k", once(shingles(F.col("w"), F.col("k"))).alias("shingles"))
    return listed.withColumn("fingerprint", simhash(F.col("shingles")))


def _starts(hits: Column, need: Column, span: Column, first: Column) -> Column:
    """All starts from ``first`` on whose window holds ``need`` of the sorted places ``hits``.

    ``span``: how far the last place of a window is from its start. Each start comes once: with
    the first place that it has at or after it.
    """

    def of(i: Column) -> Column:
        last = F.get(hits, i + need - 1)
        after_previous = F.when(i > 0, F.get(hits, i - 1) + 1).otherwise(0)
        low = F.greatest(last - span, after_previous, first)
        return F.when(low <= F.get(hits, i), F.sequence(low, F.get(hits, i))).otherwise(F.array().cast("array<int>"))

    runs = F.transform(F.sequence(F.lit(0), F.size(hits) - need), of)
    return F.when(F.size(hits) >= need, F.flatten(runs)).otherwise(F.array().cast("array<int>"))


def _windows(split: DataFrame, items: DataFrame, k: int, held: int, threshold: float) -> DataFrame:
    """``doc_id, spans(n_words, start)`` of all windows that hold enough shingles of ``k`` words for ``threshold``.

    A window and an item of n shingles each share threshold / (1 + threshold) * 2n at least, and a
    shorter window at the end of a document has no fewer than threshold * n.
    """
    of_k = items.where(F.col("k") == k)
    known = small_side(of_k.select("n_words", F.explode("shingles").alias("hash")).distinct(), held, MOST_HELD)
    listed = five_word_shingles(F.col("w")) if k == SHINGLE else shingles(F.col("w"), F.lit(k))
    enough = split.where(F.size("w") >= k).withColumn("all", listed)
    met = enough.select("doc_id", F.size("w").alias("length"), F.posexplode("all").alias("at", "hash")).join(known, "hash")
    places = met.groupBy("doc_id", "length", "n_words").agg(F.sort_array(F.collect_set("at")).alias("hits"))
    span = F.col("n_words") - k
    share = 2 * threshold / (1 + threshold)
    need = F.greatest(F.ceil((span + 1) * F.lit(share) - 1e-9), F.lit(1)).cast("int")
    least = F.greatest(F.ceil((span + 1) * F.lit(threshold) - 1e-9), F.lit(1)).cast("int")
    placed = places.select("doc_id", "length", "n_words", once(F.struct("hits", need.alias("need"), least.alias("least"))).alias("p"))
    whole = _starts(F.col("p.hits"), F.col("p.need"), span, F.lit(0))
    cut = _starts(F.col("p.hits"), F.col("p.least"), span, F.col("length") - F.col("n_words") + 1)
    starts = placed.select("doc_id", "n_words", F.array_union(whole, cut).alias("starts")).where(F.size("starts") > 0)
    spans = starts.select("doc_id", F.explode(F.transform("starts", lambda s: F.struct("n_words", s.alias("start")))).alias("span"))
    return spans.groupBy("doc_id").agg(F.collect_set("span").alias("spans"))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, similarity``: one row per document and item that it holds.

    A document holds an item if a window of the item's number of words (shorter where the document
    ends) has a weighted shingle similarity of ``threshold`` or more to it; the largest one is
    given. Shingles have five words, or all words of a shorter item. Null and empty texts and items
    hold nothing, rows without doc_id are left out, repeated rows count once.
    """
    items = saved(benchmark_items(benchmark).distinct(), "items")
    sizes = {r.k: r.n for r in items.groupBy("k").agg(F.sum(F.size("shingles")).alias("n")).collect()}
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    split = narrow.select("doc_id", once(words("text")).alias("w"))
    schema = "doc_id long, item_id long, similarity double"
    found = docs.sparkSession.createDataFrame([], schema)
    for k, held in sorted(sizes.items()):
        spans = saved(_windows(split, items, k, held, threshold), "spans")
        found = found.unionByName(_matched(split, spans, items.where(F.col("k") == k), k, held, threshold))
    return found.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))


def _matched(split: DataFrame, spans: DataFrame, items: DataFrame, k: int, held: int, threshold: float) -> DataFrame:
    """``doc_id, item_id, similarity`` of windows that the Hamming index and the exact check let through."""
    few = small_side(spans, spans.count(), 100_000)
    texts = split.join(few, "doc_id").select("doc_id", "w", F.explode("spans").alias("span"))
    window = F.slice("w", F.col("span.start") + 1, F.col("span.n_words"))
    windows = texts.select("doc_id", "span.n_words", once(window).alias("w")).where(F.size("w") >= k)
    listed = windows.select("doc_id", "n_words", shingles(F.col("w"), F.lit(k)).alias("listed")).distinct()
    # One row per distinct window text: copies of a document need one look only.
    held_by = saved(listed.withColumn("fingerprint", simhash(F.col("listed"))), "windows")
    distinct = held_by.select("n_words", "listed", "fingerprint").distinct()
    probes = distinct.select("*", F.posexplode(_blocks(F.col("fingerprint"))).alias("block", "value"))
    flips = F.array(*map(F.lit, _flips()))
    entries = items.select(
        "item_id", "n_words", F.col("fingerprint").alias("own"), F.posexplode(_blocks(F.col("fingerprint"))).alias("block", "v")
    ).select("item_id", "n_words", "own", "block", F.explode(F.transform(flips, lambda x: x.bitwiseXOR(F.col("v")))).alias("value"))
    entries = small_side(entries, held * BLOCKS * len(_flips()), MOST_HELD)
    near = probes.join(entries, ["n_words", "block", "value"]).where(
        F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("own"))) <= RADIUS
    )
    candidates = near.select("n_words", "listed", "item_id").distinct()
    scored = candidates.join(small_side(items.select("item_id", "shingles"), held, MOST_HELD), "item_id").select(
        "n_words", "listed", "item_id", similarity(F.col("listed"), F.col("shingles")).alias("similarity")
    )
    kept = scored.where(F.col("similarity") >= threshold - 1e-12)
    return held_by.join(kept, ["n_words", "listed"]).select("doc_id", "item_id", "similarity")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op6_decontaminate": op6_decontaminate}


