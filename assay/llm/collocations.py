"""Phrases whose words stand together more often than chance has it, by Rabin-Karp fingerprints.

Tasks turn texts into word hashes, and prefix polynomials over them give the fingerprint of every
run of words by one subtraction. A run can only be frequent if all shorter runs in it are. So
first, buckets of fingerprints are counted, short runs before long ones, and a bitmap of the buckets that hold
enough is kept per length. Runs that pass it go on as fingerprints, count and a pointer to one
occurrence, and are added up. Collisions: runs of one fingerprint are told apart by their words within
a part of a task, and by a second fingerprint, of other hashes and another base, between them; the words
found in the text at the pointer must have both. Only then, and only for frequent runs, phrases
are written out, and counts of parts give the scores.

The bitmaps have 2**27 bits at most, whatever the table's size. With them full, as some hundred billion
words would have it, every run goes on to the shuffle and the results are the same.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assay.llm.common import saved, small_side, table
from assay.plans.skew import salted_join

BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
LONGEST = 5
#: Words that a task looks at together, distinct words it remembers, and bytes of a text taken at once.
AT_ONCE, KNOWN_WORDS, SLICE = 1 << 20, 1 << 20, 1 << 20
#: Bytes of text per bucket, and the bits of a bucket number at least, at most and within a block.
PER_BUCKET, LEAST_BITS, MOST_BITS, BLOCK_BITS = 32, 16, 27, 16
#: Bases of the two fingerprints; odd, so that they have an inverse.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
WRAP = (1 << 64) - 1
#: Runs that a task holds before it sends them, texts that are broadcast by their keys at most, and the
#: leading bits of a fingerprint that name its block.
HELD_RUNS, FEW_TEXTS, RUN_BLOCK_BITS = 1 << 20, 1 << 20, 8
NO_WORD, BREAK = 0, 1


def _fold() -> bytes:
    """A-Z in lower case, breaks as line feeds, blanks as spaces."""
    fold = bytearray(range(256))
    for upper in range(ord("A"), ord("Z") + 1):
        fold[upper] = upper + 32
    for byte in BREAKS:
        fold[byte] = ord("\n")
    for byte in BLANKS:
        fold[byte] = ord(" ")
    return bytes(fold)


FOLD = _fold()


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words, empty strings and breaks (line feeds), in stretches that end at a break."""
    folded, at = text.translate(FOLD), 0
    while at < len(folded):
        end = folded.find(b"\n", at + SLICE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].replace(b"\n", b" \n ").split(b" ")
        at = end + 1


def word_hash(word: bytes) -> int:
    """128 bits: the lower half is for the first fingerprint, the upper for the second."""
    return xxhash.xxh3_128_intdigest(word)


def seed(lang: str, size: int) -> int:
    return xxhash.xxh64_intdigest(f"{size}:{lang}")


def mixed(prints: np.ndarray) -> np.ndarray:
    """A one-to-one mixture of all bits, so that any of them can choose the bucket."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        prints = (prints ^ (prints >> np.uint64(shift))) * np.uint64(factor)
    return prints ^ (prints >> np.uint64(33))


def fingerprints(lang: str, words: list[bytes]) -> tuple[int, int]:
    """Both fingerprints of a phrase, as signed 64-bit numbers."""
    found = []
    for half, base in enumerate(BASES):
        total, power = 0, 1
        for word in words:
            total = (total + (word_hash(word) >> (64 * half) & WRAP) * power) & WRAP
            power = power * base & WRAP
        found.append(total ^ seed(lang, len(words)))
    one, two = mixed(np.array(found, np.uint64)).view(np.int64).tolist()
    return one, two


class Words(dict):
    """Numbers of the words that a task has met, and their hashes."""

    def __init__(self):
        super().__init__({b"": NO_WORD, b"\n": BREAK})
        self.halves: tuple[list[int], list[int]] = ([0, 0], [0, 0])

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.halves[0])
        hashed = word_hash(word)
        self.halves[0].append(hashed & WRAP)
        self.halves[1].append(hashed >> 64)
        return number

    def hashes(self) -> list[np.ndarray]:
        return [np.array(half, np.uint64) for half in self.halves]


class Powers:
    """Powers of a base and of its inverse, as far as they have been needed."""

    def __init__(self, base: int):
        self.bases = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.empty(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]), dtype=np.uint64)
                for base in self.bases
            )
        return self.up[:n], self.down[:n]


class Polynomials:
    """Prefix sums of word hashes times powers: the fingerprint of any run is a difference of two."""

    def __init__(self, lang: str, hashes: np.ndarray, powers: Powers):
        self.lang = lang
        up, self.down = powers.upto(len(hashes))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)])

    def prints(self, size: int, at: np.ndarray) -> np.ndarray:
        total = (self.sums[at + size] - self.sums[at]) * self.down[at]
        return mixed(total ^ np.uint64(seed(self.lang, size)))


class Runs:
    """All runs of words in texts of one language, with what the bitmaps leave of them."""

    def __init__(
        self, lang: str, ids: np.ndarray, hashes: list[np.ndarray], powers: list[Powers], bitmaps: dict[int, np.ndarray]
    ):
        self.lang, self.ids, self.bitmaps, self.hashes, self.powers = lang, ids, bitmaps, hashes, powers
        self.first = Polynomials(lang, hashes[0][ids], powers[0])
        # The words up to the next break; a break ends every text.
        places = np.where(ids == BREAK, np.arange(len(ids)), len(ids))
        self.room = np.minimum.accumulate(places[::-1])[::-1] - np.arange(len(ids))

    def second(self) -> Polynomials:
        return Polynomials(self.lang, self.hashes[1][self.ids], self.powers[1])

    def levels(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per length: where runs begin that may be frequent, and their fingerprints."""
        below = None
        for size in range(1, longest + 1):
            at = np.flatnonzero(self.room >= size) if below is None else below[below_next]
            prints = self.first.prints(size, at)
            if size in self.bitmaps:
                bits = self.bitmaps[size]
                bucket = prints >> np.uint64(64 - (len(bits) * 8).bit_length() + 1)
                kept = (bits[bucket >> np.uint64(3)] >> (bucket & np.uint64(7)).astype(np.uint8)) & 1 == 1
                at, prints = at[kept], prints[kept]
            yield size, at, prints
            # A longer run begins where one of this length does and another one word later.
            alive = np.zeros(len(self.ids) + 1, bool)
            alive[at] = True
            below, below_next = at, alive[at + 1] & (self.room[at] > size)


class Reader:
    """Collects texts per language until there is enough to look at together."""

    def __init__(self, bitmaps: dict[int, np.ndarray]):
        self.words, self.powers, self.bitmaps = Words(), [Powers(base) for base in BASES], bitmaps
        self.held: dict[str, list[tuple[int, int, np.ndarray]]] = {}
        self.size = 0

    def read(self, batches: Iterator[pa.RecordBatch]) -> Iterator[None]:
        """Stops whenever enough is held, and at the end."""
        for batch in batches:
            for lang, key, text in zip(*(batch.column(c) for c in ("lang", "key", "text"))):
                first = 0
                for stretch in tokens(text.as_py()):
                    ids = np.fromiter(map(self.words.__getitem__, stretch), np.int64, len(stretch))
                    ids = np.append(ids[ids != NO_WORD], BREAK)
                    self.held.setdefault(lang.as_py(), []).append((key.as_py(), first, ids))
                    first += int((ids != BREAK).sum())
                    self.size += len(ids)
                    if self.size >= AT_ONCE:
                        yield
                        self.forget()
        if self.size:
            yield

    def forget(self) -> None:
        self.held, self.size = {}, 0
        if len(self.words) > KNOWN_WORDS:
            self.words = Words()

    def runs(self) -> Iterator[tuple[Runs, np.ndarray, np.ndarray]]:
        """Per language its runs, and for every place the key of its text and the number of the word in it."""
        hashes = self.words.hashes()
        for lang, stretches in self.held.items():
            # In order of keys: tasks then tend to point at the same texts.
            stretches.sort(key=lambda s: s[:2])
            sizes = [len(ids) for _, _, ids in stretches]
            ids = np.concatenate([ids for _, _, ids in stretches])
            begun = np.repeat(np.cumsum([0, *sizes[:-1]]), sizes)
            seen = np.concatenate([[0], np.cumsum(ids != BREAK)])
            number = seen[:-1] - seen[begun] + np.repeat([first for _, first, _ in stretches], sizes)
            keys = np.repeat(np.array([key for key, _, _ in stretches], np.int64), sizes)
            yield Runs(lang, ids, hashes, self.powers, self.bitmaps), keys, number


def bucket_bits(octets: int) -> int:
    return min(max((octets // PER_BUCKET).bit_length(), LEAST_BITS), MOST_BITS)


def frequent_buckets(
    texts: DataFrame, sizes: range, bits: int, least: int, known: dict[int, np.ndarray]
) -> dict[int, np.ndarray]:
    """Per length a bitmap of the buckets that hold ``least`` runs or more of those that ``known`` bitmaps leave.

    Tasks send sorted bucket numbers of 16 bits per block of buckets, and counts that stop at ``least``.
    """
    shared = texts.sparkSession.sparkContext.broadcast(known)
    count_type = np.min_scalar_type(least)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for _ in reader.read(batches):
            found: dict[int, list[np.ndarray]] = {}
            for runs, _, _ in reader.runs():
                for size, _, prints in runs.levels(sizes[-1]):
                    if size in sizes:
                        found.setdefault(size, []).append(prints >> np.uint64(64 - bits))
            rows = []
            for size, buckets in found.items():
                buckets, times = np.unique(np.concatenate(buckets), return_counts=True)
                times = np.minimum(times, least).astype(count_type)
                blocks, starts = np.unique(buckets >> np.uint64(BLOCK_BITS), return_index=True)
                for block, start, end in zip(blocks.tolist(), starts, [*starts[1:], len(buckets)]):
                    low = (buckets[start:end] & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.uint16)
                    rows.append((size, block, low.tobytes(), times[start:end].tobytes()))
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=["size", "block", "low", "times"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, total = None, np.zeros(1 << BLOCK_BITS, np.int64)

        def enough():
            if name is not None and (total >= least).any():
                held = np.packbits(total >= least, bitorder="little").tobytes()
                columns = [pa.array([name[0]], pa.int32()), pa.array([name[1]], pa.int32()), pa.array([held], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["size", "block", "bits"])

        for batch in batches:
            for size, block, low, times in zip(*(batch.column(c) for c in ("size", "block", "low", "times"))):
                if (size.as_py(), block.as_py()) != name:
                    yield from enough()
                    name = (size.as_py(), block.as_py())
                    total[:] = 0
                total[np.frombuffer(low.as_py(), np.uint16)] += np.frombuffer(times.as_py(), count_type)
        yield from enough()

    found = (
        texts.mapInArrow(count, "size int, block int, low binary, times binary")
        .repartition("size", "block")
        .sortWithinPartitions("size", "block")
        .mapInArrow(add, "size int, block int, bits binary")
        .collect()
    )
    bitmaps = {size: np.zeros(1 << (bits - 3), np.uint8) for size in sizes}
    width = 1 << (BLOCK_BITS - 3)
    for size, block, held in found:
        bitmaps[size][block * width : (block + 1) * width] = np.frombuffer(held, np.uint8)
    return bitmaps


class Gathered:
    """Runs of a task as rows of fingerprints, pointer and count, added up."""

    def __init__(self):
        self.rows: dict[tuple[str, int], list[tuple[np.ndarray, ...]]] = {}
        self.size = 0

    def add(self, lang: str, size: int, *columns: np.ndarray) -> None:
        self.rows.setdefault((lang, size), []).append(columns)
        self.size += len(columns[0])

    def sums(self) -> Iterator[tuple[str, int, list[np.ndarray]]]:
        """Per language and length one row for equal fingerprints, with the lowest pointer."""
        for (lang, size), parts in self.rows.items():
            columns = [np.concatenate(part) for part in zip(*parts)]
            order = np.lexsort(columns[3::-1])
            one, two, key, at, times = (column[order] for column in columns)
            new = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
            yield lang, size, [one[new], two[new], key[new], at[new], np.add.reduceat(times, new)]

    def merge(self) -> None:
        merged = {(lang, size): [tuple(columns)] for lang, size, columns in self.sums()}
        self.rows, self.size = merged, sum(len(parts[0][0]) for parts in merged.values())

    def take(self) -> Iterator[tuple[str, int, list[np.ndarray]]]:
        """The sums; nothing is held afterwards."""
        yield from self.sums()
        self.rows, self.size = {}, 0


RUN = ("print", "other", "key", "at", "times")
PACKED = "lang string, size int, block int, print binary, other binary, key binary, at binary, times binary"


def _packed(gathered: Gathered) -> Iterator[pa.RecordBatch]:
    """One row per language, length and block of fingerprints, with the numbers of its runs packed."""
    rows = []
    for lang, size, columns in gathered.take():
        # Sorted as signed numbers, so the blocks are stretches.
        blocks, starts = np.unique(columns[0] >> np.int64(64 - RUN_BLOCK_BITS), return_index=True)
        for block, start, end in zip(blocks.tolist(), starts, [*starts[1:], len(columns[0])]):
            rows.append((lang, size, block, *(c[start:end].astype(np.int64).tobytes() for c in columns)))
    if rows:
        types = (pa.string(), pa.int32(), pa.int32(), *[pa.binary()] * 5)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["lang", "size", "block", *RUN]
        )


def pointed_runs(texts: DataFrame, longest: int, bitmaps: dict[int, np.ndarray]) -> DataFrame:
    """Runs that pass all bitmaps, added up within a task and packed by blocks of fingerprints.

    ``key`` and ``at`` point at one occurrence: the hash of a text and the number of the word in it.
    Rows of size 0 hold all words of a language.
    """
    shared = texts.sparkSession.sparkContext.broadcast(bitmaps)

    def point(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, gathered = Reader(shared.value), Gathered()
        for _ in reader.read(batches):
            for runs, keys, number in reader.runs():
                none = np.zeros(1, np.int64)
                gathered.add(runs.lang, 0, none, none, none, none, np.array([(runs.ids != BREAK).sum()]))
                second = runs.second()
                for size, at, prints in runs.levels(longest):
                    while len(at):
                        unique, first, where = np.unique(prints, return_index=True, return_inverse=True)
                        shown = at[first]
                        # The same words as at the occurrence that is shown, or else another run of one fingerprint.
                        same = np.ones(len(at), bool)
                        for step in range(size):
                            same &= runs.ids[at + step] == runs.ids[shown[where] + step]
                        times = np.bincount(where[same], minlength=len(unique))
                        other = second.prints(size, shown)
                        gathered.add(
                            runs.lang, size, unique.view(np.int64), other.view(np.int64), keys[shown], number[shown], times
                        )
                        at, prints = at[~same], prints[~same]
            if gathered.size > HELD_RUNS:
                gathered.merge()
                if 2 * gathered.size > HELD_RUNS:
                    yield from _packed(gathered)
        yield from _packed(gathered)

    return texts.mapInArrow(point, PACKED)


def summed_runs(packed: DataFrame, least: int) -> DataFrame:
    """``lang, size, print, other, key, at, a``: runs met ``least`` times in all, and the words per language (size 0)."""
    schema = pa.schema([("lang", pa.string()), ("size", pa.int32()), *[(c, pa.int64()) for c in (*RUN[:4], "a")]])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, gathered = None, Gathered()

        def enough():
            for lang, size, columns in gathered.take():
                kept = (columns[4] >= least) | (size == 0)
                n = int(kept.sum())
                if n:
                    head = [pa.array([lang] * n, pa.string()), pa.array(np.full(n, size), pa.int32())]
                    yield pa.RecordBatch.from_arrays([*head, *(pa.array(c[kept]) for c in columns)], schema=schema)

        for batch in batches:
            for row in range(batch.num_rows):
                here = tuple(batch.column(c)[row].as_py() for c in ("lang", "size", "block"))
                if here != name:
                    yield from enough()
                    name = here
                gathered.add(*here[:2], *(np.frombuffer(batch.column(c)[row].as_py(), np.int64) for c in RUN))
                if gathered.size > HELD_RUNS:
                    gathered.merge()
        yield from enough()

    order = ["lang", "size", "block"]
    return (
        packed.repartition(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(add, "lang string, size int, print long, other long, key long, at long, a long")
    )


def _read_at(texts: DataFrame, runs: DataFrame) -> DataFrame:
    """``lang, size, phrase, a``: the words that runs point at, if they have the fingerprints."""
    wanted = runs.groupBy("key").agg(F.collect_list(F.struct("lang", "size", "print", "other", "at", "a")).alias("wanted"))
    keys = runs.select("key").distinct()
    needed = texts.join(small_side(keys, keys.count(), FEW_TEXTS), "key", "left_semi")
    # One text per key, or more should their hashes be equal. Copies are put together before they move.
    known = needed.groupBy("key").agg(F.collect_set("text").alias("texts"))
    named = known.join(wanted, "key").select(F.explode("texts").alias("text"), "wanted")
    schema = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("a", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted in zip(batch.column("text"), batch.column("wanted")):
                words = [w for stretch in tokens(text.as_py()) for w in stretch if w and w != b"\n"]
                found = []
                for p in wanted.as_py():
                    run = words[p["at"] : p["at"] + p["size"]]
                    if fingerprints(p["lang"], run) == (p["print"], p["other"]):
                        phrase = b" ".join(run).decode()
                        found.append({"lang": p["lang"], "size": p["size"], "phrase": phrase, "a": p["a"]})
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=schema)

    return named.mapInArrow(read, "lang string, size int, phrase string, a long")


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """``(lang, size, phrase, a)`` of all phrases up to ``longest`` words met ``least`` times, and ``(lang, n)``.

    ``docs(lang, text, ...)``: A-Z count as lower case, phrases lie between the marks ``.,;:!?`` and line
    breaks, words between blanks and tabs. Null languages are ``und``; null and empty texts hold no
    word; repeated rows count each; other columns are ignored; an empty table gives no rows.
    """
    texts = docs.where("octet_length(text) > 0").select(
        F.coalesce("lang", F.lit("und")).alias("lang"),
        F.xxhash64("text").alias("key"),
        F.col("text").cast("binary").alias("text"),
    )
    bits = bucket_bits(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    bitmaps = frequent_buckets(texts, range(1, min(longest, 2) + 1), bits, least, {})
    if longest > 2:
        bitmaps |= frequent_buckets(texts, range(3, longest + 1), bits, least, bitmaps)
    runs = saved(summed_runs(pointed_runs(texts, longest, bitmaps), least), "runs")
    phrases = saved(_read_at(texts, runs.where("size > 0")), "phrases")
    return phrases, runs.where("size = 0").select("lang", F.col("a").alias("n"))


def collocations(
    docs: DataFrame, least: int = 100, longest: int = LONGEST, covered: int = 100, best: int = 2000
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``best`` phrases of two words or more per language.

    A phrase met ``a`` times of ``n`` words scores the least ``floor(1000 a n / (l r))`` of its cuts into a
    first part met ``l`` times and a rest met ``r`` times; of equal cuts the first counts. Phrases that lie
    in a longer one met ``covered`` per cent as often are left out. Equal scores rank by ``a``, then by phrase in
    order of its bytes. For odd input see :func:`frequent_phrases`.
    """
    phrases, totals = frequent_phrases(docs, least, longest)
    words = F.split("phrase", " ")
    counts = phrases.select("lang", "phrase", "a")
    candidates = phrases.where("size > 1").withColumn("words", words)
    cuts = candidates.select(
        "lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), "size"
    ).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", 1, F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    # A frequent word begins or ends very many phrases.
    for part, times in (("first", "l"), ("rest", "r")):
        side = counts.select("lang", F.col("phrase").alias(part), F.col("a").alias(times))
        cuts = salted_join(cuts, side, ["lang", part], ["phrase", "k"])
    exact = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r")}
    scored = (
        cuts.join(totals, "lang")
        .withColumns({f"_{c}": value for c, value in exact.items()})
        .withColumn("score", F.expr("(1000 * (_a * _n)) div (_l * _r)"))
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    parts = F.expr(
        "flatten(transform(sequence(2, size - 1), w -> transform(sequence(1, size - w + 1),"
        " s -> array_join(slice(words, s, w), ' '))))"
    )
    longer = (
        candidates.where("size > 2")
        .select("lang", F.explode(parts).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    left = scored.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2,000 phrases of each language; odd input as in :func:`frequent_phrases`."""
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {"op12_collocations": op12_collocations}

SQL = {
    "op12_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM worded GROUP BY lang
), sized AS (
  SELECT lang, words, unnest(range(1, 6)) AS size FROM worded
), placed AS (
  SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM sized
), counts AS (
  SELECT lang, size, phrase, string_split(phrase, ' ') AS words, count(*) AS a
  FROM (SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase FROM placed)
  GROUP BY lang, size, phrase HAVING count(*) >= 100
), halves AS (
  SELECT c.lang, c.phrase, c.a, k.k, array_to_string(words[1:k.k], ' ') AS head,
         array_to_string(words[k.k + 1:c.size], ' ') AS rest
  FROM counts c JOIN (SELECT unnest(range(1, 5)) AS k) k ON k.k < c.size
), cuts AS (
  SELECT h.lang, h.phrase, h.a, h.k, l.a AS l, r.a AS r, t.n,
         CAST(CAST(1000 AS HUGEINT) * h.a * t.n // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM halves h
  JOIN counts l ON l.lang = h.lang AND l.phrase = h.head
  JOIN counts r ON r.lang = h.lang AND r.phrase = h.rest
  JOIN totals t ON t.lang = h.lang
), scored AS (
  SELECT lang, phrase, a, n, min(score) AS score, arg_min(l, (score, k)) AS l, arg_min(r, (score, k)) AS r
  FROM cuts GROUP BY lang, phrase, a, n
), within AS (
  SELECT lang, a, array_to_string(words[s:s + w - 1], ' ') AS phrase
  FROM (SELECT lang, a, size, words, w, unnest(range(1, size - w + 2)) AS s
        FROM (SELECT lang, a, size, words, unnest(range(2, size)) AS w FROM counts))
), longer AS (
  SELECT lang, phrase, max(a) AS longer FROM within GROUP BY lang, phrase
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN longer o ON o.lang = s.lang AND o.phrase = s.phrase
  WHERE o.longer IS NULL OR 100 * o.longer < 100 * s.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
}
