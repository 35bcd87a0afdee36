"""Every operator on small tables with nulls, empty texts, repeated rows, clashing columns and no rows."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from assay.llm import decontaminate, html_wrappers, line_dedup, mixing, near_dedup, sharding, stars, token_counts
from assay.llm import toxicity, vector_tree, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, key string, score string"


def words(seed, n):
    rng = np.random.default_rng(seed)
    return [f"w{x}" for x in rng.integers(0, 5000, n)]


BASE = words(1, 300)
COPY = [*BASE[:100], "other", *BASE[101:]]
ITEM = words(2, 30)


@pytest.fixture(scope="module")
def docs(spark):
    texts = {
        1: " ".join(BASE),
        2: " ".join(COPY),
        3: " ".join(words(3, 200)),
        4: " ".join([*words(4, 50), *ITEM, *words(5, 50)]),
        5: "",
        6: None,
        7: " ".join(words(6, 30_000)),
        8: "one two",
        9: " ".join(BASE).upper(),
    }
    rows = [(i, t, "en", f"s{i % 3}" if i != 3 else None, None, "x", "k", "s") for i, t in texts.items()]
    rows += [rows[0], (None, "no id here", "en", "s1", 1, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_token_counts_equal_the_library(spark, docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["It's <|endoftext|> 12345 a b\x1cc", "ΟΔΟΣ éé é 😀😀 !!??", "  \t\r\n ", "x" * 500, "don't'll I'M"]
    more = docs.unionByName(spark.createDataFrame([(100 + i, t) + ("",) * 2 + (0,) + ("",) * 3 for i, t in enumerate(texts)], SCHEMA))
    expected = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) for r in more.collect()}
    got = token_counts.token_counts(more, path).collect()
    assert len(got) == more.count()
    assert {r.doc_id: r.n_tokens for r in got} == expected
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert token_counts.token_counts(none, path).count() == 0


def test_near_duplicates(spark, docs, none):
    got = Counter((r.doc_id, r.class_id) for r in near_dedup.near_duplicates(docs).collect())
    assert got == Counter({(1, 1): 2, (2, 1): 1, (3, 3): 1, (4, 4): 1, (5, 5): 1, (6, 6): 1, (7, 7): 1, (8, 8): 1, (9, 1): 1, (None, None): 1})
    assert near_dedup.near_duplicates(none).count() == 0


def test_copies_of_one_original_are_one_class(spark):
    rng = np.random.default_rng(9)
    rows = [(0, " ".join(BASE))]
    for i in range(1, 60):
        text = list(BASE)
        for at in rng.choice(300, 5, replace=False):
            text[at] = f"n{i}x{at}"
        rows.append((i, " ".join(text)))
    rows.append((99, " ".join(BASE[150:] + BASE[:150])))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    classes = {r.doc_id: r.class_id for r in got}
    assert {classes[i] for i in range(60)} == {0}
    assert classes[99] == 99  # the same shingles in another order


def test_true_pairs_hidden_among_strangers_are_found(spark, monkeypatch):
    # 150 texts share a key and about 0.7 of their traits; three pairs among them are alike.
    rng = np.random.default_rng(30)
    common = list(range(70))
    sets = {i: common + [1000 * (i + 1) + x for x in range(15)] for i in range(150)}
    hidden = [(40, 41), (77, 140), (100, 149)]
    for a, b in hidden:
        sets[b] = sets[a][:82] + [1000 * (b + 1) + x for x in range(3)]
    node = {int(i): int(n) for i, n in enumerate(rng.permutation(150))}
    keyed = spark.createDataFrame([(1, node[i]) for i in sets] + [(2, node[i]) for i in range(0, 150, 2)], "key long, node long")
    table = spark.createDataFrame([(node[i], x) for i, x in sets.items()], "node long, traits array<long>")
    truth = {(min(node[a], node[b]), max(node[a], node[b])) for a, b in hidden}

    def verifier(nodes):
        from pyspark.sql import functions as F

        links = [f"{a} {b}" for a, b in truth]
        similar = F.concat_ws(" ", "a", "b").isin(links)
        return lambda pairs: pairs.withColumn("similar", similar), lambda some: table.join(some, "node", "left_semi")

    monkeypatch.setattr(stars, "BLOCK_ROWS", 16)
    for few in (stars.FEW_PAIRS, -10**9):
        # Once at the first chance, once after a round that finds no link.
        monkeypatch.setattr(stars, "FEW_PAIRS", few)
        components, tried = stars.star_components(keyed, verifier, 0.8)
        assert {(r.a, r.b) for r in tried.where("similar").collect()} == truth
        assert {(r.component, r.node) for r in components.where("node <> component").collect()} == truth


def test_keys_of_one_row_go_wherever_batches_end():
    keys = [1, 1, 2, 3, 3, 3, 4, 5, 5, 6]
    rows = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(range(10))], names=["key", "node"])
    for cuts in ([], [1], [2, 3], [4, 5], range(1, 10)):
        ends = [0, *cuts, 10]
        got = stars._shared(rows.slice(a, b - a) for a, b in zip(ends, ends[1:]))
        assert [x for batch in got for x in batch.column("node").to_pylist()] == [0, 1, 3, 4, 5, 7, 8]


def test_close_pairs_with_numbers_twice_in_a_set():
    # Equal halves of two hashes are one number that stands in a set twice.
    sets = [[1, 2, 3, 4, 4], [1, 2, 3, 4, 9], [5, 6, 7, 8, 9]]
    x, y = stars.close_pairs([np.array([0]), np.arange(3)], np.array([5, 5, 5]), np.array(sum(sets, [])), 0.8)
    assert (0, 1) in set(zip(x.tolist(), y.tolist(), strict=True)) and 2 not in y


def test_cells_give_what_brute_force_gives(monkeypatch):
    rng = np.random.default_rng(12)
    rows = []
    for key in range(120):
        own = rng.integers(0, 1 << 40, 40).tolist()
        for _ in range(int(rng.choice([2, 3, 7, 16, 17, 40]))):
            traits = [x if rng.random() < 0.92 else int(rng.integers(1 << 40)) for x in own]
            component = int(rng.integers(5))
            part = 1 if component == 0 else 0
            rows.append((key, 0, stars.WHOLE, part, len(rows), component, traits + traits[: int(rng.integers(30))]))
    schema = pa.schema([*[(x, pa.int64()) for x in ("key", "i", "j", "part", "node", "component")], ("traits", pa.list_(pa.int64()))])
    batch = pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
    want = set()
    for a in rows:
        for b in rows[a[4] + 1 : a[4] + 40]:
            x, y = set(a[6]), set(b[6])
            if a[0] == b[0] and a[5] != b[5] and len(x & y) / len(x | y) >= 0.8:
                want.add((a[4], b[4]))
    for unpacked, traits, ends in ((1024, 1 << 19, 500), (100, 1000, 37)):
        monkeypatch.setattr(stars, "UNPACKED_ROWS", unpacked)
        monkeypatch.setattr(stars, "BLOCK_TRAITS", traits)
        batches = (batch.slice(at, ends) for at in range(0, len(rows), ends))
        got = [p for x in stars._compared(batches, 0.8, stars.lists, False) for p in zip(*x.to_pydict().values(), strict=True)]
        assert len(got) == len(set(got)) and set(got) == want
    assert len(want) > 500


def test_keys_with_the_same_rows_are_searched_once(spark):
    rows = [(1, 10), (1, 11), (2, 10), (2, 11), (3, 10), (3, 12), (4, 10), (4, 10), (4, 11), (5, 12), (5, 12), (5, 11)]
    got = stars._unlike(spark.createDataFrame(rows, "key long, node long"))
    assert {(r.key, r.weight) for r in got.collect()} == {(1, 4), (3, 2), (4, 3), (5, 3)}


def test_rounds_end_among_strangers(spark):
    # Strangers share keys, and each round would find a link or two of a chain among them.
    keyed = spark.range(400).selectExpr("1L AS key", "id AS node")
    rounds = []

    def verifier(nodes):
        def verify(pairs):
            rounds.append(1)
            return pairs.withColumn("similar", F.expr("a + 1 = b AND b < 60"))

        # Neighbours are close, all others are not.
        traits = spark.range(400).selectExpr("id AS node", "IF(id < 60, array(-1L, -2L, -3L, -4L, -5L), array(id)) AS traits")
        return verify, lambda some: traits.join(some, "node", "left_semi")

    few, stars.FEW_PAIRS = stars.FEW_PAIRS, -10**9
    try:
        components, _ = stars.star_components(keyed, verifier, 0.8)
    finally:
        stars.FEW_PAIRS = few
    assert sorted(r.node for r in components.where("component = 0").collect()) == list(range(60))
    assert len(rounds) <= 3


def test_a_key_per_sketch():
    # Deeper keys are shared only by texts that share this one.
    h = near_dedup.labelled(near_dedup.shingles(near_dedup.Words().of(" ".join(map(str, range(50))))))
    assert len(near_dedup.sketch_keys(h)) == near_dedup.SKETCHES


def test_banded_matches_equal_plain_alignment():
    rng = np.random.default_rng(3)
    for _ in range(60):
        a, b = (rng.integers(0, 6, rng.integers(0, 25)).astype(np.uint64) for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
        assert near_dedup.banded_matches(a, b, 60) == best[-1, -1]


def test_alignment_of_long_near_copies_takes_memory_of_the_band_only():
    import tracemalloc

    rng = np.random.default_rng(12)
    a = rng.integers(0, 1 << 63, 300_000).astype(np.uint64)
    b = a.copy()
    for at in (5, 299_990):
        b[at : at + 5] = rng.integers(0, 1 << 63, 5)
    b = np.delete(b, 1000)
    tracemalloc.start()
    found = near_dedup.banded_matches(a, b, 2000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 300_000 - 11
    assert peak < 100_000_000


@pytest.mark.parametrize("distinct", [2, 40, 400])
def test_narrow_bands_equal_plain_alignment_within_the_band(distinct):
    rng = np.random.default_rng(13)
    for _ in range(15):
        a, b = (rng.integers(0, distinct, 170).astype(np.uint64) for _ in range(2))
        for band in (0, 3, 30):
            best = np.zeros((len(a) + 1, len(b) + 1), int)
            for i, x in enumerate(a):
                for j, y in enumerate(b):
                    met = x == y and abs(i - j) <= band
                    best[i + 1, j + 1] = max(best[i, j] + met, best[i, j + 1], best[i + 1, j])
            assert near_dedup.banded_matches(a, b, band) == best[-1, -1]


def test_contaminated(spark, docs, none):
    items = [(1, " ".join(ITEM).title()), (2, None), (3, ""), (4, "one two"), (5, " ".join(words(8, 20)))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.similarity) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert got == {(4, 1, 1.0), (8, 4, 1.0)}
    assert decontaminate.contaminated(none, benchmark).count() == 0
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0


def brute_force(text, item, size=5):
    """The largest similarity of a window of the item's number of words."""
    doc, words_of = text.split(), item.split()
    listed = lambda w: [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]
    b, best = Counter(listed(words_of)), 0.0
    for start in range(len(doc) - size + 1):
        a = Counter(listed(doc[start : start + len(words_of)]))
        shared = (a & b).total()
        best = max(best, shared / (a.total() + b.total() - shared))
    return best


def test_edited_leaks_are_found_at_every_start(spark):
    item = words(20, 100)
    around, new = words(21, 40), words(22, 40)
    rows = [(0, [*around, *new[:3], *item[3:50], *new[3:9], *item[50:97], *new[9:12], *around])]
    rng = np.random.default_rng(23)
    for i in range(1, 60):
        leak = list(item)
        for _ in range(rng.integers(1, 4)):
            at = int(rng.integers(0, len(leak)))
            leak[at : at + int(rng.integers(0, 4))] = new[: rng.integers(0, 5)]
        rows.append((i, [*around[: rng.integers(0, 30)], *leak, *around[: rng.integers(0, 30)]]))
    rows.append((60, item[:90]))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(words(24, 100)))], "item_id long, text string")
    best = {i: brute_force(" ".join(w), " ".join(item)) for i, w in rows}
    expected = {(i, 1): x for i, x in best.items() if x >= 0.8}
    assert best[0] >= 0.8 and 10 < len(expected) < 61
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert got == pytest.approx(expected)


def test_flips_reach_every_fingerprint_within_the_radius():
    flips = set(decontaminate._flips())
    rng = np.random.default_rng(4)
    for _ in range(500):
        changed = rng.choice(64, decontaminate.RADIUS, replace=False)
        mask = sum(1 << int(b) for b in changed)
        assert any((mask >> 8 * b) & 255 in flips for b in range(8))


def test_mix(spark, docs, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes = {r.doc_id: len((r.text or "").split()) for r in docs.collect()}
    assert all(r["size"] == sizes[r.doc_id] for r in rows)
    targets = {r.source: (r.source_size, r.target) for r in rows}
    assert sum(t for _, t in targets.values()) == pytest.approx(1.5 * sum(r["size"] for r in rows))
    assert all(t <= 2 * s and 0 <= r.copies <= 2 for r in rows for s, t in [targets[r.source]])
    assert sorted(map(tuple, mixing.mix(docs).collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert mixing.mix(none).count() == 0


def test_mixed_rows_follow_their_own_source(spark):
    # Two sources of 50 words; ids null, in both sources, and repeated in one.
    ids = [None, None, *range(40), 0, *range(7)]
    rows = [(i, f"w{n}", "en", s, n) for s in ("a", "b") for n, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, size string, source string, copies int")
    for shares in ({"weights": (3, 14), "share": 0.85}, {}):
        times = {(r.doc_id, r.source): r.copies for r in mixing.mix(docs, **shares).collect()}
        expected = Counter({r: times[r[0], r[3]] for r in rows if times[r[0], r[3]]})
        assert Counter(map(tuple, mixing.mixed(docs, **shares).collect())) == expected
        if shares:
            # Rates 0.3 and 1.4: a document without id is not taken from one and taken from the other.
            assert times[None, "b"] != times[None, "a"]
            assert {c for (_, s), c in times.items() if s == "a"} == {0, 1}
            assert {c for (_, s), c in times.items() if s == "b"} == {1, 2}
    kept = corpus_pipeline.mix_sources(spark, docs, "")
    assert kept.columns == docs.columns and Counter(map(tuple, kept.collect())) == expected


@pytest.mark.parametrize("hot", [False, True])
def test_shards(spark, docs, none, hot):
    if hot:
        rows = [(i, "the same text" if i % 3 == 0 else f"text {i} " * (i % 17)) for i in range(3000)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard_documents(docs).collect()
    assert len(got) == docs.count()
    largest = max(r["size"] for r in got)
    total = Counter()
    slots = {}
    for r in got:
        total[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
        assert r["size"] == len((r.text or "").encode()) + 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if hot:
        share = sum(total.values()) / 24
        assert len(total) == 24 and all(abs(t - share) <= 0.002 * share + 2 * largest for t in total.values())
    assert sharding.shard_documents(none).count() == 0


def test_warc_round_trip(spark, none, tmp_path):
    long = "<p>é</p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 40
    rows = [(1, "http://a/b c", long), (2, None, long), (3, "http://x", long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (None, "n", long)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    warc.write_warc(pages, str(tmp_path / "w"))
    got = warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert all(r.reason is None for r in got)
    digest = {i: hashlib.sha1((t or "").encode()).hexdigest() for i, _, t in rows}
    assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in got} == {
        i: (len((t or "").encode()), digest[i]) for i, _, t in rows
    }
    assert {r.page_id: r.refers_to for r in got if r.record_type == "revisit"} == {1: 3, 2: 3, None: 3}
    assert next(r for r in got if r.page_id == 3).payload.decode() == long


def test_archive_files_are_bounded_by_bytes(spark, tmp_path):
    rows = [(i, f"http://a/{i}", f"<p>{i} " + "x" * (20_000 if i == 3 else 200)) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_warc(pages, f"{tmp_path}/warc", file_bytes=100_000)
    sizes = [f.stat().st_size for f in (tmp_path / "warc").glob("part-*")]
    assert len(sizes) == 50 and max(sizes) < 100_000
    records = warc.read_warc(spark, f"{tmp_path}/warc").collect()
    assert sorted(r.page_id for r in records if r.reason is None) == list(range(200)) and len(records) == 200


@pytest.mark.parametrize("packed", [False, True])
def test_salvage_goes_on_after_damage(packed):
    records = []
    for i in range(5):
        block = f"HTTP/1.1 200 OK\r\n\r\nbody {i} ".encode() * 3
        head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}\r\nContent-Length: {len(block)}\r\n\r\n"
        whole = head.encode() + block + b"\r\n\r\n"
        records.append(warc.member(whole) if packed else whole)
    broken = bytearray(records[1])
    broken[len(broken) // 2] ^= 0xFF
    data = records[0] + bytes(broken) + records[2] + b"junk" + records[3] + records[4][:-9]
    found = list(warc.salvage(data))
    gaps = [x for x in found if isinstance(x, tuple)]
    assert len(found) - len(gaps) == 3
    assert [(s, n) for s, n, _ in gaps] == [
        (len(records[0]), len(broken)),
        (len(records[0]) + len(broken) + len(records[2]), 4),
        (len(data) - len(records[4]) + 9, len(records[4]) - 9),
    ]
    assert list(warc.salvage(b"")) == []


def test_main_text(spark):
    page = """<html><head><title>T</title></head><body class="has-sidebar"><header><h1>Site</h1></header>
    <nav><ul><li><a href=/>Home</a></ul></nav><div class="cookie-notice">We use cookies</div><div class=ad>Buy</div>
    <article><h1>Head &amp; line</h1><p>One <b>bold</b>\n two<br>three<p>Four<script>var x = "</p>";</script>
    <form><p>Name</p></form><aside>Side</aside><ul><li>a<li>b</ul></article>
    <section id="comments"><p>Nice!</p></section><footer>&copy; us</footer>"""
    assert html_wrappers.main_text(page) == "Head & line\n\nOne bold two three\n\nFour\n\na\n\nb"
    assert html_wrappers.main_text("") == html_wrappers.main_text(None) == ""
    assert html_wrappers.main_text("<p>unclosed <!-- comment") == "unclosed"


def test_open_heads_and_slug_ids_keep_the_article():
    page = """<html><head><meta charset=utf-8><title>T</title><link rel=x><body><article><h2 id="related-work">Related</h2>
    <section id="search-methods"><p>One</p></section><p id="legal-history">Two</p><p id="a-form-of-notice">Three</p>
    <div id="comments">Nice!</div><div class="share">Share</div></article><aside>Side</aside>"""
    text = "Related\n\nOne\n\nTwo\n\nThree"
    assert html_wrappers.main_text(page) == text
    assert html_wrappers.main_text(page.replace("<body>", "")) == text
    assert html_wrappers.main_text(page.replace("article>", "main>")) == text
    assert html_wrappers.main_text("<head><title>T</title>Bare <b>text</b>") == "Bare text"
    assert html_wrappers.main_text("<head><title>T</title></head><div id='site-search'>Find</div><p>A</p>") == "A"


def test_frame_texts_of_a_host_go(spark):
    def page(i):
        return f"<body><div class=top>The same on all pages</div><div class=x><p>Text {i}</p><p>More {i}</p></div></body>"

    rows = [(i, f"http://H.example/{i}", page(i)) for i in range(8)] + [(20, None, page(20)), (21, "http://b.example/", None), (21, "http://b.example/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = html_wrappers.wrappers(pages)
    tree = {r.host: r for r in found.collect()}
    assert tree["h.example"].pages == 8 and "<p>#slot</>)+" in tree["h.example"].expression
    got = {r.page_id: r.text for r in html_wrappers.extract(pages, found).collect()}
    assert got[3] == "Text 3\n\nMore 3"
    assert got[20].startswith("The same") and got[21] == ""
    assert html_wrappers.extract(pages.limit(0), html_wrappers.wrappers(pages.limit(0))).count() == 0


def test_frame_texts_within_articles_go(spark):
    def page(i, text):
        return f"<body><nav>N{i}</nav><article><div class=tools>Tell your friends</div><h1>Title {text}</h1><p>{text}</p><p class=by>By the staff</p></article></body>"

    rows = [(i, "http://h.example/", page(i, f"Text {i}")) for i in range(5)]
    # Their article is all the same, so it is not taken for frame as a whole.
    rows += [(10 + i, "http://same.example/", page(i, "same")) for i in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html_wrappers.extract(pages, html_wrappers.wrappers(pages)).collect()}
    assert all(got[i] == f"Title Text {i}\n\nText {i}" for i in range(5))
    assert all("Title same\n\nsame" in got[10 + i] for i in range(5))


def test_copies_of_a_page_count_once_however_they_are_dealt(spark):
    page = "<body><div><h1>Head</h1><p>The only article</p></div></body>"
    other = "<body><div><h1>Head</h1><p>Another article</p></div></body>"
    for pages_of in ([page], [page, other]):
        rows = [(i, "http://h.example/", pages_of[i % len(pages_of)]) for i in range(40)]
        df = spark.createDataFrame(rows, "page_id long, url string, html string")
        results = []
        for n in (1, 8):
            dealt = df.repartition(n, "page_id")
            found = html_wrappers.wrappers(dealt)
            assert [r.pages for r in found.collect()] == [len(pages_of)]
            results.append({(r.page_id, r.text) for r in html_wrappers.extract(dealt, found).collect()})
        assert results[0] == results[1]
        assert {t for _, t in results[0]} == {"Head\n\n" + x for x in ("The only article", "Another article")[: len(pages_of)]}


def test_line_dedup(spark, none):
    long = "this is a rather long line of text that goes on and on for a while until it ends here at last"
    rows = [(1, f"{long}\nunique one here"), (2, f"another line\n\n{long}!"), (3, long.upper()), (4, None), (5, ""), (6, "ab\nab"), (None, long)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, line string")
    got = {(r.doc_id, r.line_no) for r in line_dedup.repeated_lines(docs).collect()}
    assert got == {(2, 2), (3, 0), (6, 1)}
    texts = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert texts[2] == "another line\n" and texts[3] == "" and texts[6] == "ab" and texts[4] is None
    empty = docs.limit(0)
    assert line_dedup.repeated_lines(empty).count() == 0


def test_lines_of_one_id_with_unlike_texts_are_judged_apart(spark):
    line = "a line that is long enough to be compared by its shingles, kept where it is met first"
    rows = [(1, f"{line}\nfirst"), (2, "its own text that no other row holds\nsecond"), (2, f"{line}\nkept here"), (2, f"{line}\nkept here")]
    schema = "doc_id long, text string, `a.b` int, dropped string, row map<string,int>, text_key int"
    docs = spark.createDataFrame([(*r, i, "mine", {"k": i}, i) for i, r in enumerate(rows)], schema)
    got = line_dedup.dedup_lines(docs)
    assert got.columns == docs.columns
    want = [f"{line}\nfirst", rows[1][1], "kept here", "kept here"]
    assert [tuple(r) for r in got.orderBy("`a.b`").collect()] == [
        (r[0], w, i, "mine", {"k": i}, i) for i, (r, w) in enumerate(zip(rows, want, strict=True))
    ]


def test_shingles_of_many_lines_are_those_of_each():
    lines = ["a", "a\0", "abcdefg", "abcdefgh", "abcabcabcabcabcabc", "zwölf größere Wörter \U0001f600 und mehr", "x" * 70_000, "abcdefghi"]
    counts, flat = line_dedup.shingle_sets(lines)
    sets = [set(x.tolist()) for x in np.split(flat, np.cumsum(counts)[:-1])]
    wanted = [set(line_dedup.shingle_set(x).tolist()) for x in lines]
    assert [len(x) for x in sets] == [len(x) for x in wanted]
    for a, x in zip(sets, wanted, strict=True):
        assert [len(a & b) for b in sets] == [len(x & y) for y in wanted]


def test_lines_are_dealt_to_cells_without_their_shingles(spark):
    docs = spark.createDataFrame([(1, 0, "One line that  is long enough")], "doc_id long, text_key long, text string")
    nodes = line_dedup.occurrences(docs).selectExpr("line AS node")
    _, traits = line_dedup._verifier(docs, nodes)
    assert [r.traits for r in traits(nodes).collect()] == ["one line that is long enough"]


def test_line_dedup_equals_brute_force(spark):
    rng = np.random.default_rng(11)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(400)]
    originals = [" ".join(rng.choice(words, 14)) for _ in range(60)]
    texts = []
    for _ in range(150):
        lines = []
        for _ in range(int(rng.integers(1, 6))):
            line = originals[int(rng.integers(60))].split()
            if rng.random() < 0.5:
                line[int(rng.integers(len(line)))] = str(rng.choice(words))
            lines.append(" ".join(line))
        texts.append("\n".join(lines))
    places = [(d, n, line) for d, text in enumerate(texts) for n, line in enumerate(text.split("\n"))]
    sets = [line_dedup.shingle_set(line_dedup.plain(line)) for *_, line in places]
    root = list(range(len(places)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(places)):
        for j in range(i):
            if line_dedup.jaccard(sets[i], sets[j]) >= line_dedup.THRESHOLD:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    want = {(d, n) for i, (d, n, _) in enumerate(places) if find(i) != i}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r.doc_id, r.line_no) for r in line_dedup.repeated_lines(docs).collect()} == want
    assert want and len(want) < len(places) - 1


def test_lines_that_repeat_themselves_are_not_taken_for_alike(spark, monkeypatch):
    # Strangers share a passage, and each says a long word of its own over and over.
    rng = np.random.default_rng(3)
    passage = "".join(rng.choice(list("abcdefghij "), 200))
    lines = [f"{passage} " + "".join(rng.choice(list("klmnopqrst"), 60)) * 30 for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    verifier, seen = line_dedup._verifier, []

    def counting(*args):
        verify, traits = verifier(*args)

        def counted(pairs):
            seen.append(pairs.count())
            return verify(pairs)

        return counted, traits

    monkeypatch.setattr(line_dedup, "_verifier", counting)
    assert line_dedup.repeated_lines(docs).count() == 0
    # The first round meets leaders; the blocks after it hand on none of the 1,770 pairs.
    assert len(seen) == 2 and 0 < seen[0] < 200 and seen[1] == 0


def test_line_pairs_are_judged_by_their_sets():
    rng = np.random.default_rng(5)
    base = ["".join(rng.choice(list("abcdefgh "), int(n))) for n in rng.integers(1, 300, 60)] + ["ab " * 90, "ab " * 20 + "x", "a", "a\0"]
    x = [base[i] for i in rng.integers(0, len(base), 300)]
    y = [line[: int(len(line) * cut)] + "z" if cut < 1 else line for line, cut in zip(x, rng.choice([0.7, 0.85, 0.95, 1], 300), strict=True)]
    y[::5] = [base[i] for i in rng.integers(0, len(base), 60)]
    want = [line_dedup.jaccard(line_dedup.shingle_set(a), line_dedup.shingle_set(b)) >= line_dedup.THRESHOLD for a, b in zip(x, y, strict=True)]
    assert line_dedup.similar_lines(x, y) == want and 30 < sum(want) < 270
    assert line_dedup.similar_lines([], []) == []


def test_plain_lines():
    lines = ["", " ", "a", "A  b", " a", "a ", "a\tb", "a\u00a0b", "a\u3000b", "a\x1cb", "a\x85", "ÄÖ ß", "ΟΔΟΣ ΟΔΟΣ", "a\u200bb", "x\u2028y", "a\r"]
    assert [line_dedup.plain(x) for x in lines] == [" ".join(x.lower().split()) for x in lines]


def test_lines_of_texts_that_share_id_and_hash(spark):
    lines = ["the line that is wanted here", "another line that is wanted"]
    docs = spark.createDataFrame([(1, 7, f"x\n{lines[0]}"), (1, 7, lines[1])], "doc_id long, text_key long, text string")
    found = line_dedup.occurrences(docs)
    _, traits = line_dedup._verifier(docs, found.selectExpr("line AS node").distinct(), found)
    assert {r.traits for r in traits(found.selectExpr("line AS node")).collect()} == {"x", *lines}


def test_nearest_finds_what_brute_force_finds(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 16)) * rng.uniform(0.5, 2, (3000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000 + i, x[0].tolist()) for i in range(50)]
    rows += [(6000, None), (6020, [0.0] * 16), (6040, [float("nan")] * 16), (6060, [None] * 16), (6080, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    from pyspark.sql import functions as F

    got = {}
    for r in vector_tree.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ids = np.array([i for i, _ in rows[:3050]])
    all_x = np.array([v for _, v in rows[:3050]])
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        scores = all_x @ all_x[ids == q][0]
        scores[ids == q] = -np.inf
        true = ids[np.lexsort((ids, -scores))[:20]]
        hits += len(set(true) & {v for _, v, _ in found})
        assert sorted(found) == sorted(found, key=lambda f: (-round(f[2], 9), f[1])) and len(found) == 20
    assert hits / (20 * len(got)) >= 0.9
    assert vector_tree.nearest(df.limit(0), F.lit(True)).count() == 0


def test_queries_with_tiny_leaves_get_all_their_rows(spark):
    # Clusters whose rows are each other's best, and outliers on axes of their own.
    x = np.zeros((428, 15))
    x[:420, :7] = np.repeat(np.eye(7) * 10, 60, axis=0) + np.random.default_rng(11).normal(size=(420, 7)) * 0.01
    x[420:, 7:] = np.eye(8) * 30
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    from pyspark.sql import functions as F

    found = Counter(r.query_id for r in vector_tree.nearest(df, F.col("vec_id").isin([*range(0, 420, 2), 427])).collect())
    assert found == {i: 20 for i in [*range(0, 420, 2), 427]}


def test_toxicity_on_held_out_rows(spark, docs, none):
    rng = np.random.default_rng(6)
    rows, marks = [], []
    for i in range(1500):
        toxic = i % 6 == 0
        rows.append((i, " ".join([*rng.choice(BASE, 40), *(["nasty", "vile"] if toxic else [])])))
        marks.append((i, int(toxic)))
    some = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (None, 1), (3, None)], "doc_id long, toxic int")
    scored = toxicity.toxicity(some, labels).withColumn("out", toxicity.held_out("doc_id")).where("out").collect()
    assert sum(r.predicted == (r.doc_id % 6 == 0) for r in scored) / len(scored) > 0.97
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.toxicity(none, labels.limit(0)).count() == 0
    assert all(r.predicted == 0 for r in toxicity.toxicity(docs, labels.limit(0)).collect())


def test_pipeline_stages_keep_columns_and_clean_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    odd = docs.limit(2).unionByName(docs.limit(1)).unionByName(docs.limit(1).selectExpr("CAST(NULL AS LONG) doc_id", "CAST(NULL AS STRING) text", "lang", "source", "n_chars"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (odd, docs.limit(0)):
            assert stage(spark, rows, sf).columns == docs.columns
            stage(spark, rows, sf).count()
    kept = corpus_pipeline.drop_near_copies(spark, odd, sf)
    assert kept.where("doc_id IS NOT NULL").count() == 2 and kept.where("doc_id IS NULL").count() == 1
